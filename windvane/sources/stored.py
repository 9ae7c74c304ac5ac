"""Telemetry stored by machine and time, so that scans over histories need no shuffle.

The table is bucketed by its key and every bucket is one file in the order of key and time. Operators that look along a machine's
history (gap filling, next failure, as-of joins, rolling statistics) find their rows together: the planner sees the buckets and leaves the exchange out.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_history(df: DataFrame, path: str, key: str, ts: str, buckets: int) -> DataFrame:
    """Store a table under ``path`` in ``buckets`` buckets of the key, each sorted by key and time, and return it as stored.

    Rows without a key share a bucket. Tables that are to be joined or united without a shuffle need the same number of buckets; a bucket is read by
    one task, so it should hold some hundred MB at most.
    """
    spark = df.sparkSession
    name = _name()
    placed = df.repartition(buckets, key).sortWithinPartitions(key, ts)
    placed.write.mode("overwrite").bucketBy(buckets, key).sortBy(key, ts).option("path", path).saveAsTable(name)
    about = {"schema": df.schema.json(), "key": key, "ts": ts, "buckets": buckets}
    spark.createDataFrame([(json.dumps(about),)], "about string").coalesce(1).write.mode("overwrite").text(f"{path}_layout")
    return spark.table(name)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """A table that :func:`write_history` has stored, also in another session: with its buckets and their order."""
    about = json.loads(spark.read.text(f"{path}_layout").first()["value"])
    name, fields = _name(), T.StructType.fromJson(json.loads(about["schema"]))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields.fields)
    key, ts, buckets = about["key"], about["ts"], about["buckets"]
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (path '{path}') CLUSTERED BY (`{key}`) SORTED BY (`{key}`, `{ts}`) INTO {buckets} BUCKETS"
    )
    return spark.table(name)


def _name() -> str:
    return f"history_{uuid.uuid4().hex}"
