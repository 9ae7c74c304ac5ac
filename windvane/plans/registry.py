"""Named queries over the shared test tables, each with an independent SQL statement where one exists.

The ``events`` table stands for turbine telemetry: ``user_id`` is the turbine, ``ts`` the time,
``value`` the sensor; ``error`` rows are the failure log and all other rows are signals. The failed
component is a function of ``event_id``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windvane.functions.time import floor_time
from windvane.session import TIDY

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

COMPONENTS = ["GENERATOR", "HYDRAULIC_GROUP", "GENERATOR_BEARING", "TRANSFORMER", "GEARBOX"]
SENSORS = ["click", "view", "signup", "purchase"]


def query(name: str, sql: str | None = None):
    def register(make: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            for key, value in {"spark.sql.session.timeZone": "UTC", **TIDY}.items():
                spark.conf.set(key, value)
            return make(spark, sf_dir)

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return make

    return register


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def r(col: Column | str, digits: int = 6) -> Column:
    return F.round(F.col(col) if isinstance(col, str) else col, digits)


def component_of(event_id: str = "event_id") -> Column:
    return F.get(F.array(*[F.lit(c) for c in COMPONENTS]), (F.col(event_id) % 5).cast("int"))


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events").filter(F.col("event_type") != "error")
    return ev.select(floor_time("ts").alias("Timestamp"), F.col("user_id").alias("Turbine_ID"), "event_id", "event_type", "value")


def wide_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sensor column per signal type; a row holds the value of its own type."""
    s = signals(spark, sf_dir)
    return s.select("Timestamp", "Turbine_ID", *[F.when(F.col("event_type") == t, F.col("value")).alias(t) for t in SENSORS])


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events").filter(F.col("event_type") == "error")
    return ev.select(
        floor_time("ts").alias("Timestamp"), F.col("user_id").alias("Turbine_ID"), component_of().alias("Component"), "event_id"
    )


# The same two tables in SQL.
SIGNALS_SQL = """signals AS (
  SELECT time_bucket(INTERVAL '10 minutes', ts) AS Timestamp, user_id AS Turbine_ID, event_id, event_type, value
  FROM events WHERE event_type <> 'error')"""
FAILURES_SQL = """failures AS (
  SELECT time_bucket(INTERVAL '10 minutes', ts) AS Timestamp, user_id AS Turbine_ID,
         (['GENERATOR','HYDRAULIC_GROUP','GENERATOR_BEARING','TRANSFORMER','GEARBOX'])[event_id % 5 + 1] AS Component, event_id
  FROM events WHERE event_type = 'error')"""
