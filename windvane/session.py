"""Session settings, the shared scratch folder, and the size check behind every broadcast."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A task may hold this many rows of one ordered group; larger groups are cut into blocks.
MAX_GROUP_ROWS = 2_000_000
# ... and no more than this when a value counts as 16 bytes, so that wide rows are cut earlier.
MAX_GROUP_BYTES = 512 * 1024 * 1024
# A join side is broadcast only when it was measured below this.
MAX_BROADCAST_BYTES = 32 * 1024 * 1024


# Shuffle files go when the query that wrote them has ended. Otherwise they stay until the driver happens to collect its garbage.
TIDY = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def session(app: str = "windvane", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library relies on (UTC clock, adaptive execution)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.scheduler.mode": "FAIR",  # side by side runs get a pool each, see operators.models.model_matrix
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **TIDY,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster an unset
    folder is an error, because a machine-local path would not survive a lost executor.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="windvane-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on whatever file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later steps read the stored rows and never recompute them."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def is_small(df: DataFrame, max_bytes: int | None = None) -> bool:
    """True when the frame was measured below the broadcast bound.

    The row count, which reads no columns beyond those of the filters, settles most large frames;
    only a frame with few rows has its texts and nested values measured too.
    """
    bound = MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
    per_row = 16 * (len(df.columns) + 1)
    fixed = df.count() * per_row
    if fixed > bound:
        return False
    parts = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            parts.append(F.octet_length(col))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.octet_length(F.to_json(F.struct(col))))
    if not parts:
        return True
    varying = df.agg(*[F.sum(p).alias(f"b{i}") for i, p in enumerate(parts)]).first()
    return fixed + sum(v or 0 for v in varying) <= bound


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Broadcast hint for a side measured small; otherwise unchanged, so that the join shuffles."""
    return F.broadcast(df) if is_small(df, max_bytes) else df


def group_rows(df: DataFrame, task_rows: int | None = None) -> int:
    """Rows of one ordered group that a task may hold: ``task_rows``, or by the number of columns."""
    return min(MAX_GROUP_ROWS, MAX_GROUP_BYTES // (16 * (len(df.columns) + 1))) if task_rows is None else task_rows


def few_rows(df: DataFrame, most: int = 10_000) -> DataFrame:
    """A small aggregate, computed once and broadcast; unchanged when it has more than ``most`` rows.

    Meant for one row per group beside the groups' own rows: a join that shuffled on the group alone would gather
    a large group in one task.
    """
    rows = df.limit(most + 1).collect()
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)) if len(rows) <= most else df
