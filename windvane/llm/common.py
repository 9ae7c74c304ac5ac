"""What several operators share: bounded slices of Arrow batches, connected components, worker caches."""

from __future__ import annotations

import ctypes
import gc
import os
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windvane.session import cut_lineage, shared_dir

# Bytes of text that a task turns into arrays at a time; one longer text is a slice of its own.
SLICE_BYTES = 4 * 1024 * 1024
EDGES_PER_TASK = 200_000


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns named c0, c1, ..., so that none clashes with the columns of an operator, and the new names by the old ones."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker, so that the tasks it runs one after another share it."""
    holder = sys.modules.setdefault("windvane_worker_cache", types.ModuleType("windvane_worker_cache"))
    return holder.__dict__.setdefault(name, {})


def write_shared(spark: SparkSession, name: str, data: bytes) -> str:
    """Writes a small file into the shared folder, whatever file system that is on, and returns its path."""
    path = os.path.join(shared_dir(spark), name)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    return path


def release() -> None:
    """Gives freed memory back to the system: a Python worker outlives its task, and executors have other work for it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, with the memory released when the task's rows are done."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return tidied


def text_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut by rows so that a slice holds about ``limit`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = utf8(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the start of each row in them (one more entry than rows); null is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    rows = len(column)
    if not rows:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + rows + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def texts(column: pa.Array) -> list[str]:
    """The texts of a column; null is empty."""
    return [t or "" for t in column.to_pylist()]


def held_out(id_column: str, folds: int, fold: int):
    """True where crc32 of the id as text falls into the fold that learning never sees; an id of null counts as empty."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % folds == fold


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (u, v) but the roots; root is the smallest node reachable.

    Rounds of large-star and small-star: each hangs every node below the smallest neighbour seen, so paths
    shrink exponentially. Only edges move, at most one per node and neighbour; nothing reaches the driver but a
    count and a checksum per round. Each round is checkpointed, and so are the smallest neighbours, so that
    adaptive execution can split the edges of a node that very many others hang on.
    """
    edges = cut_lineage(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    )
    before = None
    while True:
        # a round of few edges is a handful of tasks, however many partitions its shuffles have
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before, tasks = now, 2 + now[0] // EDGES_PER_TASK
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut_lineage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).coalesce(tasks))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut_lineage(large.coalesce(tasks))
        least = cut_lineage(large.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct().coalesce(tasks))


def forest(size: int, pair_blocks: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For nodes 0..size-1 linked by blocks of index pairs: the smallest index of each node's component."""
    label = np.arange(size)
    for i, j in pair_blocks:
        while True:
            a, b = label[i], label[j]
            open_ = a != b
            if not open_.any():
                break
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while True:
                jumped = label[label]
                if (jumped == label).all():
                    break
                label = jumped
    return label
