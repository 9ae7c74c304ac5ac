"""Vector codes by product quantisation over lexicographic tries of the distinct parts.

A vector becomes whole numbers and is cut into equal parts; every part position has a codebook. The distinct parts of
all vectors are counted once and stored in lexicographic order, so that a run of them is a trie: parts with a common
prefix are neighbours. Each round walks the tries depth first. A node's vector holds the squared distances of its
prefix to all entries of the codebook; a child adds the term of one more component to its parent's vector, so a prefix is
paid for once, however many parts share it. A leaf takes the nearest entry and adds its part, times its count, to it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windvane.llm.common import tidy
from windvane.llm.grids import grid_vectors
from windvane.session import cut_lineage

BLOCK = 4096  # leaves whose distance vectors a task holds at a time
TASK_PARTS = 65_536  # distinct parts of a task, about


def trie_nearest(parts: np.ndarray, book: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (lowest index among equals) and squared distance of distinct parts in lexicographic order.

    Depth first over the trie of the parts. A node with more than ``block`` leaves is entered with its own vector; a run of smaller
    siblings is finished at once, level by level, from the vector of their parent.
    """
    rows, width = parts.shape
    entry, far = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    # begins[j][i]: row i starts a node of depth j + 1
    begins = np.ones((width, rows), bool)
    begins[:, 1:] = np.logical_or.accumulate(parts[1:] != parts[:-1], axis=1).T
    stack = [(0, rows, 0, np.zeros(len(book), np.int64))] if rows else []
    while stack:
        start, end, depth, shared = stack.pop()
        if end - start <= block or depth == width:
            vectors, parent = shared[None, :], np.zeros(end - start, np.int64)
            for j in range(depth, width):
                new = begins[j, start:end].copy()
                new[0] = True
                first = np.flatnonzero(new)
                vectors = vectors[parent[first]] + (parts[start + first, j][:, None] - book[None, :, j]) ** 2
                parent = np.cumsum(new) - 1
            best = vectors.argmin(axis=1)[parent]
            entry[start:end], far[start:end] = best, vectors[parent, best]
            continue
        new = begins[depth, start:end].copy()
        new[0] = True
        cuts = [*(start + np.flatnonzero(new)).tolist(), end]
        below, run = [], start
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b - a > block:
                if a > run:
                    below.append((run, a, depth, shared))
                below.append((a, b, depth + 1, shared + (parts[a, depth] - book[:, depth]) ** 2))
                run = b
            elif b - run > block:
                below.append((run, a, depth, shared))
                run = a
        if end > run:
            below.append((run, end, depth, shared))
        stack += reversed(below)
    return entry, far


def _numbers(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(rows, -1)


def _sums(table: DataFrame, books: np.ndarray) -> list:
    """Count and sums of the parts nearest to each entry: one row per position, entry and component, at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], list] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            place = batch.column("place").to_numpy(zero_copy_only=False)
            parts, weight = _numbers(batch.column("part"), batch.num_rows), batch.column("weight").to_numpy(zero_copy_only=False)
            for p in np.unique(place).tolist():
                own = place == p
                entry, _ = trie_nearest(parts[own], books[p])
                order = np.argsort(entry, kind="stable")
                first = np.flatnonzero(np.diff(entry[order], prepend=-1))
                counts = np.add.reduceat(weight[own][order], first)
                sums = np.add.reduceat(parts[own][order] * weight[own][order][:, None], first, axis=0)
                for e, n, s in zip(entry[order][first].tolist(), counts.tolist(), sums, strict=True):
                    held = total.setdefault((p, e), [0, np.zeros(parts.shape[1], np.int64)])
                    held[0] += n
                    held[1] = held[1] + s
        rows = [(p, e, j, n, int(x)) for (p, e), (n, s) in total.items() for j, x in enumerate(s)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["place", "entry", "j", "n", "s"])

    found = table.mapInArrow(tidy(run), "place long, entry long, j long, n long, s long")
    return found.groupBy("place", "entry", "j").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()


def vector_codes(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
    parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256,
) -> tuple[DataFrame, np.ndarray]:
    """(id, label, codes, error) of every vector that can be coded, and the codebooks as [part][entry][component].

    Components become floor(scale * x). Vectors that are null, empty or hold a null or a non-finite number are left out, as are vectors
    of another length than that of the smallest id. A length that ``parts`` does not divide is filled up with zeros. Codebooks start with the ``entries`` smallest ids (of rows that repeat an id the smallest vector starts; all of them are coded);
    rows without an id are coded too, but start no entry. A null label is kept. With no vector to code both results are empty; other
    columns are not read.
    """
    rows = grid_vectors(vectors, id_column, vector_column, label_column, scale)
    ids = rows.where("id is not null").select("id").distinct().orderBy("id").limit(entries)
    first = rows.join(F.broadcast(ids), "id").groupBy("id").agg(F.min("vec").alias("vec")).orderBy("id").collect()  # at most ``entries`` rows
    kind = rows.schema["label"].dataType.simpleString()
    schema = f"id {rows.schema['id'].dataType.simpleString()}, label {kind}, codes array<int>, error long"
    if not first:
        return vectors.sparkSession.createDataFrame([], schema).withColumnsRenamed({"id": id_column, "label": label_column}), np.zeros((parts, 0, 0), np.int64)
    dim = len(first[0]["vec"])
    size = -(-dim // parts)
    rows = rows.where(F.size("vec") == dim)
    if size * parts > dim:
        rows = rows.withColumn("vec", F.concat("vec", F.array_repeat(F.lit(0), size * parts - dim)))
    seeds = [r["vec"] + [0] * (size * parts - dim) for r in first if len(r["vec"]) == dim]
    books = np.array(seeds, np.int64).reshape(len(seeds), parts, size).transpose(1, 0, 2).copy()

    cut = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: F.slice("vec", i * size + 1, F.lit(size)))
    counted = rows.select(F.posexplode(cut).alias("place", "part")).groupBy("place", "part").agg(F.count("*").alias("weight"))
    tasks = 1 + rows.count() * parts // TASK_PARTS
    table = cut_lineage(counted.repartitionByRange(tasks, "place", "part").sortWithinPartitions("place", "part"))
    for _ in range(rounds):
        for place, entry, j, n, s in _sums(table, books):
            books[place, entry, j] = s // n

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = _numbers(batch.column("vec"), batch.num_rows).reshape(batch.num_rows, parts, size)
            codes, error = np.zeros((batch.num_rows, parts), np.int32), np.zeros(batch.num_rows, np.int64)
            for p in range(parts):
                own = whole[:, p]
                order = np.lexsort(own.T[::-1])
                new = np.concatenate([[True], (own[order][1:] != own[order][:-1]).any(axis=1)])
                entry, far = trie_nearest(own[order][new], books[p])
                back = np.empty(len(order), np.int64)
                back[order] = np.cumsum(new) - 1
                codes[:, p] = entry[back]
                error += far[back]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, codes.size + 1, parts), pa.int32()), pa.array(codes.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), lists, pa.array(error)], ["id", "label", "codes", "error"])

    coded = rows.select("id", "label", "vec").mapInArrow(tidy(code), schema)
    return coded.withColumnsRenamed({"id": id_column, "label": label_column}), books


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components of the codebooks as decimal numbers, by part, entry and place in the part."""
    return hashlib.sha256(",".join(str(x) for x in books.reshape(-1).tolist()).encode()).hexdigest()
