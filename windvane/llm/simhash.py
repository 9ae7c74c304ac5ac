"""Near duplicates by SimHash: fingerprints, and a self-join of their binary trie.

Fingerprints that differ in at most ``max_bits`` bits are linked; a document belongs to the component of its
fingerprint. Equal fingerprints are one trie key, so copies cost nothing beyond their own rows.

The join walks the trie against itself: a node pair stands for two bit prefixes, its error is the number of
bits in which they differ, its children are the (up to) four pairs of child nodes, and a pair whose error
exceeds the budget is dropped with all below it. Two tries hold the keys, one with either half of the bits
first: of at most ``max_bits`` differing bits one half holds at most ``max_bits // 2``, so each trie allows
only that many errors over its first 32 levels, and every link is found in at least one.

Over the cluster a trie is cut into pages: sorted runs of at most ``PAGE_KEYS`` keys below one node. Page
pairs whose nodes exceed the budget are dropped by the same bound; each other pair is one group, holds two
pages at most, and returns a spanning forest of the links it finds rather than the links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windvane.llm.common import components, forest, numbered, release, text_slices, tidy
from windvane.session import broadcast_if_small, cut_lineage

PAGE_KEYS = 8192
FRONTIER = 1 << 21  # node pairs expanded at a time
_SIGN = np.uint64(1 << 63)


def simhash64(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """Fingerprint of a text in UTF-8: majority bits of the XXH64 of its word shingles, repeats included.

    A-Z are lower-cased; words are runs without ASCII white space. With fewer words than ``shingle`` the whole
    sequence is the one shingle; without words the fingerprint is zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
    ends = ends[-n:].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, n, 65536):
        spans = zip(starts[k : k + 65536], ends[k : k + 65536], strict=True)
        h = np.fromiter((digest(joined[a:b], seed) for a, b in spans), "<u8", min(65536, n - k))
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_column: str, text_column: str, shingle: int = 4) -> DataFrame:
    """(id, fp): the fingerprint of every row as a signed long; a null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            raw = part.column("text").cast(pa.binary()).to_pylist()
            fps = np.array([simhash64(t or b"", shingle) for t in raw], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(fps)], ["id", "fp"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(tidy(run), f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading bits in which 64-bit keys agree."""
    x = a ^ b
    for shift in (1, 2, 4, 8, 16, 32):
        x = x | (x >> np.uint64(shift))
    return 64 - np.bitwise_count(x).astype(np.int64)


def _pages(keys: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """A sorted run of different keys cut at trie nodes into runs of at most ``limit`` keys."""
    todo = [keys]
    while todo:
        run = todo.pop()
        if len(run) <= limit:
            yield run
            continue
        bit = np.uint64(63 - int(_common(run[:1], run[-1:])[0]))
        middle = int(np.searchsorted(run, run[-1] >> bit << bit))
        todo += [run[middle:], run[:middle]]


def _node_ids(keys: np.ndarray) -> np.ndarray:
    """Common bits of each key with the one before; -1 for the first."""
    return np.concatenate([[-1], _common(keys[1:], keys[:-1])])


class _Level:
    """Nodes of one level of a sorted run's trie: the key range and the child per bit (-1: none) of each."""

    def __init__(self, keys: np.ndarray, common: np.ndarray, level: int):
        self.first = np.flatnonzero(common < level)
        self.last = np.append(self.first[1:], len(keys)) - 1
        if level < 64:
            ids = np.cumsum(common < level + 1) - 1
            bit = np.uint64(63 - level)
            one = (keys[self.last] >> bit) & np.uint64(1) == 1
            zero = (keys[self.first] >> bit) & np.uint64(1) == 0
            self.child = (np.where(zero, ids[self.first], -1), np.where(one, ids[self.last], -1))


def trie_links(a: np.ndarray, b: np.ndarray | None, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of index pairs (i into a, j into b, or into a too if b is None) of sorted keys within the budget."""
    same = b is None
    b = a if same else b
    if not len(a) or not len(b):
        return
    common_a, common_b = _node_ids(a), _node_ids(b)
    if same:
        start = int(_common(a[:1], a[-1:])[0])
    else:
        ends = np.array([a[0], a[-1], b[0], b[-1]])
        start = int(_common(ends.min(keepdims=True), ends.max(keepdims=True))[0])
    levels: dict[int, tuple[_Level, _Level]] = {}

    def level(k: int) -> tuple[_Level, _Level]:
        if k not in levels:
            mine = _Level(a, common_a, k)
            levels[k] = (mine, mine if same else _Level(b, common_b, k))
        return levels[k]

    todo = [(start, np.zeros(1, np.int32), np.zeros(1, np.int32), np.zeros(1, np.int8))]
    while todo:
        k, x, y, err = todo.pop()
        if len(x) > FRONTIER:
            todo += [(k, x[s : s + FRONTIER], y[s : s + FRONTIER], err[s : s + FRONTIER]) for s in range(0, len(x), FRONTIER)]
            continue
        la, lb = level(k)
        single = (la.first[x] == la.last[x]) & (lb.first[y] == lb.last[y])
        if k == 64 or single.any():
            i, j = la.first[x[single]], lb.first[y[single]]
            differ = a[i] ^ b[j]
            near = np.bitwise_count(differ) <= max_bits
            near &= i < j if same else True
            if near.any():
                yield i[near], j[near]
            x, y, err = x[~single], y[~single], err[~single]
        if k == 64 or not len(x):
            continue
        budget = max_bits // 2 if k < 32 else max_bits
        found = []
        for p in (0, 1):
            for q in (0, 1):
                keep = np.ones(len(x), bool) if p == q else err < budget
                if same and (p, q) == (1, 0):
                    keep &= x != y
                cx, cy = la.child[p][x[keep]], lb.child[q][y[keep]]
                both = (cx >= 0) & (cy >= 0)
                found.append((cx[both].astype(np.int32), cy[both].astype(np.int32), err[keep][both] + np.int8(p != q)))
        x, y, err = (np.concatenate(c) for c in zip(*found, strict=True))
        if len(x):
            todo.append((k + 1, x, y, err))


def _errors(differ: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Set bits among the first ``bits`` of each word."""
    shift = (64 - np.maximum(bits, 1)).astype(np.uint64)
    return np.where(bits > 0, np.bitwise_count(differ >> shift), 0)


def _turned(fp: np.ndarray, rotation: int) -> np.ndarray:
    return fp if rotation == 0 else (fp << np.uint64(32)) | (fp >> np.uint64(32))


def fingerprint_links(keys: DataFrame, max_bits: int, page_keys: int = PAGE_KEYS) -> DataFrame:
    """(u, v): edges that connect the different fingerprints ``fp`` of a frame just as all links within ``max_bits`` do."""
    turned = F.when(F.col("rotation") == 0, F.col("fp")).otherwise(
        F.shiftleft("fp", 32).bitwiseOR(F.shiftrightunsigned("fp", 32))
    )
    # the sign bit is flipped so that the order of longs is the order of the bits
    ordered = (
        keys.select("fp", F.explode(F.array(F.lit(0), F.lit(1))).alias("rotation"))
        .select("rotation", turned.bitwiseXOR(F.lit(-(1 << 63)).cast("long")).alias("key"))
        .repartitionByRange("rotation", "key")
        .sortWithinPartitions("rotation", "key")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, turn = TaskContext.get().partitionId() << 32, np.zeros(0, np.uint64), 0

        def emit(run: np.ndarray) -> pa.RecordBatch:
            nonlocal number
            rows = list(_pages(run, page_keys))
            first = np.array([r[0] for r in rows], np.uint64)
            depth = np.array([int(_common(r[:1], r[-1:])[0]) for r in rows], np.int32)
            ids = np.arange(number, number + len(rows))
            number += len(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(np.full(len(rows), turn, np.int32)), pa.array(depth), pa.array(first.view(np.int64)),
                 pa.array([r.tobytes() for r in rows], pa.binary())],
                ["page", "rotation", "depth", "first", "keys"],
            )

        for batch in batches:
            rotation = batch.column("rotation").to_numpy()
            key = batch.column("key").to_numpy().view(np.uint64) ^ _SIGN
            for r in (0, 1):
                part = key[rotation == r]
                if not len(part):
                    continue
                if r != turn and len(held):
                    yield emit(held)
                    held = np.zeros(0, np.uint64)
                turn, held = r, np.concatenate([held, part])
                if len(held) > 8 * page_keys:
                    yield emit(held)
                    held = np.zeros(0, np.uint64)
        if len(held):
            yield emit(held)

    pages = cut_lineage(ordered.mapInArrow(tidy(cut), "page long, rotation int, depth int, first long, keys binary"))
    known = pages.select("page", "rotation", "depth", "first").toPandas()  # one small row for thousands of keys
    page, rotation = known["page"].to_numpy(np.int64), known["rotation"].to_numpy(np.int64)
    depth, first = known["depth"].to_numpy(np.int64), known["first"].to_numpy(np.int64).view(np.uint64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shared = np.minimum(depth, row["depth"])
                differ = first ^ np.uint64(row["first"] % (1 << 64))
                upper, lead = _errors(differ, shared), _errors(differ, np.minimum(shared, 32))
                with_ = page[(rotation == row["rotation"]) & (upper <= max_bits) & (lead <= max_bits // 2)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(with_, row["page"])), pa.array(np.maximum(with_, row["page"])),
                     pa.array(np.full(len(with_), row["page"])), pa.array(np.full(len(with_), row["rotation"], np.int32)),
                     pa.array([row["keys"]] * len(with_), pa.binary())],
                    ["a", "b", "page", "rotation", "keys"],
                )

    def join(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("page")
        runs = [np.frombuffer(k, np.uint64) for k in group["keys"]]
        a, b = runs[0], (runs[1] if len(runs) > 1 else None)
        every, shift = (a, 0) if b is None else (np.concatenate(runs), len(a))
        label = forest(len(every), ((i, j + shift) for i, j in trie_links(a, b, max_bits)))
        hung = np.flatnonzero(label != np.arange(len(every)))
        turn = int(group["rotation"].iloc[0])
        u, v = _turned(every[hung], turn), _turned(every[label[hung]], turn)
        if len(every) > page_keys:
            release()
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    dealt = pages.mapInArrow(tidy(deal), "a long, b long, page long, rotation int, keys binary")
    return dealt.groupBy("a", "b").applyInPandas(join, "u long, v long")


def simhash_near_dups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 4, max_bits: int = 4
) -> DataFrame:
    """(id, fingerprint, component_id) for every row of ``docs``.

    Null and empty texts, and texts without words, have fingerprint zero and link like any other. Repeated rows
    are rows of their own. ``component_id`` is the smallest id reachable; null ids are ignored for it, and a
    component of null ids only has none. An empty table gives an empty result; other columns are not read.
    """
    rows = cut_lineage(fingerprints(docs, id_column, text_column, shingle))
    keys = rows.groupBy("fp").agg(F.min("id").alias("first_id"))
    tree = components(fingerprint_links(keys.select("fp"), max_bits))
    rooted = keys.join(tree, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    # stored, so that adaptive execution can split the rows of a large component in the join
    least = cut_lineage(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")))
    named = rooted.join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(
        F.col("id").alias(id_column), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def first_of_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of every component, with its columns unchanged: the one with the smallest id (rows without id come last).

    Rows are told apart by their place in ``docs``, so repeated rows and ids are dropped like other copies. ``docs`` must give the
    same rows in the same places when it is read again, as a stored table does. The rows to drop are broadcast when they were
    measured small; otherwise the rows are joined by place.
    """
    rows, names = numbered(docs)
    placed, key = rows.withColumn("__place", F.monotonically_increasing_id()), F.col(names[id_column])
    order = F.struct(key.isNull().alias("none"), key.alias("id"), F.col("__place").alias("place"))
    found = simhash_near_dups(placed.select(order.alias("row"), F.col(names[text_column]).alias("text")), "row", "text", shingle, max_bits)
    dropped = cut_lineage(found.where(F.col("row") != F.col("component_id")).select(F.col("row.place").alias("__place")))
    return placed.join(broadcast_if_small(dropped), "__place", "left_anti").select(*names.values()).toDF(*docs.columns)
