"""Hard negatives by slot-decomposed selection.

Every anchor has a few positives, and each positive opens a window of scores: from a share of its own score up to a
larger share of it. The windows of one anchor overlap. Their upper limits cut the scores into disjoint slots, so a row falls
into one slot of an anchor, and the best rows of every slot are all that has to be kept: a window's best rows are the best
ones of its own slot and all lower ones. Tasks keep the top of every slot for a block of anchors and a block of rows,
Spark merges these lists, and a merge from the top slot downwards answers all windows; the lower limit only cuts
the end of an answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windvane.llm.common import release
from windvane.llm.grids import grid_vectors
from windvane.session import cut_lineage, few_rows

ANCHORS = 16_384  # anchors of a block
ROWS = 4096  # rows of a block
CHUNK = 1 << 21  # scores a task holds at a time
_NONE = np.iinfo(np.int64).min


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole-number rows, exact: in double precision where all sums fit it, else in 64-bit integers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def tops(found: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, columns) of the k largest values of each row, leftmost first among equals; values ``_NONE`` do not count. Overwrites ``found``."""
    rows = np.arange(len(found))
    for _ in range(k):
        best = found[rows].argmax(axis=1) if len(rows) < len(found) else found.argmax(axis=1)
        there = found[rows, best] > _NONE
        rows, best = rows[there], best[there]
        if not len(rows):
            return
        yield rows, best
        found[rows, best] = _NONE


def _matrix(vecs: pd.Series) -> np.ndarray:
    return np.stack(vecs.to_numpy()) if len(vecs) else np.zeros((0, 0), np.int32)


def _chunks(anchors: pd.DataFrame, rows: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Anchors with their scores against all rows, few anchors at a time."""
    own = _matrix(rows["vec"])
    step = max(1, CHUNK // max(1, len(rows)))
    for s in range(0, len(anchors), step):
        part = anchors.iloc[s : s + step]
        yield part, scores(_matrix(part["vec"]), own)


def _top_positives(anchors: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    out, rows = [], rows.sort_values("id")
    ids = rows["id"].to_numpy()
    if len(ids):
        for part, found in _chunks(anchors, rows):
            own = part["id"].to_numpy()
            at = np.minimum(np.searchsorted(ids, own), len(ids) - 1)
            same = np.flatnonzero(ids[at] == own)
            found[same, at[same]] = _NONE
            kept = found.copy()
            out += [pd.DataFrame({"anchor": own[i], "id": ids[j], "score": kept[i, j]}) for i, j in tops(found, k)]
    return pd.concat(out) if out else pd.DataFrame({"anchor": [], "id": [], "score": []}, dtype="int64")


def _top_slots(anchors: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    out, rows = [], rows.sort_values("id")
    ids = rows["id"].to_numpy()
    codes, _ = pd.factorize(pd.concat([rows["label"], anchors["label"]], ignore_index=True))
    of_rows, anchors = codes[: len(rows)], anchors.assign(_code=codes[len(rows) :])
    if len(ids):
        for part, found in _chunks(anchors, rows):
            own, other = part["id"].to_numpy(), part["_code"].to_numpy()[:, None] != of_rows[None, :]
            least = part["least"].to_numpy()[:, None]
            uppers = part["uppers"].tolist()  # descending
            for slot in range(max(len(u) for u in uppers)):
                upper = np.array([u[slot] if slot < len(u) else _NONE for u in uppers])[:, None]
                lower = np.array([u[slot + 1] if slot + 1 < len(u) else _NONE for u in uppers])[:, None]
                kept = np.where(other & (found <= upper) & (found > lower) & (found >= least), found, _NONE)
                out += [pd.DataFrame({"anchor": own[i], "slot": slot, "id": ids[j], "score": found[i, j]}) for i, j in tops(kept, k)]
    return pd.concat(out) if out else pd.DataFrame({"anchor": [], "slot": [], "id": [], "score": []}, dtype="int64")


def _best(df: DataFrame, keys: list[str], k: int, name: str = "place") -> DataFrame:
    """The k rows of each key with the highest score, smaller ids first among equals; tasks cut their own lists before the shuffle."""
    line = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return df.withColumn(name, F.row_number().over(line)).where(F.col(name) <= k)


def _dealt(df: DataFrame, blocks: Column | int, name: str, salt: int) -> DataFrame:
    return df.withColumn(name, F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(blocks).cast("long") if isinstance(blocks, int) else blocks))


def _every(df: DataFrame, blocks: Column | int, name: str) -> DataFrame:
    """Each row once for every block of the other side."""
    blocks = F.lit(blocks).cast("long") if isinstance(blocks, int) else blocks
    return df.withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))


def hard_negatives(
    vectors: DataFrame, anchors: Column, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
    positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` is a condition on the id, named ``id``. Scores are inner products of floor(scale * x). An anchor's positives are its ``positives`` best other rows of
    its label; a positive's negatives are the ``negatives`` best rows of other labels with ``low`` to ``high`` hundredths of the positive's
    score (limits included; nothing fits a negative score). Equal scores go by the smaller id.

    Rows without an id or a label take no part, nor do vectors that are null, empty or hold a null or a non-finite number.
    Only vectors of equal length are compared. Rows that repeat an id are one row (the smallest by label and numbers). An anchor without positives, and a
    window without rows, give nothing; an empty table gives an empty result. Other columns are not read.
    """
    rows = grid_vectors(vectors, id_column, vector_column, label_column, scale).where("id is not null and label is not null")
    if rows.groupBy("id").count().where("count > 1").limit(1).count():
        rows = rows.groupBy("id").agg(F.min(F.struct("label", "vec")).alias("r")).select("id", "r.label", "r.vec")
    rows = cut_lineage(rows.withColumn("dim", F.size("vec")).withColumn("anchor", F.coalesce(anchors, F.lit(False))))
    asked = rows.where("anchor").drop("anchor")

    # positives: blocks of one label and length; a large label is cut into several on both sides
    sizes = rows.groupBy("label", "dim").agg(F.ceil(F.count("*") / ROWS).alias("r_blocks"), F.ceil(F.count_if("anchor") / ANCHORS).alias("a_blocks"))
    sizes = few_rows(sizes.where("a_blocks > 0"))
    keys = ["label", "dim", "a", "r"]
    left = _every(_dealt(asked.join(sizes, ["label", "dim"]), F.col("a_blocks"), "a", 1), F.col("r_blocks"), "r").select(*keys, "id", "vec")
    right = _every(_dealt(rows.join(sizes, ["label", "dim"]), F.col("r_blocks"), "r", 2), F.col("a_blocks"), "a").select(*keys, "id", "vec")

    def near(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        try:
            return _top_positives(a, b, positives)
        finally:
            release()

    found = left.groupBy(*keys).cogroup(right.toDF(*right.columns).groupBy(*keys)).applyInPandas(near, "anchor long, id long, score long")
    chosen = cut_lineage(_best(found, ["anchor"], positives).select("anchor", "id", "score"))

    # windows: 100 n <= high p and 100 n >= low p in whole numbers
    upper, least = F.expr(f"(score * {high} - pmod(score * {high}, 100)) div 100"), F.expr(f"(score * {low} + pmod(-score * {low}, 100)) div 100")
    windows = chosen.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), upper.alias("upper"), least.alias("least"))
    windows = windows.where("least <= upper")
    limits = windows.groupBy("anchor").agg(F.sort_array(F.collect_set("upper"), asc=False).alias("uppers"), F.min("least").alias("least"))
    asked = asked.join(limits.withColumnRenamed("anchor", "id"), "id")

    totals = rows.groupBy("dim").agg(F.ceil(F.count("*") / ROWS).alias("r_blocks"), F.ceil(F.count_if("anchor") / ANCHORS).alias("a_blocks"))
    totals = few_rows(totals.where("a_blocks > 0"))
    keys = ["dim", "a", "r"]
    left = _every(_dealt(asked.join(totals, "dim"), F.col("a_blocks"), "a", 3), F.col("r_blocks"), "r").select(*keys, "id", "label", "vec", "uppers", "least")
    right = _every(_dealt(rows.join(totals, "dim"), F.col("r_blocks"), "r", 4), F.col("a_blocks"), "a").select(*keys, "id", "label", "vec")

    def slotted(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        try:
            return _top_slots(a, b, negatives)
        finally:
            release()

    found = left.groupBy(*keys).cogroup(right.toDF(*right.columns).groupBy(*keys)).applyInPandas(slotted, "anchor long, slot long, id long, score long")
    slots = _best(found, ["anchor", "slot"], negatives)

    # one descending line per anchor: at most ``positives`` slots of ``negatives`` rows; a window starts at its own slot
    line = F.sort_array(F.collect_list(F.struct((-F.col("slot")).alias("s"), "score", (-F.col("id")).alias("i"))), asc=False)
    lines = slots.groupBy("anchor").agg(line.alias("line"))
    own = F.slice(F.filter("line", lambda x: x["score"] <= F.col("upper")), 1, negatives)
    answers = windows.join(lines, "anchor").withColumn("own", F.filter(own, lambda x: x["score"] >= F.col("least")))
    return answers.select("anchor", "positive_id", "positive_score", F.posexplode("own").alias("rank", "n")).select(
        F.col("anchor").alias("anchor_id"), "positive_id", (F.col("rank") + 1).cast("int").alias("rank"),
        (-F.col("n.i")).alias("negative_id"), "positive_score", F.col("n.score").alias("negative_score"),
    )
