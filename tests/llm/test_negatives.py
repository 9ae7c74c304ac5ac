"""Hard negatives by slots against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from windvane.llm import negatives as N


def plain(rows, every, positives=5, negatives=3, low=50, high=95):
    """Rows of (id, whole numbers, label): windows one by one."""
    out = set()
    for a, va, la in rows:
        if a % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(va, v, strict=True)), i, la == label) for i, v, label in rows if i != a and len(v) == len(va)))
        for p, pid in [(-s, i) for s, i, same in scored if same][:positives]:
            hits = [(-s, i) for s, i, same in scored if not same and low * p <= -100 * s <= high * p][:negatives]
            out |= {(a, pid, k + 1, i, p, s) for k, (s, i) in enumerate(hits)}
    return out


def collected(df):
    return {tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()}


@pytest.mark.parametrize("rows_of_block,anchors_of_block,chunk", [(20, 4, 64), (50, 1000, 200), (4096, 16384, 1 << 21)])
def test_against_brute_force(spark, monkeypatch, rows_of_block, anchors_of_block, chunk):
    """Small blocks cut labels and the whole table on both sides; copies and coarse numbers make ties; one label holds most rows."""
    monkeypatch.setattr(N, "ROWS", rows_of_block)
    monkeypatch.setattr(N, "ANCHORS", anchors_of_block)
    monkeypatch.setattr(N, "CHUNK", chunk)
    rng = np.random.default_rng(3)
    points = np.round(rng.normal(0, 0.3, (160, 5)), 1)
    points[60:100] = points[7]
    labels = ["hot" if i % 3 else f"l{i % 4}" for i in range(160)]
    rows = [(i * 3 - 60, p.tolist(), x) for i, (p, x) in enumerate(zip(points, labels, strict=True))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").repartition(3)
    whole = [(i, [int(np.floor(256 * x)) for x in v], x) for i, v, x in rows]
    want = plain(whole, 7)
    assert len(want) > 40 and collected(N.hard_negatives(table, F.col("id") % 7 == 0)) == want
    wide = plain(whole, 7, 3, 6, 10, 100)
    assert collected(N.hard_negatives(table, F.col("id") % 7 == 0, positives=3, negatives=6, low=10, high=100)) == wide


def test_limits_are_exact(spark):
    """Windows of odd, negative and zero scores: 50 p <= 100 n <= 95 p in whole numbers."""
    for p in (-7, -1, 0, 1, 7, 19, 20, 21):
        rows = [(0, [1 / 256, 0.0], 1), (1, [p / 256, 0.0], 1)] + [(100 + n, [n / 256, 0.0], 2) for n in range(-25, 26)]
        table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
        got = N.hard_negatives(table, F.col("id") == 0, negatives=100)
        assert sorted(r["negative_score"] for r in got.collect()) == [n for n in range(-25, 26) if 50 * p <= 100 * n <= 95 * p]


def test_scores_are_exact():
    rng = np.random.default_rng(0)
    for most in (300, 1 << 26):
        a, b = rng.integers(-most, most, (5, 64)), rng.integers(-most, most, (6, 64))
        assert N.scores(a.astype(np.int32), b.astype(np.int32)).tolist() == [[sum(int(x) * int(y) for x, y in zip(r, s, strict=True)) for s in b] for r in a]


def test_edges(spark):
    inf = float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.6, 0.0], 2), (2, [0.6, 0.0], 2), (3, [0.7, 0.0], None), (4, None, 2),
        (5, [inf, 0.0], 2), (6, [None, 0.0], 2), (7, [], 2), (None, [0.8, 0.0], 2), (8, [0.8], 2), (10, [0.3, 0.3], 3),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    clash = table.selectExpr("*", "'x' AS id", "'y' AS score", "1 AS anchor", "2 AS slot", "3 AS dim", "4 AS vec", "5 AS place")
    got = collected(N.hard_negatives(clash, F.col("id") % 10 == 0))
    # ids that repeat are one row; the other rows of label 2 are not usable; an anchor that is alone with its label gives nothing
    assert got == {(0, 1, 1, 2, 256 * 256, 153 * 256)}
    assert N.hard_negatives(table.limit(0), F.col("id") == 0).count() == 0
    assert N.hard_negatives(table, F.lit(None).cast("boolean")).count() == 0
