"""Stored histories, tables kept up to date, sketches, and neighbours by hash tables."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from windvane.operators import hashed_neighbours, incremental, labels, neighbours, nulls, sketches, windows
from windvane.sources import stored

START = dt.datetime(2021, 3, 1)


def _signals(spark, n=400):
    rnd = np.random.default_rng(8)
    rows = [
        (int(rnd.integers(0, 6)), START + dt.timedelta(minutes=int(m)), float(rnd.normal()), None if rnd.random() < 0.4 else float(i), int(rnd.random() < 0.1))
        for i, m in enumerate(rnd.permutation(n * 60)[:n])
    ]
    rows.append((None, START, 1.0, 1.0, 0))
    return spark.createDataFrame(rows, "k int, ts timestamp_ntz, a double, b double, flag int")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_history_is_scanned_without_a_shuffle(spark, rows, tmp_path):
    s = _signals(spark)
    stored.write_history(s, str(tmp_path / "h"), "k", "ts", 4)
    t = stored.read_history(spark, str(tmp_path / "h"))
    assert rows(t) == rows(s) and t.schema == s.schema
    assert len([f for f in os.listdir(tmp_path / "h") if f.endswith(".parquet")]) <= 4
    for scan in (
        lambda df: nulls.backfill(df, ["b"], ["ts"], ["k"]),
        lambda df: labels.next_failure_date(df, "flag", "k", "ts"),
        lambda df: windows.rolling_mean(df, ["a"], ["k"], ["ts"], 5),
        lambda df: df.groupBy("k").agg(F.max("a")),
    ):
        assert "Exchange" not in _plan(scan(t)) and "Exchange" in _plan(scan(s))
        assert rows(scan(t)) == rows(scan(s))


@pytest.mark.parametrize("window", [1, 4])
def test_updates_equal_a_full_run(spark, tmp_path, window):
    """Late rows, a machine that appears later, gaps of many days, and a delivery that comes twice."""
    rnd = np.random.default_rng(3)
    days = [d for d in range(60) if not 20 <= d < 45]
    rows = [(k, START + dt.timedelta(days=int(d), hours=int(h)), float(rnd.normal()), None if h == 3 else 1.0) for k in "ABC" for d in days for h in (1, 3, 7) if k != "C" or d > 50]
    parts = [[r for i, r in enumerate(rows) if (3 if i % 41 == 0 else r[1].month - 3) == n] for n in range(4)]
    schema = "k string, ts timestamp_ntz, x double, y double"
    table = incremental.DailyTable(str(tmp_path / "t"), ("k",), "ts", ("x", "y"), window)
    for n in (0, 1, 1, 3):
        before = {p: os.path.getmtime(tmp_path / "t" / "features" / p) for p in os.listdir(tmp_path / "t" / "features")} if n == 3 else {}
        more = [(None, START, 5.0, 5.0), ("A", None, 5.0, 5.0)]
        table.update(f"d{n}", spark.createDataFrame([*parts[n], *more], schema))
    files = {p: os.path.getmtime(tmp_path / "t" / "features" / p) for p in before if p.startswith("Date=")}
    every = spark.createDataFrame(rows, schema).groupBy("k", F.to_date("ts").alias("Date")).agg(F.avg("x").alias("x"), F.avg("y").alias("y"))
    want = windows.add_rolling_features(every, ["x", "y"], ["k"], ["Date"], window).toPandas().sort_values(["k", "Date"])
    got = table.read(spark).toPandas().sort_values(["k", "Date"])[want.columns]
    assert got[["k", "Date"]].to_numpy().tolist() == want[["k", "Date"]].to_numpy().tolist()
    np.testing.assert_allclose(got.drop(columns=["k", "Date"]).to_numpy(float), want.drop(columns=["k", "Date"]).to_numpy(float), atol=1e-9)
    if window == 1:  # only the days of late rows were written again
        late = {f"Date={r[1].date()}" for r in parts[3]}
        assert {p for p, at in files.items() if at != before[p]} == late & set(before) and len(late) < len(before)


def test_distinct_counts_of_spans(spark):
    rows = [(i % 7, START + dt.timedelta(hours=i), i % 900, None if i % 2 else "x") for i in range(4000)]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, v int, w string")
    daily = sketches.distinct_sketches(df, ["k"], "ts", ["v", "w"]).cache()
    assert daily.count() == df.select("k", F.to_date("ts")).distinct().count()
    for end in ("2021-04-01", "2030-01-01"):
        exact = df.filter(F.col("ts") < F.lit(end)).groupBy("k").agg(F.count_distinct("v"), F.count_distinct("w"))
        found = {r["k"]: (r["v"], r["w"]) for r in sketches.distinct_over(daily.filter(F.col("Date") < F.lit(end)), ["k"], ["v", "w"]).collect()}
        for k, v, w in exact.collect():
            assert abs(found[k][0] - v) <= 1 + 5 * sketches.DISTINCT_ERROR * v and found[k][1] == w


def test_quantiles_of_merged_sketches(spark):
    rnd = np.random.default_rng(0)
    values = np.concatenate([rnd.normal(size=9000), np.full(3000, 0.25)])
    rows = [(i % 3, START + dt.timedelta(minutes=i), float(v)) for i, v in enumerate(values)] + [(0, START, None), (0, START, float("nan")), (9, START, None)]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, v double")
    daily = sketches.quantile_sketches(df, ["k"], "ts", ["v"])
    found = sketches.quantiles_over(daily, [], "v", [0.1, 0.5, 0.9]).first()
    assert found["n"] == len(values)
    for p, q in zip((0.1, 0.5, 0.9), found["quantiles"], strict=True):
        assert (values < q).mean() <= p + 2 * sketches.RANK_ERROR and (values <= q).mean() >= p - 2 * sketches.RANK_ERROR
    by = {r["k"]: r for r in sketches.quantiles_over(daily, ["k"], "v", [0.5]).collect()}
    assert by[9]["quantiles"] is None and by[9]["n"] in (0, None) and sum(by[k]["n"] for k in range(3)) == len(values)


def _vectors(spark, n, q, dims=24, copies=0):
    rnd = np.random.default_rng(5)
    centres = rnd.normal(size=(12, dims)) * 2
    x = centres[rnd.integers(0, 12, n + q)] + rnd.normal(size=(n + q, dims))
    if copies:
        x[:copies] = x[0]
    train = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(x[:n])], "id long, x array<double>, y int")
    return train, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x[n:])], "q long, x array<double>"), x[:n], x[n:]


@pytest.mark.parametrize("block", [8192, 40])
def test_hashed_neighbours(spark, block):
    """Distances are exact, ranks follow them, and nine of ten true neighbours are found; copies and large cells are no special case."""
    train, test, x, y = _vectors(spark, 700, 60, copies=250)
    found = hashed_neighbours.nearest_approximate(train, test, "x", "y", "id", ["q"], 5, block_rows=block).cache()
    pdf = found.toPandas().sort_values(["q", "rank"])
    gaps = np.sqrt(((y[:, None, :] - x[None]) ** 2).sum(-1))
    np.testing.assert_allclose(pdf["distance"], gaps[pdf["q"], pdf["neighbour"]])
    assert pdf.groupby("q")["rank"].apply(list).tolist() == [[1, 2, 3, 4, 5]] * 60
    assert not pdf.duplicated(["q", "neighbour"]).any()
    exact = neighbours.nearest(train, test, "x", "y", "id", ["q"], 5)
    assert hashed_neighbours.recall(found, exact, ["q"]) >= 0.9


def test_queries_without_candidates_are_answered_exactly(spark):
    """With cells so narrow that nothing is shared the exact form answers."""
    train, test, _, _ = _vectors(spark, 80, 10)
    found = hashed_neighbours.nearest_approximate(train, test, "x", "y", "id", ["q"], 3, tables=1, probes=1, width=1e-6)
    exact = neighbours.nearest(train, test, "x", "y", "id", ["q"], 3)
    assert sorted(map(tuple, found.select("q", "neighbour", "rank").collect())) == sorted(map(tuple, exact.select("q", "neighbour", "rank").collect()))


def test_probes_start_at_the_own_cell():
    tables = hashed_neighbours.Tables(6, 3, 4, 0.7)
    x = np.random.default_rng(1).normal(size=(20, 6))
    keys = tables.probes(x, 9)
    assert (keys[:, :, 0] == tables.keys(tables.cells(x)[0])).all() and keys.shape == (20, 3, 9)
    assert all(len(set(k)) == 9 for row in keys for k in row)
