"""Joins, time to failure, splits, windows and scaling on hand-made fixtures and against pandas."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from windvane import session as S
from windvane.operators import joins, labels, scaling, splits, windows
from windvane.operators.aggregates import class_balance, correlation_matrix, describe, histogram

DAY = dt.datetime(2020, 1, 1)


def at(days=0.0, minutes=0.0):
    return DAY + dt.timedelta(days=days, minutes=minutes)


@pytest.fixture
def large(monkeypatch):
    """Every side counts as too large for a broadcast."""
    monkeypatch.setattr(S, "MAX_BROADCAST_BYTES", 0)


def _signals(spark):
    rows = [(at(minutes=10 * i), "A", float(i)) for i in range(4)] + [(at(minutes=10 * i), "B", 10.0 + i) for i in range(3)]
    return spark.createDataFrame(rows, "Timestamp timestamp_ntz, Turbine_ID string, x double")


def _failures(spark):
    rows = [(at(minutes=10), "A", "GEN"), (at(minutes=15), "A", "GEN"), (at(minutes=10), "B", "OIL")]
    return spark.createDataFrame(rows, "Timestamp timestamp_ntz, Turbine_ID string, Component string")


WANT_OUTER = sorted(
    [(at(minutes=10 * i), "A", float(i), int(i == 1)) for i in range(4)]
    + [(at(minutes=10 * i), "B", 10.0 + i, 0) for i in range(3)] + [(at(minutes=15), "A", 0.0, 1)], key=str)


def test_outer_join_small(spark, rows):
    out = joins.join_outer_keys(_signals(spark), _failures(spark), "GEN", ["Timestamp", "Turbine_ID"])
    assert rows(out, "Timestamp", "Turbine_ID", "x", "Component") == WANT_OUTER


def test_outer_join_large(spark, rows, large):
    out = joins.join_outer_keys(_signals(spark), _failures(spark), "GEN", ["Timestamp", "Turbine_ID"])
    assert rows(out, "Timestamp", "Turbine_ID", "x", "Component") == WANT_OUTER
    keep = joins.join_outer_keys(_signals(spark), _failures(spark), "GEN", ["Timestamp", "Turbine_ID"], zero_fill=False)
    assert keep.filter(F.col("x").isNull()).count() == 1


def test_asof_edges(spark):
    left = spark.createDataFrame([(1, at(0)), (2, at(1)), (3, at(2, 7)), (4, at(9))], "i int, t timestamp_ntz")
    right = spark.createDataFrame([(at(1), 1.0), (at(2), 2.0), (at(2, 10), 3.0)], "rt timestamp_ntz, v double")
    values = lambda **kw: [r["v"] for r in joins.join_asof(left, right, "t", right_ts="rt", **kw).orderBy("i").collect()]
    for limit in (None, 2):
        assert values(task_rows=limit) == [None, 1.0, 2.0, 3.0]
        assert values(direction="forward", task_rows=limit) == [1.0, 1.0, 3.0, None]
        assert values(direction="nearest", task_rows=limit) == [1.0, 1.0, 3.0, 3.0]
        assert values(tolerance_minutes=5, task_rows=limit) == [None, 1.0, None, None]


def test_asof_matches_pandas(spark):
    rnd = random.Random(2)
    left = [(i, rnd.choice("ABB"), at(rnd.randrange(0, 400) / 40)) for i in range(300)]
    right = [(rnd.choice("ABC"), at(k / 40 + 0.003 * (k % 2)), float(k)) for k in rnd.sample(range(400), 120)]
    lp = pd.DataFrame(left, columns=["i", "k", "t"]).sort_values("t")
    rp = pd.DataFrame(right, columns=["k", "t", "v"]).sort_values("t")
    ls = spark.createDataFrame(left, "i int, k string, t timestamp_ntz")
    rs = spark.createDataFrame(right, "k string, rt timestamp_ntz, v double")
    for direction in ("backward", "forward", "nearest"):
        want = pd.merge_asof(lp, rp, on="t", by="k", direction=direction, tolerance=pd.Timedelta(hours=5)).sort_values("i")["v"]
        for limit in (None, 25):
            got = joins.join_asof(ls, rs, "t", ["k"], direction, 300, "rt", limit).orderBy("i").toPandas()["v"]
            np.testing.assert_array_equal(got.to_numpy(dtype=float), want.to_numpy(dtype=float))


def _history(spark):
    rnd = random.Random(9)
    sig = [(i, at(rnd.randrange(0, 3000) / 100), rnd.choice(["T1", "T1", "T2"])) for i in range(200)]
    fail = [(at(rnd.randrange(0, 3000) / 100), rnd.choice(["T1", "T2", "T3"]), rnd.choice(["GEN", "OIL"])) for _ in range(25)]
    return sig, fail


def test_horizon_join_and_flags(spark, rows, monkeypatch):
    sig, fail = _history(spark)
    days = lambda f, s: round((f - s).total_seconds() / 86400, 2)
    want = sorted([(i, f, days(f, t)) for i, t, k in sig for f, k2, _ in fail if k == k2 and 2 <= days(f, t) <= 9], key=str)
    s = spark.createDataFrame(sig, "i int, Timestamp timestamp_ntz, Turbine_ID string")
    f = spark.createDataFrame(fail, "Timestamp timestamp_ntz, Turbine_ID string, Component string")
    assert rows(joins.join_horizon(s, f, "Turbine_ID", lower=2, upper=9), "i", "failure_ts", "days_to_failure") == want
    monkeypatch.setattr(S, "MAX_BROADCAST_BYTES", 0)
    assert rows(joins.join_horizon(s, f, "Turbine_ID", lower=2, upper=9), "i", "failure_ts", "days_to_failure") == want
    flags = lambda c: {i for i, t, k in sig for f, k2, c2 in fail if k == k2 and c == c2 and 2 <= days(f, t) <= 9}
    for limit in (None, 20):
        out = labels.horizon_flags_per_component(s, f, ["GEN", "OIL"], 9, task_rows=limit)
        got = {r["i"]: (r["Fail_9_GEN"], r["Fail_9_OIL"]) for r in out.collect()}
        assert got == {i: (int(i in flags("GEN")), int(i in flags("OIL"))) for i, _, _ in sig}


def test_horizon_borders(spark):
    """The rounded day counts 2.00 and 9.00 are inside, the next hundredth is outside."""
    s = spark.createDataFrame([(0, DAY, "T")], "i int, Timestamp timestamp_ntz, Turbine_ID string")
    exact = lambda d: DAY + dt.timedelta(microseconds=round(d * 86_400_000_000))
    for days, inside in ((1.994999, 0), (1.995, 1), (2.0, 1), (9.005, 1), (9.0050001, 0)):
        f = spark.createDataFrame([(exact(days), "T", "GEN")], "Timestamp timestamp_ntz, Turbine_ID string, Component string")
        assert labels.horizon_flags_per_component(s, f, ["GEN"], 9).first()["Fail_9_GEN"] == inside
        assert joins.join_horizon(s, f, "Turbine_ID", lower=2, upper=9).count() == inside


def test_time_to_failure(spark):
    rows = [("A", at(0), 0), ("A", at(2.5), 0), ("A", at(4), 1), ("A", at(4), 0), ("A", at(6), 0), ("B", at(1), 0)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, flag int")
    for limit in (None, 2):
        out = labels.time_to_failure(df, "flag", "k", "t", task_rows=limit).orderBy("k", "t", "flag").collect()
        assert [r["TTF"] for r in out] == [4.0, 2.0, 0.0, 0.0, 0.0, 0.0]
    floor = labels.ttf_floor_days(df, "flag", "k", "t").orderBy("k", "t", "flag").collect()
    assert [r["TTF"] for r in floor] == [4, 1, 0, 0, None, None]
    only = labels.time_to_failure(df, "flag", "k", "t", entities=["B"])
    assert only.count() == 1
    marked = labels.horizon_labels(labels.time_to_failure(df, "flag", "k", "t"), "TTF", [3], lower=None)
    assert marked.filter("`3_days` = 1").count() == 5


def test_split_by_last_row(spark):
    data = [("A", dt.date(2020, 1, 1)), ("A", dt.date(2020, 6, 30)), ("B", dt.date(2020, 1, 1)), ("B", dt.date(2020, 5, 31))]
    df = spark.createDataFrame(data, "k string, Date date")
    train, test = splits.split_by_months(df, "Date", 3, ["k", "Date"])
    assert (train.count(), test.count()) == (2, 2)  # cut 2020-02-29
    _train, test = splits.split_by_months(df, "Date", 3, ["k", "Date"], global_max=True)
    assert test.count() == 2
    cut_at_end = spark.createDataFrame([("A", dt.date(2020, 2, 28)), ("B", dt.date(2020, 5, 31))], "k string, Date date")
    train, _test = splits.split_by_months(cut_at_end, "Date", 3, ["k", "Date"])
    assert train.count() == 1
    train, _test = splits.split_by_months(df, "Date", order=["k", "Date"], days=200)
    assert train.count() == 0


def test_fraction_and_range(spark):
    df = spark.createDataFrame([(i,) for i in range(11)], "i int")
    for limit in (None, 3):
        train, test = splits.split_by_fraction(df, 0.8, ["i"], limit)
        assert sorted(r["i"] for r in train.collect()) == list(range(8)) and test.count() == 3
        assert sorted(r["i"] for r in splits.take_range(df, 2, 5, ["i"], limit).collect()) == [2, 3, 4]


def test_rolling_matches_pandas(spark):
    rnd = np.random.default_rng(1)
    pdf = pd.DataFrame({"k": rnd.choice(["A", "B"], 90), "i": range(90), "x": rnd.normal(size=90)})
    pdf = pd.concat([pdf, pd.DataFrame({"k": ["C"], "i": [90], "x": [1.0]})])
    by = pdf.sort_values(["k", "i"]).groupby("k")["x"].rolling(7, min_periods=1)
    for limit in (None, 10):
        got = windows.add_rolling_features(spark.createDataFrame(pdf), ["x"], ["k"], ["i"], 7, task_rows=limit).orderBy("k", "i").toPandas()
        np.testing.assert_allclose(got["x_av"], by.mean().to_numpy())
        np.testing.assert_allclose(got["x_sd"], by.std().fillna(0).to_numpy(), atol=1e-12)
    assert list(got.columns) == ["k", "i", "x", "x_av", "x_sd"]


def test_sequences(spark):
    df = spark.createDataFrame([("A", i, float(i), i * 10) for i in range(6)] + [("B", i, 0.0, 0) for i in range(3)], "k string, i int, x double, y int")
    for limit in (None, 3):
        out = windows.sliding_sequences(df, ["x"], "y", "k", ["i"], 3, task_rows=limit).orderBy("k", "start").collect()
        assert [(r["k"], r["start"], [v[0] for v in r["X"]], r["y"]) for r in out] == [
            ("A", 0, [0.0, 1.0, 2.0], 20), ("A", 1, [1.0, 2.0, 3.0], 30), ("A", 2, [2.0, 3.0, 4.0], 40)]
    drawn = windows.sliding_sequences(df, ["x"], "y", "k", ["i"], 3, n=2, seed=1)
    assert drawn.count() == 2


def test_gaps(spark):
    df = spark.createDataFrame([(at(0),), (at(0, 10),), (at(0, 40),)], "t timestamp_ntz")
    assert [r["delta_seconds"] for r in windows.time_delta(df, "t").orderBy("t").collect()] == [0.0, 600.0, 1800.0]
    assert windows.max_gap(df, "t").first()[0] == 1800.0


def test_scaling(spark):
    df = spark.createDataFrame([("A", 1.0, 7.0), ("A", 3.0, 7.0), ("B", 5.0, 7.0)], "k string, x double, c double")
    out = scaling.apply_scaler(df, scaling.fit_scaler(df, ["x", "c"]), ["x", "c"]).orderBy("x").toPandas()
    want = (np.array([1, 3, 5]) - 3) / np.std([1, 3, 5])
    np.testing.assert_allclose(out["x"], want)
    assert out["c"].tolist() == [0, 0, 0]
    by = scaling.apply_scaler(df, scaling.fit_scaler(df, ["x"], by="k"), ["x"], "k").orderBy("k", "x").collect()
    assert [r["x"] for r in by] == [-1.0, 1.0, None]


def test_grid(spark):
    ents = spark.createDataFrame([("A", at(0), at(2, 15)), ("B", at(1), at(1))], "k string, lo timestamp_ntz, hi timestamp_ntz")
    grid = joins.entity_grid(ents, F.col("lo"), F.col("hi"), 10)
    assert {r["k"]: r["count"] for r in grid.groupBy("k").count().collect()} == {"A": 2 * 144 + 2, "B": 1}
    with pytest.raises(ValueError):
        joins.grid_left_join(grid, grid, ["k"], until="2020-01-01", after="2020-01-01")


def test_summaries(spark):
    pdf = pd.DataFrame({"x": np.round(np.random.default_rng(0).normal(size=333), 3)})
    df = spark.createDataFrame(pdf)
    row = describe(df, ["x"], exact=True).first()
    want = pdf["x"].describe()
    assert [row[c] for c in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")] == pytest.approx(want.tolist())
    counts, edges = np.histogram(pdf["x"], 12)
    got = histogram(df, "x", 12).orderBy("bin").toPandas()
    assert got["n"].tolist() == counts.tolist()
    np.testing.assert_allclose(got["low"], edges[:-1])
    balance = {r["y"]: r["weight"] for r in class_balance(spark.createDataFrame([(0,)] * 3 + [(1,)], "y int"), "y").collect()}
    assert balance == {0: 4 / 6, 1: 2.0}


@pytest.mark.parametrize("columns", [6, 18])
def test_wide_correlation(spark, columns):
    """Few columns are summed in the JVM, many as matrices; both leave out pairs with a gap."""
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(400, columns)) + 1000
    x[:, 3] = 2 * x[:, 1] - 7
    x[rnd.random(x.shape) < 0.1] = np.nan
    x[:, columns - 1] = 4.0
    pdf = pd.DataFrame(x, columns=[f"s{i}" for i in range(columns)])
    df = spark.createDataFrame(pdf).repartition(3)
    got = correlation_matrix(df, list(pdf.columns)).toPandas().pivot(index="a", columns="b", values="corr")
    want = pdf.corr().loc[got.index, got.columns]
    np.testing.assert_allclose(got.to_numpy(dtype=float), want.to_numpy(), atol=1e-9)


def test_remarks(spark):
    logs = spark.createDataFrame([(at(0), "T1", "Generator 1 in", "x"), (at(1), "T1", "other", "x"), (at(0), "T1", "Generator 1 in", "x")],
                                 "Timestamp timestamp_ntz, Turbine_ID string, Remark string, z string")
    out = labels.one_hot_remarks(logs)
    assert out.count() == 2 and len(out.columns) == 2 + 15
    assert [r["Remark_Generator 1 in"] for r in out.collect()] == [1, 1]


@pytest.mark.parametrize("most", [256, 2])
def test_failure_flags_leave_a_large_grid_in_place(spark, rows, monkeypatch, most):
    """Failures too many for a broadcast are listed by key: the grid is not shuffled by time; twins and nulls count as in the plain join."""
    users = spark.createDataFrame([("A",), ("B",), ("C",), (None,)], "Turbine_ID string").distinct()
    grid = joins.entity_grid(users, F.lit(at()).cast("timestamp"), F.lit(at(minutes=60)).cast("timestamp"))
    marks = [(at(minutes=9), "A", "GEN"), (at(minutes=9), "A", "GEN"), (at(minutes=10), "A", "OIL"), (at(minutes=31), "B", None), (at(days=2), "B", "OIL"),
             (None, "A", "OIL"), (at(minutes=20), None, "GEN"), (at(minutes=20), "D", "GEN")]
    failures = spark.createDataFrame(marks, "Timestamp timestamp_ntz, Turbine_ID string, Component string")
    plain = rows(labels.failure_flags_on_grid(grid, failures, ["GEN", "OIL"]))
    assert len(plain) == 4 * 7 + 2 and sum(r[2] for r in plain) == 2 and sum(r[3] for r in plain) == 1
    monkeypatch.setattr(S, "MAX_BROADCAST_BYTES", 0)
    monkeypatch.setattr(labels, "MAX_LISTED", most)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        listed = labels.failure_flags_on_grid(grid, failures, ["GEN", "OIL"])
        assert rows(listed) == plain
        plan = listed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_time = [line for line in plan.splitlines() if "hashpartitioning(Turbine_ID" in line and "Timestamp#" in line.split("hashpartitioning")[1].split(")")[0]]
    assert bool(by_time) == (most == 2)
