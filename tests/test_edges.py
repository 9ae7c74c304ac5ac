"""Inputs at the edges: one result whatever the plan, no lost row, no silent wrong value."""

import datetime as dt
import math

import numpy as np
import pytest

from windvane import session as S
from windvane.functions import time
from windvane.operators import aggregates, joins, neighbours, select
from windvane.plans import turbines
from windvane.sources import files

DAY = dt.datetime(2020, 1, 1)


def at(days):
    return DAY + dt.timedelta(days=days)


@pytest.mark.parametrize("lower", [-1, 0, 0.5])
@pytest.mark.parametrize("broadcast", [True, False])
def test_horizon_join_over_midnight(spark, rows, monkeypatch, lower, broadcast):
    if not broadcast:
        monkeypatch.setattr(S, "MAX_BROADCAST_BYTES", 0)
    sig = [(i, at(i * 0.17), "T") for i in range(40)] + [(99, DAY + dt.timedelta(hours=24, minutes=1), "T"), (100, None, "T"), (101, DAY, None)]
    fail = [(DAY + dt.timedelta(hours=23, minutes=58), "T"), (at(3.2), "T"), (None, "T"), (at(1), None)]
    days = lambda f, s: round((f - s).total_seconds() / 86400, 2)
    want = sorted([(i, f) for i, t, k in sig for f, k2 in fail if t and f and k and k == k2 and lower <= days(f, t) <= 2], key=str)
    s = spark.createDataFrame(sig, "i int, Timestamp timestamp_ntz, Turbine_ID string")
    f = spark.createDataFrame(fail, "Timestamp timestamp_ntz, Turbine_ID string")
    assert rows(joins.join_horizon(s, f, "Turbine_ID", lower=lower, upper=2), "i", "failure_ts") == want


@pytest.mark.parametrize("columns", [3, 17])
def test_constant_column_has_no_correlation(spark, columns):
    rnd = np.random.default_rng(1)
    data = rnd.normal(size=(50, columns))
    data[:, 1] = 0.1
    names = [f"c{i}" for i in range(columns)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in data], ", ".join(f"{c} double" for c in names))
    got = {(r["a"], r["b"]): r["corr"] for r in aggregates.correlation_matrix(df, names).collect()}
    assert len(got) == columns**2
    for (a, b), corr in got.items():
        i, j = names.index(a), names.index(b)
        if 1 in (i, j):
            assert corr is None
        else:
            assert -1 <= corr <= 1 and abs(corr - np.corrcoef(data[:, i], data[:, j])[0, 1]) < 1e-12
    assert "c1" in select.drop_correlated(df, names, 0.9).columns


def test_rows_without_a_turbine(spark, monkeypatch):
    """The list and the scan give the same daily rows, and none for a missing turbine."""
    sig = [("T", at(d), float(d)) for d in range(6)] + [(None, at(d), 1.0) for d in range(4)] + [("T", None, 5.0)]
    fail = [(None, at(3), "GEN"), ("T", at(4), "GEN"), ("U", at(2), "GEN")]
    s = spark.createDataFrame(sig, "Turbine_ID string, Timestamp timestamp_ntz, x double")
    f = spark.createDataFrame(fail, "Turbine_ID string, Timestamp timestamp_ntz, Component string")
    setup = turbines.Setup(components={"g": "GEN"}, sensors={"g": ["x"]}, training_turbines=None, horizon=4, lower=1)
    daily = lambda: sorted(map(tuple, turbines.daily_labelled(s, f, setup, turbines.measured(s, f, setup)).collect()))
    listed = daily()
    monkeypatch.setattr(turbines, "MAX_LISTED", 0)
    assert listed == daily() and len(listed) == 7
    assert {r[0] for r in listed} == {"T", "U"}


def test_knn_returns_every_row(spark):
    train = spark.createDataFrame([(i, [float(i), 0.0], i % 2) for i in range(6)], "i int, x array<double>, y int")
    test = [(1, [0.1, 0.0]), (2, None), (3, [None, 1.0]), (4, [math.nan, 1.0]), (5, [math.inf, 1.0])]
    out = neighbours.knn_classify(train, spark.createDataFrame(test, "q int, x array<double>"), "x", "y", "i", ["q"], 1)
    assert {r["q"]: r["prediction"] for r in out.collect()} == {1: 0, 2: None, 3: None, 4: None, 5: None}


def test_gaps_are_filled_by_the_time_as_read(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        "Turbine_ID;Timestamp;x\nT;2020-01-01T00:12:00+00:00;9.0\nT;2020-01-01T00:09:00+00:00;\nT;2020-01-01T00:05:00+00:00;7.0\nT;2020-01-01T00:01:00+00:00;\n"
    )
    out = files.ingest_signals(spark, str(tmp_path / "s.csv"), "Turbine_ID string, Timestamp string, x double")
    assert sorted((r["Timestamp"].minute, r["x"]) for r in out.collect()) == [(0, 7.0), (0, 7.0), (0, 9.0), (10, 9.0)]


def test_columns_are_found_by_their_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Gen_RPM;more;Hyd_Temp\n1.0;x;2.0\n")
    out = files.read_delimited(spark, str(tmp_path / "a.csv"), "Hyd_Temp double, Gen_RPM double")
    assert [tuple(r) for r in out.collect()] == [(2.0, 1.0)]
    with pytest.raises(ValueError):
        files.read_delimited(spark, str(tmp_path / "a.csv"), "Oil_Temp double")
    (tmp_path / "b.csv").write_text("Gen_RPM;Hyd_Temp\n1.0;2.0\nbad;2.0\n")
    reading = files.read_delimited(spark, str(tmp_path / "b.csv"), "Gen_RPM double, Hyd_Temp double", mode="FAILFAST")
    with pytest.raises(Exception, match="MALFORMED|alformed"):
        reading.collect()
    (tmp_path / "c.csv").write_text(",x,y\n0,1.0,2.0\n")
    assert [tuple(r) for r in files.read_indexed_csv(spark, str(tmp_path / "c.csv"), "y double, x double").collect()] == [(2.0, 1.0)]


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
def test_asof_join_without_time_or_key(spark, direction):
    left = spark.createDataFrame([(1, "T", at(1)), (2, "T", None), (3, None, at(1))], "i int, k string, ts timestamp_ntz")
    right = spark.createDataFrame([("T", at(1), 7), (None, at(1), 8)], "k string, ts timestamp_ntz, v int")
    out = joins.join_asof(left, right, "ts", ["k"], direction)
    assert {r["i"]: r["v"] for r in out.collect()} == {1: 7, 2: None, 3: None}


def test_other_session_clocks_are_refused(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Lisbon")
    try:
        for make in (lambda: time.floor_time("ts"), lambda: time.days_between("a", "b"), lambda: time.to_utc_naive("ts")):
            with pytest.raises(ValueError, match="UTC"):
                make()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
