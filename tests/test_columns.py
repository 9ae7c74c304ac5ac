"""Scalar expressions, bins, missing values and column choice on small fixtures."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from windvane.functions import scalar, time
from windvane.operators import bins, nulls, select, survey
from windvane.sources import files


def _times(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t string").select(F.to_timestamp_ntz("t").alias("t"))


def test_time_steps(spark):
    df = _times(spark, "2020-01-01 02:13:45", "2020-01-01 02:10:59", "2020-01-01 23:45:00")
    got = [tuple(str(v)[11:] if i < 3 else str(v) for i, v in enumerate(r)) for r in df.select(
        time.floor_time("t"), time.ceil_time("t"), time.floor_hour("t"), time.round_hour("t")).collect()]
    assert got == [
        ("02:10:00", "02:20:00", "02:00:00", "2020-01-01 02:00:00"),
        ("02:10:00", "02:10:00", "02:00:00", "2020-01-01 02:00:00"),
        ("23:40:00", "23:50:00", "23:00:00", "2020-01-02 00:00:00"),
    ]


def test_zone_text(spark):
    df = spark.createDataFrame([("2016-01-01T02:00:00+02:00",), ("bad",)], "t string")
    got = df.select(time.to_utc_naive("t"), time.to_utc_naive("t", 19)).collect()
    assert [tuple(r) for r in got] == [(dt.datetime(2016, 1, 1, 0, 0), dt.datetime(2016, 1, 1, 2, 0)), (None, None)]


def test_rounding_half_to_even_and_months(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "x double")
    assert [r[0] for r in df.select(scalar.round_half_even("x")).collect()] == [0, 2, 2]
    day = spark.sql("SELECT DATE '2017-05-31' AS d, TIMESTAMP_NTZ '2017-05-31 10:00:00' AS t")
    assert tuple(day.select(time.months_offset("d", -3), time.months_offset("t", -3)).first()) == (
        dt.date(2017, 2, 28), dt.datetime(2017, 2, 28, 10))


def test_time_grid(spark):
    grid = time.time_grid(spark, "2016-01-01 00:00:00", "2017-12-31 00:00:00")
    assert grid.count() == 365 * 2 * 24 * 6 + 1


def test_text_functions(spark):
    df = spark.createDataFrame([("2700", "3.5,2", 1), ("75011", "4.0,900", 12), ("123456", "x,y,z", None)], "p string, c string, n int")
    assert [r[0] for r in df.select(scalar.zfill_prefix("p")).collect()] == ["02", "75", "12"]
    parts = select.replace_values(scalar.split_cast(df, "c", ",", ["speed", "power"], ["double", "int"]), {2: 2000}, ["power"])
    assert [(r["speed"], r["power"]) for r in parts.collect()] == [(3.5, 2000), (4.0, 900), (None, None)]
    assert [r[0] for r in df.select(scalar.map_codes("n", survey.FREQUENCY)).collect()] == ["Manytimes", None, None]


def test_bins_match_pandas(spark):
    rnd = np.random.default_rng(3)
    values = np.round(rnd.normal(50, 20, 700), 2)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, x double")
    want = pd.qcut(values, 10, labels=False) + 1
    for limit in (None, 50):
        got = [r["b"] for r in bins.bin_quantile(df, "x", 10, "b", limit).orderBy("i").collect()]
        assert got == want.tolist()
    got = [r["b"] for r in bins.bin_width(df, "x", 10, "b").orderBy("i").collect()]
    assert got == (pd.cut(values, 10, labels=False) + 1).tolist()
    whole = spark.createDataFrame([(float(i),) for i in range(0, 101)], "x double")
    got = [r["b"] for r in bins.bin_width(whole, "x", 10, "b").orderBy("x").collect()]
    assert got == (pd.cut(np.arange(0.0, 101.0), 10, labels=False) + 1).tolist()


def test_quantile_bins_need_unique_edges(spark):
    with pytest.raises(ValueError, match="not unique"):
        bins.bin_quantile(spark.createDataFrame([(1.0,)] * 9 + [(2.0,)], "x double"), "x", 10)


def test_interpolation_matches_pandas(spark):
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=120)
    x[rnd.random(120) < 0.4] = np.nan
    x[0] = x[1] = x[-1] = np.nan
    pdf = pd.DataFrame({"g": ["a"] * 80 + ["b"] * 40, "i": range(120), "x": x})
    df = nulls.nan_to_null(spark.createDataFrame(pdf))
    for limit in (None, 10):
        got = nulls.interpolate_linear(df, ["x"], ["i"], task_rows=limit).orderBy("i").toPandas()["x"]
        pd.testing.assert_series_equal(got, pdf["x"].interpolate(), check_names=False)
        got = nulls.interpolate_linear(df, ["x"], ["i"], ["g"], task_rows=limit).orderBy("i").toPandas()["x"]
        want = pd.concat([p["x"].interpolate() for _, p in pdf.groupby("g")])
        pd.testing.assert_series_equal(got, want, check_names=False)


def test_backfill_inside_turbine_and_over_the_table(spark):
    data = [("A", 1, 1.0), ("A", 2, None), ("A", 3, None), ("B", 1, None), ("B", 2, 5.0), ("B", 3, None)]
    df = spark.createDataFrame(data, "t string, i int, v double")
    inside = nulls.backfill(df, ["v"], ["i"], ["t"]).orderBy("t", "i")
    assert [r["v"] for r in inside.collect()] == [1.0, None, None, 5.0, 5.0, None]
    for limit in (None, 2):
        over = nulls.backfill(df, ["v"], ["t", "i"], task_rows=limit).orderBy("t", "i")
        assert [r["v"] for r in over.collect()] == [1.0, 5.0, 5.0, 5.0, 5.0, None]


def test_column_choice(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, 1.0), (2, 2.0, 6.1, 1.5)], "Gen_a int, Prod_ActPwrGen0 double, Rtr_x double, Grd_RtrInv double")
    assert select.columns_matching(df, "Gen") == ["Gen_a", "Prod_ActPwrGen0"]
    assert select.component_slice(df, ["Rtr", "Gen", "Inv"], ["Gen_a"]).columns == ["Gen_a", "Rtr_x", "Grd_RtrInv", "Prod_ActPwrGen0"]
    assert "Prod_ActPwrGen0" not in select.drop_constant_columns(df, df.columns).columns
    assert select.select_by_dtype(df, exclude=["int"]).columns == ["Prod_ActPwrGen0", "Rtr_x", "Grd_RtrInv"]


def test_label_cast(spark):
    df = spark.createDataFrame([(0.5, 1.0), (2 / 3, 1.0), (1.0, 1.0)], "y double, x double")
    label = lambda how: [r["label"] for r in select.split_xy(df, ["x"], "y", how).collect()]
    assert label("trunc") == [0, 0, 1]
    assert label("round") == [0, 1, 1]


def _survey(spark):
    rows = []
    for i in range(1, 21):
        row = dict(
            id=i, civility="M." if i % 2 else "Mme.", birthdate=f"{1950 + i}-03-01", city="Lisboa",
            postal_code=["2700", "75011", "123456"][i % 3], vote_1="x", surveyduration=float(i), q1=1 + i % 9,
            sixty=None if i <= 12 else "v", half=None if i <= 10 else "v", a="z", b="z", c="z",
        )
        if i == 20:
            row.update(civility=None, city=None, half=None, a=None, b=None, c=None, postal_code=None)
        rows.append(row)
    names = list(rows[0])
    kinds = {"id": "int", "surveyduration": "double", "q1": "int"}
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ", ".join(f"{n} {kinds.get(n, 'string')}" for n in names))


def test_survey(spark):
    df = _survey(spark)
    out = survey.clean_table(df, survey.SurveySpec(year=2021))
    # half stays only while at least half of the rows have it: row 20 empties it below that
    assert set(out.columns) == {
        "id", "civility", "birthdate", "city", "postal_code", "surveyduration", "Frequency", "a", "b", "c", "Year_Month", "Age", "duration"}
    got = {r["id"]: r for r in out.collect()}
    assert sorted(got) == list(range(1, 21))
    assert (got[1]["civility"], got[2]["civility"], got[1]["city"]) == ("M", "Mme", "LISBOA")
    assert [got[i]["postal_code"] for i in (1, 2, 3)] == ["75", "12", "02"]
    assert got[1]["Frequency"] == "Onetimebyday" and got[9]["Frequency"] == "Manytimes"
    assert [got[i]["duration"] for i in (1, 2, 3, 20)] == [1, 1, 2, 10]
    assert got[1]["Age"] == 10 and got[20]["Age"] == 1


def test_sparse_rows_and_columns(spark):
    df = spark.createDataFrame([(1, None, None), (2, "b", None), (3, "c", "d"), (4, None, None)], "i int, x string, y string")
    assert select.drop_sparse_columns(df).columns == ["i", "x"]
    assert [r["i"] for r in select.drop_sparse_rows(df).collect()] == [2, 3]


def test_time_range_bounds(spark):
    df = _times(spark, "2020-01-01 00:00:00", "2020-01-02 00:00:00", "2020-01-03 00:00:00")
    count = lambda closed: select.filter_time_range(df, "t", "2020-01-01", "2020-01-03", closed).count()
    assert [count(c) for c in ("left", "right", "both", "neither")] == [2, 2, 3, 1]


def test_table_names():
    assert files.table_name("Power_curve.csv") == "Power_curve_df"
    assert files.table_name("wind-farm-1-failures-training.csv") == "failures_training_df"
    assert files.table_name("wind-farm-1-metmast.csv") == "metmast_df"


def test_ingest(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        "Turbine_ID;Timestamp;a\nT01;2016-01-01T00:03:00+00:00;\nT01;2016-01-01T00:17:00+00:00;4.5\nT02;2016-01-01T02:00:00+02:00;\n")
    schema = files.header_schema(spark, str(tmp_path / "s.csv"))
    assert schema.simpleString() == "struct<Turbine_ID:string,Timestamp:string,a:double>"
    df = files.ingest_signals(spark, str(tmp_path / "s.csv"), schema)
    got = [(r["Turbine_ID"], str(r["Timestamp"]), r["a"]) for r in df.orderBy("Turbine_ID", "Timestamp").collect()]
    assert got == [("T01", "2016-01-01 00:00:00", 4.5), ("T01", "2016-01-01 00:10:00", 4.5), ("T02", "2016-01-01 00:00:00", None)]
