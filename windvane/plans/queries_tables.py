"""Joins, aggregates, windows, labels, splits and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from windvane.functions.time import time_grid
from windvane.operators import aggregates, incremental, joins, labels, scaling, sketches, splits, windows
from windvane.plans.registry import (
    COMPONENTS, FAILURES_SQL, SENSORS, SIGNALS_SQL, failures, load, query, r, signals, wide_signals,
)
from windvane.session import scratch_path

KEYS = ["Timestamp", "Turbine_ID"]


# --- joins -------------------------------------------------------------------------------------


@query(
    "j1_join_outer_keys",
    f"""WITH {SIGNALS_SQL}, {FAILURES_SQL}, g AS (SELECT Timestamp, Turbine_ID FROM failures WHERE Component = 'GENERATOR')
        SELECT coalesce(s.Timestamp, g.Timestamp) AS Timestamp, coalesce(s.Turbine_ID, g.Turbine_ID) AS Turbine_ID,
          coalesce(value, 0) AS value, CASE WHEN g.Timestamp IS NULL THEN 0 ELSE 1 END AS Component
        FROM (SELECT Timestamp, Turbine_ID, value FROM signals) s
        FULL JOIN g ON s.Timestamp = g.Timestamp AND s.Turbine_ID = g.Turbine_ID""",
)
def _(spark, sf):
    s = signals(spark, sf).select(*KEYS, "value")
    return joins.join_outer_keys(s, failures(spark, sf), "GENERATOR", KEYS)


@query(
    "j2_join_left_keys",
    f"""WITH {SIGNALS_SQL}, {FAILURES_SQL} SELECT s.event_id, s.Timestamp, s.Turbine_ID, Component
        FROM signals s LEFT JOIN failures f ON s.Timestamp = f.Timestamp AND s.Turbine_ID = f.Turbine_ID""",
)
def _(spark, sf):
    f = failures(spark, sf).drop("event_id")
    return joins.join_keys(signals(spark, sf).select("event_id", *KEYS), f, KEYS)


@query(
    "j3_join_left_renamed",
    "SELECT o_orderkey, o_custkey, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
)
def _(spark, sf):
    o, c = load(spark, sf, "orders"), load(spark, sf, "customer")
    return joins.join_renamed(
        o.select("o_orderkey", "o_custkey"), c.select("c_custkey", "c_name", "c_mktsegment"), ["o_custkey"], ["c_custkey"]
    )


@query(
    "j4_join_inner_default",
    "SELECT l_orderkey, l_linenumber, o_orderdate, l_extendedprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
)
def _(spark, sf):
    left = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    right = load(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return joins.join_keys(left, right, ["l_orderkey"], "inner")


_ASOF_SQL = """sig AS (SELECT event_id, ts, user_id, value FROM events WHERE event_type <> 'error'),
  err AS (SELECT event_id AS err_id, ts AS err_ts, user_id, value AS err_value FROM events WHERE event_type = 'error')"""


def _asof_sides(spark, sf):
    ev = load(spark, sf, "events")
    left = ev.filter(F.col("event_type") != "error").select("event_id", "ts", "user_id", "value")
    right = ev.filter(F.col("event_type") == "error").select(
        F.col("event_id").cast("double").alias("err_id"), F.col("ts").alias("err_ts"), "user_id", F.col("value").alias("err_value")
    )
    return left, right


@query(
    "j5_join_asof_backward",
    f"""WITH {_ASOF_SQL} SELECT s.event_id, s.ts, s.user_id, s.value, e.err_ts AS err_ts_matched, e.err_id::DOUBLE AS err_id, e.err_value
        FROM sig s ASOF LEFT JOIN err e ON s.ts >= e.err_ts""",
)
def _(spark, sf):
    left, right = _asof_sides(spark, sf)
    return joins.join_asof(left, right.drop("user_id"), "ts", right_ts="err_ts")


@query(
    "j6_join_asof_by_tolerance",
    f"""WITH {_ASOF_SQL}, b AS (SELECT s.*, e.err_ts, e.err_id, e.err_value FROM sig s ASOF LEFT JOIN err e ON s.user_id = e.user_id AND s.ts >= e.err_ts)
        SELECT event_id, ts, user_id, value, CASE WHEN ok THEN err_ts END AS err_ts_matched, CASE WHEN ok THEN err_id::DOUBLE END AS err_id,
          CASE WHEN ok THEN err_value END AS err_value
        FROM (SELECT *, coalesce(epoch_us(ts) - epoch_us(err_ts) <= 86400000000, false) AS ok FROM b)""",
)
def _(spark, sf):
    left, right = _asof_sides(spark, sf)
    return joins.join_asof(left, right, "ts", ["user_id"], tolerance_minutes=24 * 60, right_ts="err_ts")


@query(
    "j6_join_asof_nearest",
    f"""WITH {_ASOF_SQL}, b AS (SELECT s.event_id, e.err_ts, e.err_id FROM sig s ASOF LEFT JOIN err e ON s.user_id = e.user_id AND s.ts >= e.err_ts),
        a AS (SELECT s.event_id, e.err_ts, e.err_id FROM sig s ASOF LEFT JOIN err e ON s.user_id = e.user_id AND s.ts <= e.err_ts)
        SELECT s.event_id, CASE WHEN a.err_ts IS NULL OR epoch_us(s.ts) - epoch_us(b.err_ts) <= epoch_us(a.err_ts) - epoch_us(s.ts)
          THEN b.err_id ELSE a.err_id END::DOUBLE AS err_id
        FROM sig s JOIN a USING (event_id) JOIN b USING (event_id)""",
)
def _(spark, sf):
    left, right = _asof_sides(spark, sf)
    return joins.join_asof(left, right, "ts", ["user_id"], "nearest", right_ts="err_ts").select("event_id", "err_id")


@query(
    "j7_join_horizon",
    f"""WITH {SIGNALS_SQL}, {FAILURES_SQL} SELECT s.event_id, s.Turbine_ID, f.event_id AS failure_id, Component,
        round_even((epoch_us(f.Timestamp) - epoch_us(s.Timestamp)) / 86400000000.0, 2) AS days_to_failure
        FROM signals s JOIN failures f ON s.Turbine_ID = f.Turbine_ID
        WHERE round_even((epoch_us(f.Timestamp) - epoch_us(s.Timestamp)) / 86400000000.0, 2) BETWEEN 2 AND 4""",
)
def _(spark, sf):
    f = failures(spark, sf).withColumnRenamed("event_id", "failure_id")
    s = signals(spark, sf).select("event_id", *KEYS)
    out = joins.join_horizon(s, f, "Turbine_ID", lower=2, upper=4)
    return out.select("event_id", "Turbine_ID", "failure_id", "Component", "days_to_failure")


_FROM_ZERO_SQL = f"""WITH {SIGNALS_SQL}, {FAILURES_SQL} SELECT s.event_id, s.Turbine_ID, f.event_id AS failure_id, Component,
        round_even((epoch_us(f.Timestamp) - epoch_us(s.Timestamp)) / 86400000000.0, 2) AS days_to_failure
        FROM signals s JOIN failures f ON s.Turbine_ID = f.Turbine_ID
        WHERE round_even((epoch_us(f.Timestamp) - epoch_us(s.Timestamp)) / 86400000000.0, 2) BETWEEN 0 AND 1"""


@query("j7_join_horizon_from_zero", _FROM_ZERO_SQL)
def _(spark, sf):
    f = failures(spark, sf).withColumnRenamed("event_id", "failure_id")
    out = joins.join_horizon(signals(spark, sf).select("event_id", *KEYS), f, "Turbine_ID", lower=0, upper=1)
    return out.select("event_id", "Turbine_ID", "failure_id", "Component", "days_to_failure")


@query(
    "j8_cross_grid",
    """WITH t AS (SELECT DISTINCT date_trunc('hour', ts) AS Timestamp FROM events)
       SELECT Timestamp, Turbine_ID FROM t, (SELECT unnest(['T01','T06','T07','T09','T11']) AS Turbine_ID)""",
)
def _(spark, sf):
    times = load(spark, sf, "events").select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("Timestamp")).distinct()
    return joins.cross_grid(times, ["T01", "T06", "T07", "T09", "T11"])


_GRID_SQL = """u AS (SELECT user_id AS Turbine_ID, date_trunc('day', min(ts)) AS lo, max(ts) AS hi FROM events GROUP BY user_id),
  grid AS (SELECT Turbine_ID, unnest(generate_series(lo, hi, INTERVAL '2 hours')) AS Timestamp FROM u)"""


def _grid(spark, sf):
    ev = load(spark, sf, "events")
    u = ev.groupBy(F.col("user_id").alias("Turbine_ID")).agg(F.date_trunc("day", F.min("ts")).alias("lo"), F.max("ts").alias("hi"))
    return joins.entity_grid(u, F.col("lo"), F.col("hi"), 120).select("Turbine_ID", "Timestamp")


@query("j8_entity_grid", f"WITH {_GRID_SQL} SELECT Turbine_ID, Timestamp FROM grid")
def _(spark, sf):
    return _grid(spark, sf)


@query(
    "j9_grid_left_join",
    f"""WITH {_GRID_SQL}, d AS (SELECT user_id AS Turbine_ID, time_bucket(INTERVAL '2 hours', ts) AS Timestamp, count(*)::DOUBLE AS n FROM events GROUP BY ALL)
        SELECT Turbine_ID, Timestamp, n FROM grid LEFT JOIN d USING (Turbine_ID, Timestamp) WHERE Timestamp < TIMESTAMP '2024-01-20'""",
)
def _(spark, sf):
    from windvane.functions.time import floor_time

    ev = load(spark, sf, "events")
    d = ev.groupBy(F.col("user_id").alias("Turbine_ID"), floor_time("ts", 120).alias("Timestamp")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    return joins.grid_left_join(_grid(spark, sf), d, ["Turbine_ID", "Timestamp"], until="2024-01-20")


@query(
    "j10_self_join_marker",
    f"""WITH {SIGNALS_SQL}, {FAILURES_SQL} SELECT DISTINCT s.event_id, s.Timestamp, f.Timestamp AS date FROM signals s
        LEFT JOIN (SELECT DISTINCT Timestamp, Turbine_ID FROM failures) f ON s.Timestamp = f.Timestamp AND s.Turbine_ID = f.Turbine_ID""",
)
def _(spark, sf):
    marks = splits.drop_duplicates(failures(spark, sf).select(*KEYS)).withColumn("date", F.col("Timestamp"))
    return joins.join_keys(signals(spark, sf).select("event_id", *KEYS), marks, KEYS).select("event_id", "Timestamp", "date")


@query(
    "j11_semi_join",
    "SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)",
)
def _(spark, sf):
    big = load(spark, sf, "orders").filter(F.col("o_totalprice") > 300000).select(F.col("o_custkey").alias("c_custkey"))
    return joins.semi_join(load(spark, sf, "customer"), big, ["c_custkey"])


@query(
    "j11_anti_join",
    "SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)",
)
def _(spark, sf):
    big = load(spark, sf, "orders").filter(F.col("o_totalprice") > 300000).select(F.col("o_custkey").alias("c_custkey"))
    return joins.anti_join(load(spark, sf, "customer"), big, ["c_custkey"])


# --- aggregates --------------------------------------------------------------------------------


@query(
    "a1_group_by_period",
    f"""WITH {SIGNALS_SQL} SELECT Turbine_ID, Timestamp::DATE::VARCHAR AS Date, round(avg(value), 8) AS value FROM signals GROUP BY ALL""",
)
def _(spark, sf):
    daily = aggregates.group_by_period(signals(spark, sf).select("Turbine_ID", "Timestamp", "value"), ["Turbine_ID"], "Timestamp")
    return daily.select("Turbine_ID", F.col("Date").cast("string").alias("Date"), r("value", 8).alias("value"))


@query(
    "a1_group_by_hour_max",
    f"""WITH {SIGNALS_SQL} SELECT Turbine_ID, date_trunc('hour', Timestamp) AS Date, max(value) AS value FROM signals GROUP BY ALL""",
)
def _(spark, sf):
    s = signals(spark, sf).select("Turbine_ID", "Timestamp", "value")
    return aggregates.group_by_period(s, ["Turbine_ID"], "Timestamp", "hour", "max")


@query("a2_group_mean_exact_ts", f"WITH {SIGNALS_SQL} SELECT Turbine_ID, Timestamp, round(avg(value), 8) AS value FROM signals GROUP BY ALL")
def _(spark, sf):
    out = aggregates.group_mean_exact_ts(signals(spark, sf).select("Turbine_ID", "Timestamp", "value"), ["Turbine_ID", "Timestamp"])
    return out.withColumn("value", r("value", 8))


@query("a3_group_count", "SELECT user_id, count(event_id) AS event_id, count(CASE WHEN event_type='error' THEN value END) AS err FROM events GROUP BY user_id")
def _(spark, sf):
    ev = load(spark, sf, "events").select("user_id", "event_id", F.when(F.col("event_type") == "error", F.col("value")).alias("err"))
    return aggregates.group_count(ev, ["user_id"])


@query("a4_value_counts", f"WITH {FAILURES_SQL} SELECT Component, count(*) AS n FROM failures GROUP BY Component")
def _(spark, sf):
    return aggregates.value_counts(failures(spark, sf), "Component")


@query(
    "a5_value_counts_by_group_pivot",
    f"""WITH {FAILURES_SQL} SELECT Turbine_ID, {", ".join(f"nullif(count(*) FILTER (Component = '{c}'), 0)::DOUBLE AS {c}" for c in COMPONENTS)}
        FROM failures GROUP BY Turbine_ID""",
)
def _(spark, sf):
    out = aggregates.value_counts_pivot(failures(spark, sf), "Turbine_ID", "Component", COMPONENTS)
    return out.select("Turbine_ID", *[F.col(c).cast("double").alias(c) for c in COMPONENTS])


@query(
    "a6_freq_cumulative",
    """WITH c AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey), t AS (SELECT sum(n) AS total FROM c)
       SELECT l_partkey, n, round(n / total, 9) AS share,
         round(sum(n) OVER (ORDER BY n DESC, l_partkey ROWS UNBOUNDED PRECEDING) / total, 9) AS cum_share FROM c, t""",
)
def _(spark, sf):
    out = aggregates.freq_cumulative(load(spark, sf, "lineitem"), "l_partkey")
    return out.select("l_partkey", "n", r("share", 9).alias("share"), r("cum_share", 9).alias("cum_share"))


@query("a7_nunique", "SELECT count(DISTINCT user_id) AS user_id, count(DISTINCT event_type) AS event_type FROM events")
def _(spark, sf):
    return aggregates.nunique(load(spark, sf, "events"), ["user_id", "event_type"])


@query(
    "a7_nunique_sketched",
    """WITH w AS (SELECT date_trunc('week', ts)::DATE::VARCHAR AS week, count(DISTINCT user_id) AS users, count(DISTINCT floor(value)) AS levels FROM events GROUP BY ALL)
       SELECT week, users, levels, true AS users_hold, true AS levels_hold FROM w""",
)
def _(spark, sf):
    """Distinct turbines and values per week from stored daily sketches, beside the exact counts: whether they differ by less than five standard errors."""
    ev = load(spark, sf, "events").select("event_type", "user_id", "ts", F.floor("value").alias("level"))
    path = scratch_path(spark, "sketches")
    sketches.distinct_sketches(ev, ["event_type"], "ts", ["user_id", "level"]).write.parquet(path)
    week = F.date_trunc("week", F.col("Date")).cast("date").cast("string").alias("week")
    found = sketches.distinct_over(spark.read.parquet(path), [week], ["user_id", "level"])
    exact = ev.groupBy(F.date_trunc("week", F.col("ts")).cast("date").cast("string").alias("week")).agg(
        F.count_distinct("user_id").alias("users"), F.count_distinct("level").alias("levels")
    )
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= 1 + 5 * sketches.DISTINCT_ERROR * F.col(b)
    return exact.join(found, "week", "left").select(
        "week", "users", "levels", near("user_id", "users").alias("users_hold"), near("level", "levels").alias("levels_hold")
    )


@query("a7_distinct_values", "SELECT DISTINCT p_brand FROM part")
def _(spark, sf):
    return aggregates.distinct_values(load(spark, sf, "part"), "p_brand")


def _describe_sql(cols: list[str], table: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 5) AS mean, round(stddev_samp({c}), 5) AS std, min({c})::DOUBLE AS min,
            round(quantile_cont({c}, 0.25), 5) AS q25, round(quantile_cont({c}, 0.5), 5) AS q50, round(quantile_cont({c}, 0.75), 5) AS q75,
            max({c})::DOUBLE AS max FROM {table}"""
        for c in cols
    )


@query("a8_describe", _describe_sql(["l_quantity", "l_extendedprice", "l_linenumber"], "lineitem"))
def _(spark, sf):
    out = aggregates.describe(load(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_linenumber"], exact=True)
    return out.withColumns({c: r(c, 5) for c in ("mean", "std", "q25", "q50", "q75")})


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "a9_correlation_matrix",
    " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM lineitem" for a in _CORR for b in _CORR),
)
def _(spark, sf):
    return aggregates.correlation_matrix(load(spark, sf, "lineitem"), _CORR).withColumn("corr", r("corr"))


@query("a10_min_max", "SELECT min(l_shipdate) AS min, max(l_shipdate) AS max FROM lineitem")
def _(spark, sf):
    return aggregates.min_max(load(spark, sf, "lineitem"), "l_shipdate")


@query(
    "a11_confusion_crosstab",
    """SELECT quality, count(*) FILTER (toxic = 0) AS "0", count(*) FILTER (toxic = 1) AS "1" FROM labels GROUP BY quality""",
)
def _(spark, sf):
    return aggregates.confusion_crosstab(load(spark, sf, "labels"), "quality", "toxic")


@query("a12_row_share", "SELECT round(avg((value >= 50)::INT), 6) AS share FROM events")
def _(spark, sf):
    return aggregates.row_share(load(spark, sf, "events"), F.col("value") >= 50).withColumn("share", r("share"))


@query(
    "a13_histogram",
    """WITH m AS (SELECT min(l_extendedprice) lo, max(l_extendedprice) hi FROM lineitem),
       b AS (SELECT least(floor((l_extendedprice - lo) / ((hi - lo) / 20)), 19)::INT AS bin FROM lineitem, m)
       SELECT g::INT AS bin, round(lo + g * ((hi - lo) / 20), 4) AS low, round(lo + (g + 1) * ((hi - lo) / 20), 4) AS high,
         (SELECT count(*) FROM b WHERE bin = g) AS n FROM range(20) t(g), m""",
)
def _(spark, sf):
    out = aggregates.histogram(load(spark, sf, "lineitem"), "l_extendedprice", 20)
    return out.withColumns({"low": r("low", 4), "high": r("high", 4)})


@query(
    "a8_quantiles_sketched",
    """WITH n AS (SELECT event_type, count(value) AS n FROM events GROUP BY event_type)
       SELECT event_type, unnest([0.05, 0.25, 0.5, 0.75, 0.95])::DOUBLE AS point, n, true AS rank_holds FROM n""",
)
def _(spark, sf):
    """Quantiles per event type from stored sketches per type, turbine and day: whether the rank of each among all values is its point, up to the stated error."""
    ev, points = load(spark, sf, "events"), [0.05, 0.25, 0.5, 0.75, 0.95]
    path = scratch_path(spark, "sketches")
    sketches.quantile_sketches(ev, ["event_type", "user_id"], "ts", ["value"]).write.parquet(path)
    found = sketches.quantiles_over(spark.read.parquet(path), ["event_type"], "value", points)
    pairs = F.arrays_zip(F.array(*[F.lit(p) for p in points]).alias("point"), F.col("quantiles").alias("q"))
    asked = found.select("event_type", "n", F.explode(pairs).alias("a")).select("event_type", "n", "a.point", "a.q")
    ranks = ev.join(asked, "event_type").groupBy("event_type", "point", "n").agg(  # five rows per event type
        (F.count_if(F.col("value") < F.col("q")) / F.count("value")).alias("below"), (F.count_if(F.col("value") <= F.col("q")) / F.count("value")).alias("upto")
    )
    slack = 2 * sketches.RANK_ERROR
    holds = (F.col("below") <= F.col("point") + slack) & (F.col("upto") >= F.col("point") - slack)
    return ranks.select("event_type", "point", "n", holds.alias("rank_holds"))


@query(
    "a14_box_stats",
    """SELECT l_returnflag, min(l_extendedprice) AS min, round(quantile_cont(l_extendedprice, 0.25), 4) AS q25,
       round(quantile_cont(l_extendedprice, 0.5), 4) AS q50, round(quantile_cont(l_extendedprice, 0.75), 4) AS q75,
       max(l_extendedprice) AS max FROM lineitem GROUP BY l_returnflag""",
)
def _(spark, sf):
    out = aggregates.box_stats(load(spark, sf, "lineitem"), "l_extendedprice", "l_returnflag")
    return out.withColumns({c: r(c, 4) for c in ("q25", "q50", "q75")})


@query(
    "a15_class_balance",
    """SELECT quality, count(*) AS n, round((SELECT count(*) FROM labels) / (2.0 * count(*)), 6) AS weight FROM labels GROUP BY quality""",
)
def _(spark, sf):
    return aggregates.class_balance(load(spark, sf, "labels"), "quality").withColumn("weight", r("weight"))


@query(
    "a16_total_by_group",
    """SELECT coalesce(l_returnflag, 'all') AS l_returnflag, coalesce(l_linestatus, 'all') AS l_linestatus, round(sum(l_quantity), 2) AS total
       FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""",
)
def _(spark, sf):
    out = aggregates.total_by_group(load(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity", rollup=True)
    return out.na.fill("all", ["l_returnflag", "l_linestatus"]).withColumn("total", r("total", 2))


# --- windows -----------------------------------------------------------------------------------

_DAILY_SQL = f"""{SIGNALS_SQL}, daily AS (SELECT Turbine_ID, Timestamp::DATE AS Date, avg(value) AS value, count(*)::BIGINT AS n FROM signals GROUP BY ALL)"""


def _daily(spark, sf):
    return signals(spark, sf).groupBy("Turbine_ID", F.to_date("Timestamp").alias("Date")).agg(
        F.avg("value").alias("value"), F.count(F.lit(1)).alias("n")
    )


def _text_date(df):
    return df.withColumn("Date", F.col("Date").cast("string"))


_ROLL = "OVER (PARTITION BY Turbine_ID ORDER BY Date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"


@query(
    "a1_daily_incremental",
    """WITH d AS (SELECT user_id, ts::DATE AS Date, avg(value) AS value FROM events GROUP BY ALL)
       SELECT user_id, Date::VARCHAR AS Date, round(value, 8) AS value, round(avg(value) OVER w, 8) AS value_av, round(coalesce(stddev_samp(value) OVER w, 0), 8) AS value_sd
       FROM d WINDOW w AS (PARTITION BY user_id ORDER BY Date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
)
def _(spark, sf):
    """The events arrive in four deliveries, the last with rows that come late for days all along the table, and the third twice."""
    ev = load(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    late = (F.col("event_id") % 97 == 0) & (F.col("user_id") % 3 == 0)
    part = F.when(late, 3).when(F.dayofmonth("ts") <= 10, 0).when(F.dayofmonth("ts") <= 20, 1).otherwise(2)
    table = incremental.DailyTable(scratch_path(spark, "daily"), ("user_id",), "ts", ("value",), 7)
    for n in (0, 1, 2, 2, 3):
        table.update(f"delivery-{n}", ev.filter(part == n))
    out = table.read(spark).withColumn("Date", F.col("Date").cast("string"))
    return out.select("user_id", "Date", *[r(c, 8).alias(c) for c in ("value", "value_av", "value_sd")])


@query("w1_rolling_mean", f"WITH {_DAILY_SQL} SELECT Turbine_ID, Date::VARCHAR AS Date, n, round(avg(value) {_ROLL}, 8) AS value_av FROM daily")
def _(spark, sf):
    out = windows.rolling_mean(_daily(spark, sf), ["value"], ["Turbine_ID"], ["Date"], 10)
    return _text_date(out).select("Turbine_ID", "Date", "n", r("value_av", 8).alias("value_av"))


@query(
    "w2_rolling_std",
    f"WITH {_DAILY_SQL} SELECT Turbine_ID, Date::VARCHAR AS Date, n, round(coalesce(stddev_samp(value) {_ROLL}, 0), 8) AS value_sd FROM daily",
)
def _(spark, sf):
    out = windows.rolling_std(_daily(spark, sf), ["value"], ["Turbine_ID"], ["Date"], 10)
    return _text_date(out).select("Turbine_ID", "Date", "n", r("value_sd", 8).alias("value_sd"))


@query(
    "w3_add_features",
    f"""WITH {SIGNALS_SQL}, daily AS (SELECT Turbine_ID, Timestamp::DATE AS Date, {", ".join(f"coalesce(avg(value) FILTER (event_type = '{t}'), 0) AS {t}" for t in SENSORS)}
        FROM signals GROUP BY ALL)
        SELECT Turbine_ID, Date::VARCHAR AS Date, {", ".join(f"round({t}, 8) AS {t}, round(avg({t}) {_ROLL}, 8) AS {t}_av, round(coalesce(stddev_samp({t}) {_ROLL}, 0), 8) AS {t}_sd" for t in SENSORS)} FROM daily""",
)
def _(spark, sf):
    daily = aggregates.group_by_period(wide_signals(spark, sf), ["Turbine_ID"], "Timestamp").na.fill(0)
    out = windows.add_rolling_features(daily, SENSORS, ["Turbine_ID"], ["Date"], 10)
    return _text_date(out).select("Turbine_ID", "Date", *[r(c, 8).alias(c) for c in out.columns[2:]])


@query(
    "w4_rolling_sum_global",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, sum(l_quantity) OVER (
         ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_shipdate ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS quantity_10 FROM lineitem""",
)
def _(spark, sf):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"]
    out = windows.rolling_sum(load(spark, sf, "lineitem"), "l_quantity", order, 10, name="quantity_10")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "quantity_10")


@query(
    "w5_time_delta",
    """SELECT event_id, user_id, coalesce((epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts)) / 1000000.0, 0)::DOUBLE AS delta_seconds
       FROM events""",
)
def _(spark, sf):
    return windows.time_delta(load(spark, sf, "events").select("event_id", "user_id", "ts"), "ts", ["user_id"]).drop("ts")


@query(
    "w6_max_gap",
    """SELECT max(d)::DOUBLE AS max_gap_seconds FROM (SELECT (epoch_us(ts) - lag(epoch_us(ts)) OVER (ORDER BY ts)) / 1000000.0 AS d FROM events)""",
)
def _(spark, sf):
    return windows.max_gap(load(spark, sf, "events"), "ts")


@query(
    "w7_cumulative_sum",
    "SELECT event_id, round(sum(value) OVER (ORDER BY ts ROWS UNBOUNDED PRECEDING), 2) AS value_cum FROM events",
)
def _(spark, sf):
    out = windows.cumulative_sum(load(spark, sf, "events"), "value", ["ts"])
    return out.select("event_id", r("value_cum", 2).alias("value_cum"))


@query(
    "w8_sliding_sequences",
    """WITH k AS (SELECT user_id, event_type, value, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY user_id) AS n,
         list(value) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS x FROM events
         WINDOW w AS (PARTITION BY user_id ORDER BY ts))
       SELECT user_id, (pos - 5)::BIGINT AS start, event_type AS y, len(x)::INT AS size, x[1] AS first, x[6] AS last, round(list_sum(x), 4) AS total
       FROM k WHERE pos >= 5 AND pos < n - 1""",
)
def _(spark, sf):
    out = windows.sliding_sequences(load(spark, sf, "events"), ["value"], "event_type", "user_id", ["ts"], 6)
    total = F.aggregate("X", F.lit(0.0), lambda a, row: a + row[0])
    return out.select(
        "user_id", "start", "y", F.size("X").alias("size"), F.col("X")[0][0].alias("first"), F.col("X")[5][0].alias("last"),
        F.round(total, 4).alias("total"),
    )


@query(
    "w8_random_sequences",
    """WITH k AS (SELECT user_id, event_type, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY user_id) AS n
         FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts))
       SELECT user_id, (pos - 5)::BIGINT AS start, event_type AS y, 6 AS size FROM k WHERE pos >= 5 AND pos < n - 1
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY md5(concat_ws('|', '3', user_id::VARCHAR, (pos - 5)::VARCHAR)), pos) <= 5""",
)
def _(spark, sf):
    out = windows.sliding_sequences(load(spark, sf, "events"), ["value"], "event_type", "user_id", ["ts"], 6, n=5, seed=3)
    return out.select("user_id", "start", "y", F.size("X").alias("size"))


@query(
    "w9_row_position",
    "SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1)::BIGINT AS pos FROM orders",
)
def _(spark, sf):
    return windows.row_position(load(spark, sf, "orders"), ["o_orderdate", "o_orderkey"]).select("o_orderkey", "pos")


# --- labels ------------------------------------------------------------------------------------

_FLAGGED_SQL = """flagged AS (SELECT event_id, ts, user_id, (event_type = 'error')::INT AS flag FROM events),
  dated AS (SELECT *, coalesce(min(CASE WHEN flag = 1 THEN ts END) OVER (PARTITION BY user_id ORDER BY ts
    RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), ts) AS date FROM flagged),
  ttf AS (SELECT *, round_even((epoch_us(date) - epoch_us(ts)) / 86400000000.0, 0) AS TTF FROM dated)"""


def _flagged(spark, sf):
    return load(spark, sf, "events").select(
        "event_id", "ts", "user_id", F.when(F.col("event_type") == "error", 1).otherwise(0).alias("flag")
    )


@query("l1_next_failure_date", f"WITH {_FLAGGED_SQL} SELECT event_id, date FROM ttf")
def _(spark, sf):
    return labels.next_failure_date(_flagged(spark, sf), "flag", "user_id", "ts").select("event_id", "date")


@query("l2_ttf_days", f"WITH {_FLAGGED_SQL} SELECT event_id, TTF FROM ttf")
def _(spark, sf):
    return labels.time_to_failure(_flagged(spark, sf), "flag", "user_id", "ts").select("event_id", "TTF")


@query(
    "l3_ttf_floor_days",
    """SELECT event_id, floor((epoch_us(min(CASE WHEN event_type = 'error' THEN ts END) OVER (PARTITION BY user_id ORDER BY ts
         RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) - epoch_us(ts)) / 86400000000.0)::DOUBLE AS TTF FROM events""",
)
def _(spark, sf):
    out = labels.ttf_floor_days(_flagged(spark, sf), "flag", "user_id", "ts")
    return out.select("event_id", F.col("TTF").cast("double").alias("TTF"))


@query(
    "l4_horizon_label",
    f"""WITH {_FLAGGED_SQL} SELECT event_id, (TTF BETWEEN 2 AND 4)::INT AS "4_days", (TTF BETWEEN 2 AND 3)::INT AS "3_days", (TTF BETWEEN 2 AND 2)::INT AS "2_days" FROM ttf""",
)
def _(spark, sf):
    ttf = labels.time_to_failure(_flagged(spark, sf), "flag", "user_id", "ts")
    return labels.horizon_labels(ttf, "TTF", [4, 3, 2]).select("event_id", "4_days", "3_days", "2_days")


@query(
    "l5_horizon_flags_per_component",
    f"""WITH {SIGNALS_SQL}, {FAILURES_SQL} SELECT s.event_id, {", ".join(f'''(EXISTS (SELECT 1 FROM failures f WHERE f.Turbine_ID = s.Turbine_ID AND f.Component = '{c}'
          AND round_even((epoch_us(f.Timestamp) - epoch_us(s.Timestamp)) / 86400000000.0, 2) BETWEEN 2 AND 5))::INT AS "Fail_5_{c}"''' for c in COMPONENTS)}
        FROM signals s""",
)
def _(spark, sf):
    grid = signals(spark, sf).select("event_id", *KEYS)
    return labels.horizon_flags_per_component(grid, failures(spark, sf), COMPONENTS, 5).drop(*KEYS)


@query(
    "l6_failure_flags_on_grid",
    f"""WITH u AS (SELECT DISTINCT user_id FROM events), m AS (SELECT min(ts) AS lo, max(ts) AS hi FROM events),
        f AS (SELECT user_id, time_bucket(INTERVAL '10 minutes', date_trunc('minute', ts) + INTERVAL '9 minutes') AS Timestamp,
          (['GENERATOR','HYDRAULIC_GROUP','GENERATOR_BEARING','TRANSFORMER','GEARBOX'])[event_id % 5 + 1] AS Component FROM events WHERE event_type = 'error'),
        g AS (SELECT user_id, unnest(generate_series(date_trunc('day', lo), date_trunc('day', hi) + INTERVAL '1 day', INTERVAL '10 minutes')) AS Timestamp FROM u, m)
        SELECT user_id AS Turbine_ID, count(*) AS n, {", ".join(f'''sum((Component IS NOT DISTINCT FROM '{c}')::INT)::BIGINT AS "Fail_{c}"''' for c in COMPONENTS)}
        FROM g LEFT JOIN f USING (user_id, Timestamp) GROUP BY user_id""",
)
def _(spark, sf):
    from windvane.plans.registry import component_of

    ev = load(spark, sf, "events")
    ends = ev.agg(F.min(F.to_date("ts")).alias("lo"), F.date_add(F.max(F.to_date("ts")), 1).alias("hi")).first()
    users = ev.select(F.col("user_id").alias("Turbine_ID")).distinct()
    grid = joins.entity_grid(users, F.lit(ends["lo"]).cast("timestamp"), F.lit(ends["hi"]).cast("timestamp"))
    raw = ev.filter(F.col("event_type") == "error").select(
        F.col("ts").alias("Timestamp"), F.col("user_id").alias("Turbine_ID"), component_of().alias("Component")
    )
    flags = labels.failure_flags_on_grid(grid, raw, COMPONENTS)
    names = [f"Fail_{c}" for c in COMPONENTS]
    return flags.groupBy("Turbine_ID").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in names])


@query(
    "l7_one_hot_component",
    f"WITH {FAILURES_SQL} SELECT event_id, Timestamp, Turbine_ID, (Component = 'GENERATOR')::INT AS Component_GENERATOR FROM failures",
)
def _(spark, sf):
    return labels.one_hot(failures(spark, sf), "Component", COMPONENTS, keep=["GENERATOR"])


@query(
    "l8_one_hot_remarks",
    "SELECT event_id, "
    + ", ".join(f"""(event_id % 20 = {i})::INT AS "Remark_{m}" """ for i, m in enumerate(labels.REMARKS))
    + f" FROM events WHERE event_id % 20 < {len(labels.REMARKS)}",
)
def _(spark, sf):
    """Every event carries one of the listed remarks, or one that is not listed."""
    listed = F.array(*[F.lit(m) for m in labels.REMARKS])
    remark = F.coalesce(F.get(listed, (F.col("event_id") % 20).cast("int")), F.lit("another remark"))
    return labels.one_hot_remarks(load(spark, sf, "events").select("event_id", remark.alias("Remark")), ["event_id"])


@query(
    "l8_one_hot_listed",
    """SELECT event_id, (event_type = 'click')::INT AS event_type_click, (event_type = 'error')::INT AS event_type_error
       FROM events WHERE event_type IN ('click', 'error')""",
)
def _(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "event_type")
    return labels.one_hot(ev, "event_type", ["click", "error"], only_listed=True)


@query("l9_top_k_remarks", "SELECT p_name, count(*) AS n FROM part GROUP BY p_name ORDER BY n DESC, p_name LIMIT 15")
def _(spark, sf):
    return aggregates.top_k_values(load(spark, sf, "part"), "p_name", 15)


# --- order, sets, splits -----------------------------------------------------------------------


@query("o1_sort_keys", "SELECT user_id, ts, value FROM events ORDER BY user_id, ts")
def _(spark, sf):
    return splits.sort_keys(load(spark, sf, "events").select("user_id", "ts", "value"), ["user_id", "ts"])


@query("o2_limit_head", "SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 20")
def _(spark, sf):
    return splits.limit_head(load(spark, sf, "orders"), 20, ["o_orderdate", "o_orderkey"])


@query("o2_limit_tail", "SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20")
def _(spark, sf):
    return splits.limit_tail(load(spark, sf, "orders"), 20, ["o_orderdate", "o_orderkey"])


@query("o3_take_range", "SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 500 OFFSET 1000")
def _(spark, sf):
    return splits.take_range(load(spark, sf, "orders"), 1000, 1500, ["o_orderdate", "o_orderkey"])


@query(
    "o4_union_all",
    """SELECT c_name AS name, c_acctbal AS bal, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier""",
)
def _(spark, sf):
    c = load(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("segment"))
    s = load(spark, sf, "supplier").select(F.col("s_acctbal").alias("bal"), F.col("s_name").alias("name"))
    return splits.union_all(c, s)


@query(
    "o5_concat_columns",
    """SELECT coalesce(a.k, b.k) AS k, n_customers::DOUBLE AS n_customers, n_suppliers::DOUBLE AS n_suppliers FROM (SELECT c_nationkey AS k, count(*) AS n_customers FROM customer GROUP BY 1) a
       FULL JOIN (SELECT s_nationkey AS k, count(*) AS n_suppliers FROM supplier GROUP BY 1) b ON a.k = b.k""",
)
def _(spark, sf):
    count = lambda t, c, n: load(spark, sf, t).groupBy(F.col(c).alias("k")).agg(F.count(F.lit(1)).cast("double").alias(n))
    return splits.concat_columns(count("customer", "c_nationkey", "n_customers"), count("supplier", "s_nationkey", "n_suppliers"), ["k"])


@query("o6_drop_duplicates", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def _(spark, sf):
    return splits.drop_duplicates(load(spark, sf, "orders").select("o_custkey", "o_orderstatus"))


def _parts(train, test, *cols):
    return train.select(F.lit("train").alias("part"), *cols).unionByName(test.select(F.lit("test").alias("part"), *cols))


@query(
    "o7_split_by_months",
    """WITH c AS (SELECT max_by(l_shipdate, (l_suppkey, l_shipdate)) - INTERVAL 3 MONTH AS cut FROM lineitem)
       SELECT CASE WHEN l_shipdate < cut THEN 'train' ELSE 'test' END AS part, l_orderkey, l_linenumber, l_shipdate FROM lineitem, c""",
)
def _(spark, sf):
    train, test = splits.split_by_months(load(spark, sf, "lineitem"), "l_shipdate", 3, ["l_suppkey", "l_shipdate"])
    return _parts(train, test, "l_orderkey", "l_linenumber", "l_shipdate")


@query(
    "o8_split_by_date",
    "SELECT CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'train' ELSE 'test' END AS part, o_orderkey FROM orders",
)
def _(spark, sf):
    return _parts(*splits.split_by_date(load(spark, sf, "orders"), "o_orderdate", "2000-01-01"), "o_orderkey")


@query(
    "o9_split_by_fraction",
    """SELECT CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey) <= floor(0.8 * count(*) OVER ()) THEN 'train' ELSE 'test' END AS part,
       o_orderkey FROM orders""",
)
def _(spark, sf):
    return _parts(*splits.split_by_fraction(load(spark, sf, "orders"), 0.8, ["o_orderdate", "o_orderkey"]), "o_orderkey")


@query(
    "o10_split_swap_period",
    """SELECT CASE WHEN o_orderdate > TIMESTAMP '1995-07-31' THEN 'train' ELSE 'test' END AS part, o_orderkey FROM orders""",
)
def _(spark, sf):
    train, test = splits.split_by_date(load(spark, sf, "orders"), "o_orderdate", "2000-01-01")
    return _parts(*splits.split_swap_period(train, test, "o_orderdate", "1995-01-01", "1995-07-31"), "o_orderkey")


# --- scaling -----------------------------------------------------------------------------------

_NUM = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    "c1_standard_scale",
    f"""WITH t AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01'),
        m AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _NUM)} FROM t)
        SELECT l_orderkey, l_linenumber, {", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in _NUM)} FROM lineitem, m""",
)
def _(spark, sf):
    df = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", *_NUM)
    train, _test = splits.split_by_date(df, "l_shipdate", "2000-01-01")
    out = scaling.apply_scaler(df, scaling.fit_scaler(train, _NUM), _NUM)
    return out.select("l_orderkey", "l_linenumber", *[r(c).alias(c) for c in _NUM])


@query(
    "c2_standard_scale_by_group",
    """SELECT event_id, round((value - avg(value) OVER w) / nullif(stddev_pop(value) OVER w, 0), 6) AS value FROM events
       WINDOW w AS (PARTITION BY user_id)""",
)
def _(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "user_id", "value")
    out = scaling.apply_scaler(ev, scaling.fit_scaler(ev, ["value"], by="user_id"), ["value"], by="user_id")
    return out.select("event_id", r("value").alias("value"))


@query(
    "c3_minmax_scale",
    """WITH m AS (SELECT min(value) lo, max(value) hi FROM events) SELECT event_id, round((value - lo) / (hi - lo), 6) AS value FROM events, m""",
)
def _(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "value")
    return scaling.apply_scaler(ev, scaling.fit_scaler(ev, ["value"], "minmax"), ["value"]).withColumn("value", r("value"))


@query(
    "c4_scale_each_column",
    f"""WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
        m AS (SELECT avg(o_totalprice) AS a, stddev_pop(o_totalprice) AS s, avg(o_custkey) AS ca, stddev_pop(o_custkey) AS cs FROM t)
        SELECT CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'train' ELSE 'test' END AS part, o_orderkey,
          round((o_totalprice - a) / s, 6) AS o_totalprice, round((o_custkey - ca) / cs, 6) AS o_custkey FROM orders, m""",
)
def _(spark, sf):
    train, test = splits.split_by_date(load(spark, sf, "orders"), "o_orderdate", "2000-01-01")
    a, b = scaling.scale_each_column(train, test, ["o_totalprice", "o_custkey"])
    return _parts(a, b, "o_orderkey", r("o_totalprice").alias("o_totalprice"), r("o_custkey").alias("o_custkey"))
