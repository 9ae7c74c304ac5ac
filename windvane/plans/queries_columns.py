"""Sources, projections, filters, scalar functions and missing values."""

from __future__ import annotations

from pyspark.sql import functions as F

from windvane.functions import scalar, time
from windvane.operators import bins, evaluation, labels, models, nulls, select, survey, windows
from windvane.plans.registry import FAILURES_SQL, SENSORS, SIGNALS_SQL, component_of, load, query, r, signals
from windvane.session import scratch_path
from windvane.sources import files, stored

PART = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"


# --- sources and sinks -------------------------------------------------------------------------


@query("s1_read_delimited", "SELECT * FROM part")
def _(spark, sf):
    path = scratch_path(spark, "part")
    files.write_csv(load(spark, sf, "part"), path, sep=";")
    return files.read_delimited(spark, path, PART)


@query("s2_read_gz_csv", "SELECT * FROM customer")
def _(spark, sf):
    path = scratch_path(spark, "customer")
    files.write_csv(load(spark, sf, "customer"), path, compression="gzip")
    return files.read_delimited(spark, path, CUSTOMER, sep=",", spread=8)


@query(
    "s3_read_catalog_dir",
    "SELECT 'orders_training_df' AS tbl, count(*) AS n, sum(o_custkey)::BIGINT AS keys FROM orders "
    "UNION ALL SELECT 'part_df', count(*), sum(p_partkey)::BIGINT FROM part",
)
def _(spark, sf):
    folder = scratch_path(spark, "catalog")
    files.write_csv(load(spark, sf, "orders"), f"{folder}/wind-farm-1-orders-training.csv", sep=";")
    files.write_csv(load(spark, sf, "part"), f"{folder}/part.csv", sep=";")
    files.read_catalog_dir(spark, folder, {"orders_training_df": ORDERS, "part_df": PART})
    return spark.sql(
        "SELECT 'orders_training_df' AS tbl, count(*) AS n, sum(o_custkey) AS keys FROM orders_training_df "
        "UNION ALL SELECT 'part_df', count(*), sum(p_partkey) FROM part_df"
    )


def _write_telemetry(spark, sf, folder):
    """Events as text files with the shapes of a signal file, a failure file and an event log."""
    ev = load(spark, sf, "events")
    stamp = F.concat(F.col("ts").cast("string"), F.lit("+00:00"))
    is_error = F.col("event_type") == "error"
    sig = ev.select(
        F.col("user_id").alias("Turbine_ID"), stamp.alias("Timestamp"), "event_id", F.when(~is_error, F.col("value")).alias("value"),
        F.lit(None).cast("double").alias("Prod_LatestAvg_ActPwrGen2"), F.lit(None).cast("double").alias("Prod_LatestAvg_ReactPwrGen2"),
    )
    fail = ev.filter(is_error).select(
        F.col("user_id").alias("Turbine_ID"), component_of().alias("Component"), stamp.alias("Timestamp"), F.col("props").alias("Remarks")
    )
    logs = ev.select(
        stamp.alias("TimeDetected"), F.col("user_id").alias("UnitTitle"), F.col("event_type").alias("Remark"),
        F.lit("x").alias("UnitTitleDestination"),
    )
    for name, df in (("signals", sig), ("failures", fail), ("logs", logs)):
        files.write_csv(df, f"{folder}/{name}.csv", sep=";")
    schemas = {
        "signals": "Turbine_ID bigint, Timestamp string, event_id bigint, value double, "
        "Prod_LatestAvg_ActPwrGen2 double, Prod_LatestAvg_ReactPwrGen2 double",
        "failures": "Turbine_ID bigint, Component string, Timestamp string, Remarks string",
        "logs": "TimeDetected string, UnitTitle bigint, Remark string, UnitTitleDestination string",
    }
    return {n: f"{folder}/{n}.csv" for n in schemas}, schemas


@query(
    "s4_ingest_signals",
    """SELECT user_id AS Turbine_ID, time_bucket(INTERVAL '10 minutes', ts) AS Timestamp, event_id,
         first_value(CASE WHEN event_type <> 'error' THEN value END IGNORE NULLS) OVER (
           PARTITION BY user_id ORDER BY ts, event_id
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS value
       FROM events""",
)
def _(spark, sf):
    paths, schemas = _write_telemetry(spark, sf, scratch_path(spark, "telemetry"))
    df = files.ingest_signals(spark, paths["signals"], schemas["signals"], order=["Timestamp", "event_id"])
    return df.select("Turbine_ID", "Timestamp", "event_id", "value")


@query(
    "s5_ingest_all",
    f"""WITH {FAILURES_SQL}, logs AS (
        SELECT time_bucket(INTERVAL '10 minutes', ts) AS Timestamp, user_id AS Turbine_ID, event_type AS Remark FROM events),
        filled AS (SELECT time_bucket(INTERVAL '10 minutes', ts) AS Timestamp, user_id AS Turbine_ID, first_value(
          CASE WHEN event_type <> 'error' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS value FROM events)
        SELECT 'failures' AS tbl, Timestamp, Turbine_ID, Component AS detail, NULL::DOUBLE AS value FROM failures
        UNION ALL SELECT 'logs', Timestamp, Turbine_ID, Remark, NULL FROM logs
        UNION ALL SELECT 'signals', Timestamp, Turbine_ID, 'Turbine_ID,Timestamp,event_id,value', value FROM filled""",
)
def _(spark, sf):
    paths, schemas = _write_telemetry(spark, sf, scratch_path(spark, "telemetry"))
    t = files.ingest_all(spark, paths, schemas, order=["Timestamp", "event_id"])
    nothing = F.lit(None).cast("double")
    part = lambda name, detail, value=nothing: t[name].select(
        F.lit(name).alias("tbl"), "Timestamp", "Turbine_ID", detail.alias("detail"), value.alias("value")
    )
    signals_ = part("signals", F.lit(",".join(t["signals"].columns)), F.col("value"))
    return part("failures", F.col("Component")).unionByName(part("logs", F.col("Remark"))).unionByName(signals_)


@query("s6_read_indexed_csv", "SELECT * FROM part")
def _(spark, sf):
    path = scratch_path(spark, "indexed")
    df = load(spark, sf, "part")
    files.write_csv(df.select((F.col("p_partkey") + 100).alias("_index"), *df.columns), path)
    return files.read_indexed_csv(spark, path, PART)


@query("s7_write_csv", "SELECT * FROM orders")
def _(spark, sf):
    path = scratch_path(spark, "orders")
    files.write_csv(load(spark, sf, "orders"), path)
    return spark.read.schema(ORDERS).option("header", True).csv(path)


@query(
    "s7_stored_history",
    """SELECT event_id, first_value(CASE WHEN event_type = 'view' THEN value END IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS filled,
         round(avg(value) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 8) AS value_av,
         coalesce(min(CASE WHEN event_type = 'error' THEN ts END) OVER (w RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), ts) AS date
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)""",
)
def _(spark, sf):
    """Events stored by turbine and time: gap filling, rolling mean and next failure read the stored table without a shuffle."""
    ev = load(spark, sf, "events").withColumn("view", F.when(F.col("event_type") == "view", F.col("value")))
    rows = ev.select("event_id", "user_id", "ts", "value", "view", scalar.case_flag(F.col("event_type") == "error").alias("flag"))
    path = scratch_path(spark, "history")
    stored.write_history(rows, path, "user_id", "ts", 8)
    filled = nulls.backfill(stored.read_history(spark, path), ["view"], ["ts"], ["user_id"])
    rolled = windows.rolling_mean(filled, ["value"], ["user_id"], ["ts"], 7)
    found = labels.next_failure_date(rolled, "flag", "user_id", "ts")
    return found.select("event_id", F.col("view").alias("filled"), r("value_av", 8).alias("value_av"), "date")


@query(
    "s8_write_metric_log",
    """WITH c AS (SELECT sum((quality=1 AND toxic=1)::INT) tp, sum((quality=0 AND toxic=0)::INT) tn,
                 sum((quality=0 AND toxic=1)::INT) fp, sum((quality=1 AND toxic=0)::INT) fn FROM labels),
        m AS (SELECT round((tp+tn)/(tp+tn+fp+fn),6) AS accuracy, round(tp/(tp+fn),6) AS recall FROM c)
        SELECT 'first' AS run, accuracy, recall FROM m UNION ALL SELECT 'second', accuracy, recall FROM m""",
)
def _(spark, sf):
    path = scratch_path(spark, "metrics")
    df = load(spark, sf, "labels").withColumn("score", F.col("toxic").cast("double"))
    found = evaluation.classification_metrics(df, "quality", "toxic", "score")
    for run in ("first", "second"):
        files.write_metric_log(found.select(F.lit(run).alias("run"), r("accuracy").alias("accuracy"), r("recall").alias("recall")), path)
    return spark.read.parquet(path)


# --- projections and filters -------------------------------------------------------------------


@query("p1_drop_columns", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def _(spark, sf):
    return select.drop_columns(load(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("p2_select_columns", "SELECT l_shipdate, l_orderkey, l_extendedprice FROM lineitem")
def _(spark, sf):
    return select.select_columns(load(spark, sf, "lineitem"), ["l_shipdate", "l_orderkey", "l_extendedprice"])


@query("p3_columns_matching", "SELECT l_shipdate, l_extendedprice FROM lineitem")
def _(spark, sf):
    df = load(spark, sf, "lineitem")
    return df.select(*select.columns_matching(df, "date"), *select.columns_matching(df, "price"))


@query(
    "p4_component_slice",
    f"""WITH {SIGNALS_SQL} SELECT Timestamp, Turbine_ID, round(avg(value) FILTER (event_type='click'),8) AS Hyd_click,
        round(avg(value) FILTER (event_type='signup'),8) AS Gen_signup
        FROM signals GROUP BY ALL""",
)
def _(spark, sf):
    s = signals(spark, sf)
    named = {"click": "Hyd_click", "view": "Rtr_view", "signup": "Gen_signup", "purchase": "Volt_purchase"}
    wide = s.groupBy("Timestamp", "Turbine_ID").pivot("event_type", SENSORS).agg(F.round(F.avg("value"), 8))
    return select.component_slice(select.rename_columns(wide, named), ["Gen", "Hyd"], ["Timestamp", "Turbine_ID"])


@query("p5_rename_columns", "SELECT event_id, ts AS Timestamp, user_id AS Turbine_ID, event_type AS Remark FROM events")
def _(spark, sf):
    df = load(spark, sf, "events").select("event_id", F.col("ts").alias("TimeDetected"), F.col("user_id").alias("UnitTitle"), "event_type")
    return select.rename_columns(df, {**files.LOG_NAMES, "event_type": "Remark"})


@query("p6_filter_eq", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def _(spark, sf):
    return select.filter_eq(load(spark, sf, "orders"), "o_orderstatus", "F")


@query("p7_filter_in", "SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def _(spark, sf):
    return select.filter_in(load(spark, sf, "customer"), "c_mktsegment", ["BUILDING", "MACHINERY"])


@query(
    "p8_filter_time_range",
    "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-07-01'",
)
def _(spark, sf):
    return select.filter_time_range(load(spark, sf, "orders"), "o_orderdate", "1996-01-01", "1997-07-01")


@query("p9_filter_between", "SELECT * FROM part WHERE p_size BETWEEN 10 AND 20")
def _(spark, sf):
    return select.filter_between(load(spark, sf, "part"), "p_size", 10, 20)


@query("p10_or_predicate", "SELECT * FROM events WHERE event_type = 'error' OR event_type = 'signup'")
def _(spark, sf):
    return load(spark, sf, "events").filter(
        scalar.or_predicate(F.col("event_type") == "error", F.col("event_type") == "signup")
    )


@query("p11_case_flag", "SELECT event_id, CASE WHEN value BETWEEN 20 AND 60 THEN 1 ELSE 0 END AS flag FROM events")
def _(spark, sf):
    return load(spark, sf, "events").select("event_id", scalar.case_flag(F.col("value").between(20, 60)).alias("flag"))


@query(
    "p12_nested_case_class",
    """SELECT event_id, CASE event_type WHEN 'error' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3
       WHEN 'purchase' THEN 4 ELSE 0 END AS class FROM events""",
)
def _(spark, sf):
    cases = [(F.col("event_type") == t, i + 1) for i, t in enumerate(["error", "click", "view", "purchase"])]
    return load(spark, sf, "events").select("event_id", scalar.nested_case_class(cases).alias("class"))


@query("p13_drop_constant_columns", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def _(spark, sf):
    df = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.lit(3.5).alias("offset"))
    df = df.withColumn("zero", F.col("l_quantity") * 0)
    return select.drop_constant_columns(df, ["l_quantity", "offset", "zero"])


@query(
    "p14_drop_sparse_columns",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS half FROM orders",
)
def _(spark, sf):
    key = F.col("o_orderkey")
    df = load(spark, sf, "orders").select(
        key, F.when(key % 2 == 0, F.col("o_totalprice")).alias("half"), F.when(key % 3 == 0, F.col("o_totalprice")).alias("third")
    )
    return select.drop_sparse_columns(df)


@query(
    "p15_drop_sparse_rows",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey::DOUBLE END AS a, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey::DOUBLE END AS b,
       CASE WHEN o_orderkey % 5 = 0 THEN o_custkey::DOUBLE END AS c, CASE WHEN o_orderkey % 7 = 0 THEN o_custkey::DOUBLE END AS d FROM orders
       WHERE (o_orderkey % 2 = 0)::INT + (o_orderkey % 3 = 0)::INT + (o_orderkey % 5 = 0)::INT + (o_orderkey % 7 = 0)::INT >= 2""",
)
def _(spark, sf):
    key = F.col("o_orderkey")
    df = load(spark, sf, "orders").select(
        key, *[F.when(key % m == 0, F.col("o_custkey").cast("double")).alias(n) for n, m in (("a", 2), ("b", 3), ("c", 5), ("d", 7))]
    )
    return select.drop_sparse_rows(df)


@query("p16_drop_correlated", "SELECT l_orderkey, l_quantity, l_discount, l_extendedprice FROM lineitem")
def _(spark, sf):
    df = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_quantity", (F.col("l_quantity") * 2 + 1).alias("twice"), "l_discount", "l_extendedprice",
        (F.col("l_extendedprice") * (-1)).alias("minus"),
    )
    return select.drop_correlated(df, ["l_quantity", "twice", "l_discount", "l_extendedprice", "minus"], 0.99)


@query(
    "p17_split_xy",
    """SELECT l_orderkey, l_linenumber, l_quantity AS x0, l_discount AS x1, trunc(l_tax * 30)::DOUBLE AS label FROM lineitem""",
)
def _(spark, sf):
    from pyspark.ml.functions import vector_to_array

    df = load(spark, sf, "lineitem").withColumn("y", F.col("l_tax") * 30)
    xy = select.split_xy(df, ["l_quantity", "l_discount"], "y", keys=["l_orderkey", "l_linenumber"])
    x = vector_to_array("features")
    return xy.select("l_orderkey", "l_linenumber", x[0].alias("x0"), x[1].alias("x1"), "label")


@query("p18_select_by_dtype", "SELECT p_size, p_retailprice FROM part")
def _(spark, sf):
    return select.select_by_dtype(load(spark, sf, "part"), include=["number"], exclude=["bigint"])


@query(
    "p19_truncate_after",
    """WITH b AS (SELECT user_id, min(ts) AS bound FROM events WHERE event_type = 'error' AND value > 100 GROUP BY user_id)
       SELECT e.* FROM events e LEFT JOIN b USING (user_id) WHERE bound IS NULL OR ts <= bound""",
)
def _(spark, sf):
    ev = load(spark, sf, "events")
    bounds = ev.filter((F.col("event_type") == "error") & (F.col("value") > 100)).select("user_id", F.col("ts").alias("bound"))
    return select.truncate_after(ev, bounds, "user_id", "ts")


@query(
    "p20_replace_values",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS o_orderstatus FROM orders",
)
def _(spark, sf):
    df = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return select.replace_values(df, {"F": "done", "O": "open"}, ["o_orderstatus"])


# --- missing values ----------------------------------------------------------------------------

_GAPS_SQL = "gaps AS (SELECT event_id, ts, user_id, CASE WHEN event_type <> 'error' THEN value END AS v FROM events)"


def _gaps(spark, sf):
    return load(spark, sf, "events").select(
        "event_id", "ts", "user_id", F.when(F.col("event_type") != "error", F.col("value")).alias("v")
    )


@query(
    "n1_backfill",
    f"""WITH {_GAPS_SQL} SELECT event_id, ts, user_id, first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v FROM gaps""",
)
def _(spark, sf):
    return nulls.backfill(_gaps(spark, sf), ["v"], ["ts"], ["user_id"])


@query(
    "n1_backfill_whole_table",
    f"""WITH {_GAPS_SQL} SELECT event_id, ts, user_id, first_value(v IGNORE NULLS) OVER (ORDER BY user_id, ts
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v FROM gaps""",
)
def _(spark, sf):
    return nulls.backfill(_gaps(spark, sf), ["v"], ["user_id", "ts"])


@query(
    "n2_interpolate_linear",
    f"""WITH {_GAPS_SQL}, p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS k FROM gaps),
        q AS (SELECT event_id, ts, user_id, v, k,
          last_value(CASE WHEN v IS NOT NULL THEN k END IGNORE NULLS) OVER b AS k0, last_value(v IGNORE NULLS) OVER b AS v0,
          first_value(CASE WHEN v IS NOT NULL THEN k END IGNORE NULLS) OVER a AS k1, first_value(v IGNORE NULLS) OVER a AS v1
          FROM p WINDOW b AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                        a AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
        SELECT event_id, ts, user_id, round(CASE WHEN v IS NOT NULL OR v0 IS NULL THEN v WHEN v1 IS NULL THEN v0
          ELSE v0 + (v1 - v0) * (k - k0) / (k1 - k0) END, 6) AS v FROM q""",
)
def _(spark, sf):
    out = nulls.interpolate_linear(_gaps(spark, sf), ["v"], ["ts"], ["user_id"])
    return out.withColumn("v", r("v"))


@query("n3_fill_constant", f"WITH {_GAPS_SQL} SELECT event_id, ts, user_id, coalesce(v, 0) AS v FROM gaps")
def _(spark, sf):
    return nulls.fill_constant(_gaps(spark, sf), 0, ["v"])


@query(
    "n4_fill_from_column",
    "SELECT event_id, ts, CASE WHEN event_type = 'error' THEN ts + INTERVAL 1 DAY ELSE ts END AS date FROM events",
)
def _(spark, sf):
    ev = load(spark, sf, "events")
    dated = ev.select("event_id", "ts", F.when(F.col("event_type") == "error", F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("date"))
    return nulls.fill_from_column(dated, "date", "ts")


@query(
    "n5_null_profile",
    f"""WITH {_GAPS_SQL} SELECT 'event_id' AS "column", count(*) FILTER (event_id IS NULL) AS nulls, false AS any_null FROM gaps
        UNION ALL SELECT 'v', count(*) FILTER (v IS NULL), bool_or(v IS NULL) FROM gaps""",
)
def _(spark, sf):
    return nulls.null_profile(_gaps(spark, sf).select("event_id", "v"))


# --- time expressions --------------------------------------------------------------------------


@query("d1_to_utc_naive", "SELECT event_id, ts - INTERVAL 1 HOUR AS utc, date_trunc('second', ts) AS cut FROM events")
def _(spark, sf):
    text = F.concat(F.col("ts").cast("string"), F.lit("+01:00"))
    ev = load(spark, sf, "events").select("event_id", text.alias("t"))
    return ev.select("event_id", time.to_utc_naive("t").alias("utc"), time.to_utc_naive("t", cut=19).alias("cut"))


@query("d2_floor_10min", "SELECT event_id, time_bucket(INTERVAL '10 minutes', ts) AS t FROM events")
def _(spark, sf):
    return load(spark, sf, "events").select("event_id", time.floor_time("ts").alias("t"))


@query("d3_floor_hour", "SELECT event_id, date_trunc('hour', ts) AS t FROM events")
def _(spark, sf):
    return load(spark, sf, "events").select("event_id", time.floor_hour("ts").alias("t"))


@query(
    "d4_ceil_10min",
    "SELECT event_id, time_bucket(INTERVAL '10 minutes', date_trunc('minute', ts) + INTERVAL '9 minutes') AS t FROM events",
)
def _(spark, sf):
    return load(spark, sf, "events").select("event_id", time.ceil_time("ts").alias("t"))


@query("d5_round_half_hour", "SELECT event_id, date_trunc('hour', ts + INTERVAL '30 minutes') AS t FROM events")
def _(spark, sf):
    return load(spark, sf, "events").select("event_id", time.round_hour("ts").alias("t"))


@query("d6_to_date", "SELECT event_id, ts::DATE::VARCHAR AS d FROM events")
def _(spark, sf):
    return load(spark, sf, "events").select("event_id", time.to_date("ts").cast("string").alias("d"))


@query(
    "d7_days_between",
    "SELECT event_id, round_even(epoch_us(TIMESTAMP '2024-02-01') / 86400000000.0 - epoch_us(ts) / 86400000000.0, 2) AS days FROM events",
)
def _(spark, sf):
    end = F.to_timestamp_ntz(F.lit("2024-02-01 00:00:00"))
    return load(spark, sf, "events").select("event_id", time.days_between(F.col("ts"), end).alias("days"))


@query(
    "d8_time_grid",
    """SELECT unnest(generate_series((SELECT date_trunc('day', min(ts)) FROM events), (SELECT date_trunc('day', max(ts)) FROM events),
       INTERVAL '10 minutes')) AS Timestamp""",
)
def _(spark, sf):
    ends = load(spark, sf, "events").agg(F.min(F.to_date("ts")).alias("a"), F.max(F.to_date("ts")).alias("b")).first()
    return time.time_grid(spark, f"{ends['a']} 00:00:00", f"{ends['b']} 00:00:00")


@query("d9_months_offset", "SELECT o_orderkey, o_orderdate - INTERVAL 3 MONTH AS t, (o_orderdate::DATE - INTERVAL 3 MONTH)::DATE::VARCHAR AS d FROM orders")
def _(spark, sf):
    o = load(spark, sf, "orders")
    day = time.months_offset(F.to_date("o_orderdate"), -3).cast("string")
    return o.select("o_orderkey", time.months_offset("o_orderdate", -3).alias("t"), day.alias("d"))


@query("d10_age_from_birthdate", "SELECT o_orderkey, (2021 - year(o_orderdate))::INT AS age FROM orders")
def _(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("b"))
    return o.select("o_orderkey", time.age_from_birthdate("b", 2021).alias("age"))


# --- text, codes, rounding, bins ---------------------------------------------------------------


@query("f1_regex_remove", "SELECT doc_id, replace(text, '.', '') AS text FROM documents")
def _(spark, sf):
    return load(spark, sf, "documents").select("doc_id", scalar.regex_remove("text").alias("text"))


@query("f2_upper", "SELECT p_partkey, upper(p_name) AS name FROM part")
def _(spark, sf):
    return load(spark, sf, "part").select("p_partkey", scalar.upper("p_name").alias("name"))


@query(
    "f3_zfill_prefix",
    """SELECT o_orderkey, substr(CASE WHEN length(o_custkey::VARCHAR || '7') < 5 THEN lpad(o_custkey::VARCHAR || '7', 5, '0')
       ELSE o_custkey::VARCHAR || '7' END, 1, 2) AS code FROM orders""",
)
def _(spark, sf):
    o = load(spark, sf, "orders")
    return o.select("o_orderkey", scalar.zfill_prefix(F.concat(F.col("o_custkey").cast("string"), F.lit("7"))).alias("code"))


@query(
    "f4_split_cast",
    """SELECT p_partkey, p_retailprice AS speed, CASE p_size WHEN 2 THEN 2000 ELSE p_size END AS power FROM part""",
)
def _(spark, sf):
    text = F.concat_ws(",", F.col("p_retailprice").cast("string"), F.col("p_size").cast("string"))
    curve = load(spark, sf, "part").select("p_partkey", text.alias("curve"))
    parts = scalar.split_cast(curve, "curve", ",", ["speed", "power"], ["double", "int"])
    return select.replace_values(parts, {2: 2000}, ["power"])


@query(
    "f5_map_codes",
    """SELECT p_partkey, CASE p_size WHEN 1 THEN 'Manytimes' WHEN 2 THEN 'Onetimebyday' WHEN 3 THEN '5/6timesforweek'
       WHEN 4 THEN '4timesforweek' WHEN 5 THEN '1/3timesforweek' WHEN 6 THEN '1timeformonth' WHEN 7 THEN '1/trimestre'
       WHEN 8 THEN 'Less' WHEN 9 THEN 'Never' END AS answer FROM part""",
)
def _(spark, sf):
    return load(spark, sf, "part").select("p_partkey", scalar.map_codes("p_size", survey.FREQUENCY).alias("answer"))


@query("f6_cast_int", "SELECT l_orderkey, l_linenumber, trunc(l_extendedprice / 7)::INT AS v FROM lineitem")
def _(spark, sf):
    return load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", scalar.cast_int(F.col("l_extendedprice") / 7).alias("v"))


@query("f7_round_label", "SELECT l_orderkey, l_linenumber, round_even(l_quantity / 2, 0) AS v FROM lineitem")
def _(spark, sf):
    return load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", scalar.round_half_even(F.col("l_quantity") / 2).alias("v"))


@query("f8_ceil", "SELECT event_id, ceil(value / 10)::BIGINT AS v FROM events")
def _(spark, sf):
    return load(spark, sf, "events").select("event_id", scalar.ceil(F.col("value") / 10).alias("v"))


@query(
    "f9_bin_quantile",
    """WITH q AS (SELECT quantile_cont(c_acctbal, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS e FROM customer)
       SELECT c_custkey, (1 + len(list_filter(e, lambda x: c_acctbal > x)))::INT AS bin FROM customer, q""",
)
def _(spark, sf):
    return bins.bin_quantile(load(spark, sf, "customer"), "c_acctbal", 10, "bin").select("c_custkey", "bin")


@query(
    "f10_bin_width",
    """WITH m AS (SELECT min(p_retailprice) lo, max(p_retailprice) hi FROM part)
       SELECT p_partkey, greatest(1, ceil((p_retailprice - lo) / ((hi - lo) / 10)))::INT AS bin FROM part, m""",
)
def _(spark, sf):
    return bins.bin_width(load(spark, sf, "part"), "p_retailprice", 10, "bin").select("p_partkey", "bin")


@query(
    "f11_threshold",
    """SELECT event_id, event_type, CASE WHEN value / 500 >= CASE event_type WHEN 'click' THEN 0.2 WHEN 'view' THEN 0.05 ELSE 0.1 END
       THEN 1 ELSE 0 END AS y_pred FROM events""",
)
def _(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "event_type", (F.col("value") / 500).alias("score"))
    cuts = spark.createDataFrame([("click", 0.2), ("view", 0.05)], "event_type string, cut double")
    return models.apply_thresholds(ev, cuts, ["event_type"], default=0.1).select("event_id", "event_type", "y_pred")


@query("f12_timestamp_slice_compare", "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'")
def _(spark, sf):
    return select.filter_time_range(load(spark, sf, "orders"), "o_orderdate", end="1997")


# --- the survey table --------------------------------------------------------------------------


@query(
    "t1_clean_table",
    """WITH s AS (SELECT c_custkey AS id, CASE WHEN c_nationkey % 2 = 0 THEN 'M' ELSE 'Mme' END AS civility,
         DATE '1940-01-01' + (c_custkey * 37 % 21000)::INT AS birthdate, c_mktsegment AS city, c_custkey::VARCHAR AS pc,
         c_acctbal AS surveyduration, (1 + c_custkey % 9)::INT AS q1,
         CASE WHEN c_custkey % 2 = 0 THEN c_nationkey::DOUBLE END AS half,
         CASE WHEN c_custkey % 11 > 0 THEN c_nationkey::DOUBLE END AS x1, CASE WHEN c_custkey % 11 > 0 THEN c_nationkey::DOUBLE END AS x2,
         CASE WHEN c_custkey % 11 > 0 THEN c_nationkey::DOUBLE END AS x3, CASE WHEN c_custkey % 11 > 0 THEN c_nationkey::DOUBLE END AS x4,
         CASE WHEN c_custkey % 11 > 0 THEN c_nationkey::DOUBLE END AS x5, CASE WHEN c_custkey % 11 > 0 THEN c_nationkey::DOUBLE END AS x6,
         CASE WHEN c_custkey % 11 > 0 THEN c_nationkey::DOUBLE END AS x7, CASE WHEN c_custkey % 11 > 0 THEN c_nationkey::DOUBLE END AS x8,
         CASE WHEN c_custkey % 11 > 0 THEN c_nationkey::DOUBLE END AS x9, CASE WHEN c_custkey % 11 > 0 THEN c_nationkey::DOUBLE END AS x10 FROM customer),
       k AS (SELECT * FROM s WHERE 9 + (half IS NOT NULL)::INT + 10 * (x1 IS NOT NULL)::INT >= 10),
       q AS (SELECT quantile_cont(surveyduration, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS e,
              min(2021 - year(birthdate)) lo, max(2021 - year(birthdate)) hi FROM k)
       SELECT id, civility, birthdate::VARCHAR AS birthdate, upper(city) AS city, substr(CASE WHEN length(pc) < 5 THEN lpad(pc, 5, '0') ELSE pc END, 1, 2) AS postal_code,
         surveyduration, CASE q1 WHEN 1 THEN 'Manytimes' WHEN 2 THEN 'Onetimebyday' WHEN 3 THEN '5/6timesforweek'
           WHEN 4 THEN '4timesforweek' WHEN 5 THEN '1/3timesforweek' WHEN 6 THEN '1timeformonth' WHEN 7 THEN '1/trimestre'
           WHEN 8 THEN 'Less' WHEN 9 THEN 'Never' END AS Frequency,
         half, x1, x2, x3, x4, x5, x6, x7, x8, x9, x10, birthdate::VARCHAR AS Year_Month,
         greatest(1, ceil((2021 - year(birthdate) - lo) / ((hi - lo) / 10)))::INT AS Age,
         (1 + len(list_filter(e, lambda x: surveyduration > x)))::INT AS duration FROM k, q""",
)
def _(spark, sf):
    c = load(spark, sf, "customer")
    key, nation = F.col("c_custkey"), F.col("c_nationkey").cast("double")
    table = c.select(
        key.alias("id"),
        F.when(nation % 2 == 0, "M.").otherwise("Mme.").alias("civility"),
        F.date_add(F.lit("1940-01-01").cast("date"), (key * 37 % 21000).cast("int")).alias("birthdate"),
        F.lower("c_mktsegment").alias("city"),
        key.cast("string").alias("postal_code"),
        F.lit(1).alias("vote_1"),
        F.col("c_acctbal").alias("surveyduration"),
        (F.lit(1) + key % 9).cast("int").alias("q1"),
        F.when(key % 2 == 0, nation).alias("half"),
        F.when(key % 5 == 0, nation).alias("sparse"),
        *[F.when(key % 11 > 0, nation).alias(f"x{i}") for i in range(1, 11)],
    )
    out = survey.clean_table(table, survey.SurveySpec(year=2021))
    return out.withColumns({c: F.col(c).cast("string") for c in ("birthdate", "Year_Month")})
