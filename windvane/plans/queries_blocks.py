"""The plans for large data on the test tables: groups cut into blocks, joins without a broadcast side.

The SQL is the one of the plain queries: results do not depend on the plan.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from windvane.operators import aggregates, bins, evaluation, joins, labels, neighbours, nulls, windows
from windvane.plans import queries_columns as columns
from windvane.plans import queries_models as quality
from windvane.plans import queries_tables as tables
from windvane.plans.registry import COMPONENTS, SQL, failures, load, query, r, signals


def _same_as(name):
    return query(f"{name}_in_blocks", SQL[name])


@_same_as("n1_backfill")
def _(spark, sf):
    return nulls.backfill(columns._gaps(spark, sf), ["v"], ["ts"], ["user_id"], task_rows=20)


@_same_as("n1_backfill_whole_table")
def _(spark, sf):
    return nulls.backfill(columns._gaps(spark, sf), ["v"], ["user_id", "ts"], task_rows=1000)


@_same_as("n2_interpolate_linear")
def _(spark, sf):
    out = nulls.interpolate_linear(columns._gaps(spark, sf), ["v"], ["ts"], ["user_id"], task_rows=20)
    return out.withColumn("v", r("v"))


@_same_as("j5_join_asof_backward")
def _(spark, sf):
    left, right = tables._asof_sides(spark, sf)
    return joins.join_asof(left, right.drop("user_id"), "ts", right_ts="err_ts", task_rows=1000)


@_same_as("j6_join_asof_nearest")
def _(spark, sf):
    left, right = tables._asof_sides(spark, sf)
    return joins.join_asof(left, right, "ts", ["user_id"], "nearest", right_ts="err_ts", task_rows=20).select("event_id", "err_id")


@_same_as("w1_rolling_mean")
def _(spark, sf):
    out = windows.rolling_mean(tables._daily(spark, sf), ["value"], ["Turbine_ID"], ["Date"], 10, task_rows=12)
    return tables._text_date(out).select("Turbine_ID", "Date", "n", r("value_av", 8).alias("value_av"))


@_same_as("w4_rolling_sum_global")
def _(spark, sf):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"]
    out = windows.rolling_sum(load(spark, sf, "lineitem"), "l_quantity", order, 10, name="quantity_10", task_rows=5000)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "quantity_10")


@_same_as("w7_cumulative_sum")
def _(spark, sf):
    out = windows.cumulative_sum(load(spark, sf, "events"), "value", ["ts"], task_rows=1000)
    return out.select("event_id", r("value_cum", 2).alias("value_cum"))


@_same_as("w9_row_position")
def _(spark, sf):
    return windows.row_position(load(spark, sf, "orders"), ["o_orderdate", "o_orderkey"], task_rows=1000).select("o_orderkey", "pos")


@_same_as("l2_ttf_days")
def _(spark, sf):
    return labels.time_to_failure(tables._flagged(spark, sf), "flag", "user_id", "ts", task_rows=20).select("event_id", "TTF")


@_same_as("l5_horizon_flags_per_component")
def _(spark, sf):
    grid = signals(spark, sf).select("event_id", *tables.KEYS)
    return labels.horizon_flags_per_component(grid, failures(spark, sf), COMPONENTS, 5, task_rows=20).drop(*tables.KEYS)


@_same_as("a6_freq_cumulative")
def _(spark, sf):
    out = aggregates.freq_cumulative(load(spark, sf, "lineitem"), "l_partkey", task_rows=300)
    return out.select("l_partkey", "n", r("share", 9).alias("share"), r("cum_share", 9).alias("cum_share"))


@_same_as("a14_box_stats")
def _(spark, sf):
    out = aggregates.box_stats(load(spark, sf, "lineitem"), "l_extendedprice", "l_returnflag", task_rows=3000)
    return out.withColumns({c: r(c, 4) for c in ("q25", "q50", "q75")})


@_same_as("f9_bin_quantile")
def _(spark, sf):
    return bins.bin_quantile(load(spark, sf, "customer"), "c_acctbal", 10, "bin", task_rows=200).select("c_custkey", "bin")


@_same_as("e3_roc_curve")
def _(spark, sf):
    out = evaluation.roc_curve(quality._scored(spark, sf), "y", "score", task_rows=40)
    return out.select(*[r(c, 9).alias(c) for c in ("threshold", "tpr", "fpr", "que")])


@_same_as("e6_savings_metric")
def _(spark, sf):
    out = evaluation.savings_metric(quality._runs(spark, sf), "component", ["user_id", "Date"], ["model"], task_rows=100)
    return out.withColumns({c: F.round(c, 4) for c in ("tp_savings", "savings")})


@query("j1_join_outer_keys_shuffled", SQL["j1_join_outer_keys"])
def _(spark, sf):
    s = signals(spark, sf).select(*tables.KEYS, "value")
    return joins.join_outer_keys(s, failures(spark, sf), "GENERATOR", tables.KEYS, broadcast_bytes=0)


@query("j7_join_horizon_by_day", SQL["j7_join_horizon"])
def _(spark, sf):
    f = failures(spark, sf).withColumnRenamed("event_id", "failure_id")
    s = signals(spark, sf).select("event_id", *tables.KEYS)
    out = joins.join_horizon(s, f, "Turbine_ID", lower=2, upper=4, broadcast_bytes=0)
    return out.select("event_id", "Turbine_ID", "failure_id", "Component", "days_to_failure")


@query("j7_join_horizon_from_zero_by_day", SQL["j7_join_horizon_from_zero"])
def _(spark, sf):
    f = failures(spark, sf).withColumnRenamed("event_id", "failure_id")
    s = signals(spark, sf).select("event_id", *tables.KEYS)
    out = joins.join_horizon(s, f, "Turbine_ID", lower=0, upper=1, broadcast_bytes=0)
    return out.select("event_id", "Turbine_ID", "failure_id", "Component", "days_to_failure")


@_same_as("m6_knn_classify")
def _(spark, sf):
    train, test = quality._halves(spark, sf)
    out = neighbours.knn_classify(train, test, "x", "label", "vec_id", ["vec_id"], 5, block_rows=64, chunk_rows=64)
    return out.select("vec_id", "prediction", r("share").alias("share"))
