"""Mergeable sketches per group and period: distinct counts and quantiles of any span without reading the rows again.

A stored sketch has a bounded size whatever number of rows it stands for. Sketches of days unite to that of a month or of all groups, so a
question about a span reads one small row per group and day of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windvane.functions.time import floor_hour

LG_CELLS = 12  # logarithm of the cells of a distinct-count sketch
RANKS = 400  # size of a quantile sketch
# relative standard error of a distinct count, and rank error of a quantile that 99 of 100 answers keep
DISTINCT_ERROR = 0.83 / 2 ** (LG_CELLS / 2)
RANK_ERROR = 2.446 / RANKS**0.9433


def _period(ts: str, period: str) -> Column:
    return F.to_date(ts) if period == "day" else floor_hour(ts)


def distinct_sketches(df: DataFrame, keys: list[str], ts: str, cols: list[str], period: str = "day", name: str = "Date") -> DataFrame:
    """Keys, period and per column a sketch of its different values (``<column>_distinct``); nulls do not count. One shuffle, of sketches."""
    parts = [F.hll_sketch_agg(F.col(f"`{c}`"), F.lit(LG_CELLS)).alias(f"{c}_distinct") for c in cols]
    return df.groupBy(*keys, _period(ts, period).alias(name)).agg(*parts)


def distinct_over(sketches: DataFrame, keys: list[Column | str], cols: list[str]) -> DataFrame:
    """Estimated distinct counts per key of the united sketches; a filter on the period before it selects the span."""
    return sketches.groupBy(*keys).agg(*[F.hll_sketch_estimate(F.hll_union_agg(f"{c}_distinct")).alias(c) for c in cols])


def quantile_sketches(df: DataFrame, keys: list[str], ts: str, cols: list[str], period: str = "day", name: str = "Date") -> DataFrame:
    """Keys, period and per column a sketch of its distribution (``<column>_ranks``); nulls and values that are no number are left out."""
    number = lambda c: F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double"))
    rows = df.select(*keys, _period(ts, period).alias(name), *[number(c).alias(c) for c in cols])
    return rows.groupBy(*keys, name).agg(*[F.expr(f"kll_sketch_agg_double(`{c}`, {RANKS})").alias(f"{c}_ranks") for c in cols])


def quantiles_over(sketches: DataFrame, keys: list[Column | str], col: str, points: list[float]) -> DataFrame:
    """Keys, ``n`` (values, exact) and ``quantiles`` at the points, of the merged sketches; null where there was no value.

    The share of values up to a quantile differs from its point by about :data:`RANK_ERROR` at most, however many sketches were merged.
    """
    merged = sketches.groupBy(*keys).agg(F.expr(f"kll_merge_agg_double(`{col}_ranks`, {RANKS})").alias("_s"))
    n = F.expr("kll_sketch_get_n_double(_s)")
    at = ", ".join(f"{p!r}D" for p in points)
    found = F.when(n > 0, F.expr(f"kll_sketch_get_quantile_double(_s, array({at}))"))
    return merged.withColumn("n", n).withColumn("quantiles", found).drop("_s")
