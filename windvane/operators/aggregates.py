"""Grouped summaries. Every one is a partial (map-side) aggregate before its shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windvane.functions.time import floor_hour
from windvane.operators.ordered import quantiles, running_sum

# A column counts as constant when its squared spread is below this share of its squared sum.
NARROW = 12  # columns whose pairs are aggregates of their own
NO_SPREAD = 1e-12


def numeric_columns(df: DataFrame, without: list[str] | tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in without]


def group_by_period(
    df: DataFrame,
    keys: list[str],
    ts: str,
    period: str = "day",
    strategy: str = "mean",
    cols: list[str] | None = None,
    name: str = "Date",
) -> DataFrame:
    """Mean (or maximum) of the numeric columns per key and day or hour."""
    at = {"day": F.to_date(ts), "hour": floor_hour(ts)}[period].alias(name)
    how = {"mean": F.avg, "max": F.max}[strategy]
    cols = numeric_columns(df, [*keys, ts]) if cols is None else cols
    return df.groupBy(*keys, at).agg(*[how(F.col(f"`{c}`")).alias(c) for c in cols])


def group_mean_exact_ts(df: DataFrame, keys: list[str], strategy: str = "mean", cols: list[str] | None = None) -> DataFrame:
    """Collapse rows that share all keys (turbine and timestamp) to their mean or maximum."""
    how = {"mean": F.avg, "max": F.max}[strategy]
    cols = numeric_columns(df, keys) if cols is None else cols
    return df.groupBy(*keys).agg(*[how(F.col(f"`{c}`")).alias(c) for c in cols])


def group_count(df: DataFrame, keys: list[str], cols: list[str] | None = None) -> DataFrame:
    """Present values per group and column."""
    cols = [c for c in df.columns if c not in keys] if cols is None else cols
    return df.groupBy(*keys).agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in cols])


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """Frequency of each present value, most frequent first, ties by value."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name))
    return counts.orderBy(F.desc(name), F.asc(col))


def top_k_values(df: DataFrame, col: str, k: int = 15, name: str = "n") -> DataFrame:
    """The k most frequent values."""
    return value_counts(df, col, name).limit(k)


def value_counts_pivot(df: DataFrame, row: str, col: str, values: list) -> DataFrame:
    """Counts per row value with one column per listed value; a missing combination is null."""
    return df.groupBy(row).pivot(col, values).agg(F.count(F.lit(1)))


def freq_cumulative(df: DataFrame, col: str, task_rows: int | None = None) -> DataFrame:
    """Count, relative and cumulative relative frequency in the order of :func:`value_counts`."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    ordered = counts.withColumn("_down", -F.col("n"))
    summed = running_sum(ordered, {"_cum": F.col("n")}, [], ["_down", col], task_rows=task_rows)
    return summed.select(
        col, "n", (F.col("n") / F.lit(float(total))).alias("share"), (F.col("_cum") / F.lit(float(total))).alias("cum_share")
    )


def nunique(df: DataFrame, cols: list[str], approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(F.col(c)).alias(c) for c in cols])


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def describe(df: DataFrame, cols: list[str], exact: bool = False) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum, one row per column.

    ``exact`` interpolates the quartiles over all values; otherwise they are sketched.
    """
    points = [0.25, 0.5, 0.75]
    out = None
    stats = []
    for c in cols:
        col = F.col(f"`{c}`").cast("double")
        stats.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(col).alias("count"),
                F.avg(col).alias("mean"),
                F.stddev_samp(col).alias("std"),
                F.min(col).alias("min"),
                F.percentile_approx(col, points, 10000).alias("q") if not exact else F.lit(None).cast("array<double>").alias("q"),
                F.max(col).alias("max"),
            ).alias(c)
        )
    out = df.agg(*stats).select(F.explode(F.array(*[F.col(f"`{c}`") for c in cols])).alias("s")).select("s.*")
    if exact:
        pairs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("v")) for c in cols]
        long = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")  # all columns in one pass
        found = quantiles(long, "v", points, ["column"]).select("column", F.col("quantiles").alias("q"))
        out = out.drop("q").join(F.broadcast(found), "column", "left")  # one row per column
    return out.select(
        "column", "count", "mean", "std", "min",
        F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"), "max",
    )


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every column pair (long form), over the rows where both values are present.

    Up to ``NARROW`` columns all pairs are aggregates of one pass in the JVM, whose running means leave a constant column exactly without spread. With more columns each task
    adds up the product sums of all pairs as matrices. Either way only sums are shuffled. A pair has no correlation (null) when one of its columns has no
    spread over the rows they share, apart from rounding, or holds an infinite number there; else it lies between -1 and 1.
    """
    if len(cols) > NARROW:
        return _product_sums(df, cols)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    num = df.select(*[_present_number(c).alias(f"c{i}") for i, c in enumerate(cols)])
    both = lambda of, other: F.when(F.col(f"c{other}").isNotNull(), F.col(f"c{of}"))
    spread = lambda i, j: F.sqrt(F.var_pop(both(i, j))) * F.sqrt(F.var_pop(both(j, i)))
    row = num.agg(*[F.try_divide(F.covar_pop(f"c{i}", f"c{j}"), spread(i, j)).alias(f"r{i}_{j}") for i, j in pairs])
    cells = [F.struct(F.lit(cols[i]).alias("a"), F.lit(cols[j]).alias("b"), F.col(f"r{min(i, j)}_{max(i, j)}").alias("corr")) for i in range(len(cols)) for j in range(len(cols))]
    return row.select(F.explode(F.array(*cells)).alias("p")).select("p.a", "p.b", _clipped(F.col("p.corr")).alias("corr"))


def _clipped(corr: Column) -> Column:
    return F.when(corr.isNotNull() & ~F.isnan(corr), F.greatest(F.least(corr, F.lit(1.0)), F.lit(-1.0)))


def _present_number(name: str) -> Column:
    return F.nanvl(F.col(f"`{name}`").cast("double"), F.lit(None).cast("double"))


def _product_sums(df: DataFrame, cols: list[str]) -> DataFrame:
    num = [_present_number(c).alias(f"c{i}") for i, c in enumerate(cols)]
    # one number per column; sums around it keep their digits, and a constant column becomes exactly zero
    centre = lambda c: F.when(F.min(c) == F.max(c), F.min(c)).otherwise(F.avg(c))
    shift = np.array([0.0 if m is None else m for m in df.agg(*[centre(_present_number(c)) for c in cols]).first()])

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((4, len(cols), len(cols)))
        for pdf in batches:
            x = pdf.to_numpy(dtype=np.float64) - shift
            there = ~np.isnan(x)
            x, m = np.where(there, x, 0.0), there.astype(np.float64)
            sums += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
        i, j = np.indices(sums.shape[1:])
        n, s, ss, p = (v.ravel() for v in sums)
        mirror = lambda v: v.reshape(sums.shape[1:]).T.ravel()
        yield pd.DataFrame(
            {"i": i.ravel(), "j": j.ravel(), "n": n, "sx": s, "sy": mirror(s), "sxx": ss, "syy": mirror(ss), "sxy": p}
        )

    partial = df.select(*num).mapInPandas(
        add_up, "i long, j long, n double, sx double, sy double, sxx double, syy double, sxy double"
    )
    total = partial.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    n = F.col("n")
    left = lambda s, ss: F.col(ss) - F.try_divide(F.col(s) * F.col(s), n)
    spread = lambda s, ss: F.when(left(s, ss) > F.col(ss) * NO_SPREAD, left(s, ss))
    together = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), n)
    corr = F.try_divide(together, F.sqrt(spread("sx", "sxx") * spread("sy", "syy")))
    names = F.array(*[F.lit(c) for c in cols])
    at = lambda i: F.get(names, F.col(i).cast("int"))
    return total.select(at("i").alias("a"), at("j").alias("b"), _clipped(corr).alias("corr"))


def min_max(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.min(col).alias("min"), F.max(col).alias("max"))


def confusion_crosstab(df: DataFrame, y: str, pred: str, classes: list | None = None) -> DataFrame:
    """Actual classes as rows, predicted classes as columns."""
    classes = [0, 1] if classes is None else classes
    return df.groupBy(y).pivot(pred, classes).agg(F.count(F.lit(1))).na.fill(0)


def row_share(df: DataFrame, condition: Column, name: str = "share") -> DataFrame:
    """Share of all rows that satisfy a condition (unknown counts as no)."""
    return df.agg(F.avg(F.coalesce(condition.cast("int"), F.lit(0)).cast("double")).alias(name))


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width bin counts; the last bin includes its upper edge, empty bins are listed."""
    value = F.col(f"`{col}`").cast("double")
    row = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    lo, hi = row["lo"], row["hi"]
    if lo is None:
        lo, hi = 0.0, 1.0
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    step = (hi - lo) / bins
    place = F.least(F.floor((value - F.lit(lo)) / F.lit(step)), F.lit(bins - 1)).cast("int")
    counts = df.filter(value.isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    listed = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return listed.join(F.broadcast(counts), "bin", "left").select(  # at most one row per bin
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(step)).alias("low"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(step)).alias("high"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


def box_stats(df: DataFrame, value: str, group: str, task_rows: int | None = None) -> DataFrame:
    """Exact five-number summary per group."""
    found = quantiles(df, value, [0.0, 0.25, 0.5, 0.75, 1.0], [group], task_rows)
    names = ["min", "q25", "q50", "q75", "max"]
    return found.select(group, *[F.col("quantiles")[i].alias(n) for i, n in enumerate(names)])


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows per class and the balancing weight rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    both = counts.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes")).first()
    return counts.withColumn("weight", F.lit(float(both["rows"] or 0)) / (F.lit(both["classes"]) * F.col("n")))


def with_class_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Balancing weight as a column; the few class weights enter as a lookup, not as a join."""
    weights = {r[label]: r["weight"] for r in class_balance(df, label).collect()}  # one row per class
    column = F.lit(1.0)
    for value, weight in weights.items():
        column = F.when(F.col(label) == F.lit(value), F.lit(weight)).otherwise(column)
    return df.withColumn(name, column)


def total_by_group(df: DataFrame, keys: list[str], value: str, rollup: bool = False, name: str = "total") -> DataFrame:
    grouped = df.rollup(*keys) if rollup else df.groupBy(*keys)
    return grouped.agg(F.sum(value).alias(name))
