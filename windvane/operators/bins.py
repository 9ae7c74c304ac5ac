"""Discretisation into right-closed bins, numbered from 1."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windvane.operators.ordered import quantiles


def _numbered(value: Column, lower_edges: list[float]) -> Column:
    """Number of lower edges the value lies above; a missing value has no bin."""
    place = F.lit(0)
    for edge in lower_edges:
        place = place + F.when(value > F.lit(float(edge)), 1).otherwise(0)
    return F.when(value.isNotNull() & ~F.isnan(value), place)


def bin_quantile(df: DataFrame, col: str, n: int = 10, name: str | None = None, task_rows: int | None = None) -> DataFrame:
    """Bins with equal row shares between exact interpolated quantiles; the smallest value is in bin 1."""
    edges = quantiles(df, col, [i / n for i in range(n + 1)], task_rows=task_rows).first()["quantiles"]
    if len(set(edges)) < len(edges):
        raise ValueError(f"bin edges of {col} are not unique: {edges}")
    value = F.col(f"`{col}`").cast("double")
    above = _numbered(value, edges[1:-1])
    return df.withColumn(name or f"{col}_bin", above + 1)


def bin_width(df: DataFrame, col: str, n: int = 10, name: str | None = None) -> DataFrame:
    """Bins of equal width; the lowest edge is lowered by 0.1 % of the range so that the minimum is in bin 1."""
    value = F.col(f"`{col}`").cast("double")
    row = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    lo, hi = row["lo"], row["hi"]
    if lo is None:
        return df.withColumn(name or f"{col}_bin", F.lit(None).cast("int"))
    if lo == hi:
        pad = 0.001 * abs(lo) if lo != 0 else 0.001
        edges = np.linspace(lo - pad, hi + pad, n + 1)
    else:
        edges = np.linspace(lo, hi, n + 1)
        edges[0] -= (hi - lo) * 0.001
    return df.withColumn(name or f"{col}_bin", _numbered(value, list(edges[:-1])))
