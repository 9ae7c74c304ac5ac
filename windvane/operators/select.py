"""Projections, filters and column choice."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windvane.operators.aggregates import correlation_matrix
from windvane.session import broadcast_if_small


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*cols)


def select_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Projection in the given order, which fixes the order of a feature vector."""
    return df.select(*[F.col(f"`{c}`") for c in cols])


def columns_matching(df: DataFrame, substring: str) -> list[str]:
    """Names that contain the text anywhere, in table order."""
    return [c for c in df.columns if substring in c]


def component_slice(df: DataFrame, prefixes: list[str], keys: list[str]) -> DataFrame:
    """Keys plus the columns of each name part, in the order of the parts; a column matched twice stays once."""
    cols = dict.fromkeys(c for p in prefixes for c in columns_matching(df, p) if c not in keys)
    return select_columns(df, [*keys, *cols])


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def filter_eq(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(col) == F.lit(value))


def filter_in(df: DataFrame, col: str, values: list) -> DataFrame:
    return df.filter(F.col(col).isin(list(values)))


def filter_time_range(df: DataFrame, col: str, start=None, end=None, closed: str = "left") -> DataFrame:
    """Rows between two instants; ``closed`` is left, right, both or neither. The bounds reach the file scan."""
    c = F.col(col)
    literal = lambda v: v if isinstance(v, Column) else F.to_timestamp_ntz(F.lit(str(v)))
    if start is not None:
        df = df.filter(c >= literal(start) if closed in ("left", "both") else c > literal(start))
    if end is not None:
        df = df.filter(c <= literal(end) if closed in ("right", "both") else c < literal(end))
    return df


def filter_between(df: DataFrame, col: str, low, high) -> DataFrame:
    return df.filter(F.col(col).between(low, high))


def drop_constant_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop the listed columns that hold one single value (deviation 0); one aggregate decides all."""
    parts = []
    for c in cols:
        col = F.col(f"`{c}`")
        parts += [((F.min(col) == F.max(col)) & (F.count(col) > 1)).alias(c)]
    row = df.agg(*parts).first()
    return df.drop(*[c for c in cols if row[c]])


def _number_or_text_present(df: DataFrame, name: str) -> Column:
    col = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return col.isNotNull() & ~F.isnan(col)
    return col.isNotNull()


def drop_sparse_columns(df: DataFrame, share: float = 0.5) -> DataFrame:
    """Keep columns whose number of present values is at least ``share`` of the rows."""
    counts = [F.count_if(_number_or_text_present(df, c)).alias(c) for c in df.columns]
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *counts).first()
    return select_columns(df, [c for c in df.columns if row[c] >= row["_rows"] * share])


def drop_sparse_rows(df: DataFrame, share: float = 0.5) -> DataFrame:
    """Keep rows with present values in at least ``share`` of the columns."""
    return df.na.drop(thresh=math.ceil(len(df.columns) * share))


def drop_correlated(df: DataFrame, cols: list[str], threshold: float) -> DataFrame:
    """Walk the columns in order; drop each one that correlates too strongly with a kept one."""
    pairs = correlation_matrix(df, cols).collect()  # cols x cols numbers
    strength = {(r["a"], r["b"]): abs(r["corr"]) for r in pairs if r["corr"] is not None}
    kept: list[str] = []
    for c in cols:
        if all(strength.get((k, c), 0.0) <= threshold for k in kept):
            kept.append(c)
    return df.drop(*[c for c in cols if c not in kept])


def split_xy(df: DataFrame, features: list[str], label: str, label_cast: str = "trunc", keys: list[str] | None = None) -> DataFrame:
    """Feature vector and integer label; the averaged label is cut ("trunc") or rounded half to even ("round")."""
    from pyspark.ml.feature import VectorAssembler

    y = F.col(f"`{label}`")
    y = F.bround(y, 0) if label_cast == "round" else y
    whole = df.withColumn("label", y.cast("int").cast("double"))
    vector = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")
    return vector.transform(whole).select(*(keys or []), "features", "label")


def select_by_dtype(df: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None) -> DataFrame:
    """Columns by type name ("double", "string", ...; "number" means every numeric type)."""

    def named(field: T.StructField, names: list[str]) -> bool:
        return field.dataType.simpleString() in names or (
            "number" in names and isinstance(field.dataType, T.NumericType)
        )

    keep = [
        f.name
        for f in df.schema.fields
        if (include is None or named(f, include)) and not (exclude is not None and named(f, exclude))
    ]
    return select_columns(df, keep)


def truncate_after(df: DataFrame, bounds: DataFrame, key: str, ts: str, bound: str = "bound") -> DataFrame:
    """Cut each group's history after its bound (group without bound: kept whole)."""
    limits = broadcast_if_small(bounds.groupBy(key).agg(F.min(bound).alias("_bound")))
    joined = df.join(limits, key, "left")
    return joined.filter(F.col("_bound").isNull() | (F.col(ts) <= F.col("_bound"))).select(*df.columns)


def replace_values(df: DataFrame, mapping: dict, cols: list[str]) -> DataFrame:
    """Recode values; values without entry stay."""
    return df.replace(mapping, subset=cols)
