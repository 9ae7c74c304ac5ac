"""Sorting, positions, unions and the splits into training and test rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windvane.functions.time import months_offset
from windvane.operators.ordered import place_rows
from windvane.operators.select import filter_time_range


def sort_keys(df: DataFrame, cols: list[str]) -> DataFrame:
    """Total order for an output; scans and windows state their own order."""
    return df.orderBy(*cols)


def limit_head(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def limit_tail(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def take_range(df: DataFrame, low: int, high: int, order: list[str], task_rows: int | None = None) -> DataFrame:
    """Rows ``low`` (included) to ``high`` (excluded) of the stated order."""
    placed = place_rows(df, order, "_pos", task_rows)
    return placed.filter((F.col("_pos") >= low) & (F.col("_pos") < high)).drop("_pos")


def union_all(*frames: DataFrame) -> DataFrame:
    """Rows of all tables by column name; a missing column is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def concat_columns(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Columns side by side, rows matched by key (rows present on one side only stay)."""
    return left.join(right, on, "full")


def drop_duplicates(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return df.dropDuplicates(cols) if cols else df.dropDuplicates()


def split_by_months(
    df: DataFrame, ts: str, months: int = 3, order: list[str] | None = None, global_max: bool = False, days: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Test rows start ``months`` before the date of the last row.

    The last row is the last one in ``order`` (turbine, then time), so its date is the last
    turbine's last date; ``global_max`` takes the largest date of the table. The date is one
    scalar aggregate and enters both filters as a literal, which the file scan can use.
    """
    order = order or [ts]
    last = F.max(ts) if global_max else F.max_by(F.col(ts), F.struct(*order))
    end = df.agg(last.alias("last")).select(
        (F.col("last") - F.make_dt_interval(F.lit(days))) if days is not None else months_offset("last", -months)
    )
    cut = end.first()[0]
    literal = F.to_timestamp_ntz(F.lit(str(cut)))
    if isinstance(df.schema[ts].dataType, T.DateType):
        literal = literal.cast("date")
    return df.filter(F.col(ts) < literal), df.filter(F.col(ts) >= literal)


def split_by_date(df: DataFrame, ts: str, cut: str) -> tuple[DataFrame, DataFrame]:
    return filter_time_range(df, ts, end=cut), filter_time_range(df, ts, start=cut)


def split_by_fraction(df: DataFrame, fraction: float, order: list[str], task_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """First share of the ordered rows, and the rest."""
    border = int(df.count() * fraction)
    placed = place_rows(df, order, "_pos", task_rows)
    return placed.filter(F.col("_pos") < border).drop("_pos"), placed.filter(F.col("_pos") >= border).drop("_pos")


def split_swap_period(train: DataFrame, test: DataFrame, ts: str, start: str, end: str) -> tuple[DataFrame, DataFrame]:
    """Test becomes one closed period of the training rows; training becomes the rows after it plus the old test rows."""
    inside = filter_time_range(train, ts, start, end, closed="both")
    later = filter_time_range(train, ts, start=end, closed="neither")
    return later.unionByName(test), inside
