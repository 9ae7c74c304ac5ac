"""Scalar column expressions for texts, codes, flags and thresholds."""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def regex_remove(col: Column | str, pattern: str = r"\.") -> Column:
    return F.regexp_replace(_c(col), pattern, "")


def upper(col: Column | str) -> Column:
    return F.upper(_c(col))


def zfill_prefix(col: Column | str, width: int = 5, keep: int = 2) -> Column:
    """Left-pad with zeros up to ``width`` (longer text is untouched) and keep the first characters."""
    text = _c(col).cast("string")
    padded = F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)
    return F.substring(padded, 1, keep)


def split_cast(df: DataFrame, col: str, sep: str, names: list[str], types: list[str]) -> DataFrame:
    """Split a text column at the first separators into typed columns (text that will not cast is null)."""
    parts = F.split(F.col(col), f"\\Q{sep}\\E", len(names))
    rest = [F.col(c) for c in df.columns if c != col]
    cast = [F.get(parts, F.lit(i)).try_cast(t).alias(n) for i, (n, t) in enumerate(zip(names, types))]
    return df.select(*rest, *cast)


def map_codes(col: Column | str, mapping: dict) -> Column:
    """Dictionary lookup; a value without entry becomes null."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(table, _c(col))


def cast_int(col: Column | str) -> Column:
    """Integer by cutting the fraction off."""
    return _c(col).cast("int")


def round_half_even(col: Column | str, digits: int = 0) -> Column:
    return F.bround(_c(col), digits)


def ceil(col: Column | str) -> Column:
    return F.ceil(_c(col))


def case_flag(condition: Column) -> Column:
    """1 where the condition holds; 0 where it does not or is unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def nested_case_class(cases: list[tuple[Column, int]], default: int = 0) -> Column:
    """Code of the first condition that holds."""
    first, rest = cases[0], cases[1:]
    return reduce(lambda acc, case: acc.when(case[0], F.lit(case[1])), rest, F.when(first[0], F.lit(first[1]))).otherwise(
        F.lit(default)
    )


def or_predicate(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def at_least(score: Column | str, cut: Column | float) -> Column:
    """Score to decision: 1 at or above the cut."""
    return case_flag(_c(score) >= (cut if isinstance(cut, Column) else F.lit(cut)))
