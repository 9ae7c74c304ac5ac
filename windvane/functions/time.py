"""Time expressions. All of them stay JVM-side; they raise on a session clock other than UTC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000
MICROS_PER_DAY = 86_400_000_000


_UTC = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "Zulu", "UCT", "+00:00", "UTC+00:00", "GMT+0", "GMT0"}


def require_utc() -> None:
    """Raises when the session clock is not UTC: times without zone would be read on another clock and move."""
    session = SparkSession.getActiveSession()
    zone = session.conf.get("spark.sql.session.timeZone") if session else "UTC"
    if zone not in _UTC:
        raise ValueError(f"the session clock is {zone}; set spark.sql.session.timeZone to UTC")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def micros(col: Column | str) -> Column:
    """Microseconds since the epoch of a timestamp with or without zone."""
    require_utc()
    return F.unix_micros(_c(col).cast("timestamp"))


def from_micros(value: Column) -> Column:
    return F.timestamp_micros(value).cast("timestamp_ntz")


def to_utc_naive(col: Column | str, cut: int | None = None) -> Column:
    """Timestamp text to a UTC wall clock without zone.

    ``cut`` keeps only that many leading characters, which drops the zone text instead of
    applying it. Text that is not a timestamp becomes null.
    """
    require_utc()
    if cut is not None:
        return F.try_to_timestamp(F.substring(_c(col), 1, cut)).cast("timestamp_ntz")
    return F.try_to_timestamp(_c(col)).cast("timestamp_ntz")


def floor_time(col: Column | str, minutes: int = 10) -> Column:
    """Start of the step the instant lies in."""
    m = micros(col)
    return from_micros(m - F.pmod(m, F.lit(minutes * MICROS_PER_MINUTE)))


def ceil_time(col: Column | str, minutes: int = 10) -> Column:
    """Seconds are dropped first, then the next step mark is taken (a mark keeps its place)."""
    m = micros(col)
    whole = m - F.pmod(m, F.lit(MICROS_PER_MINUTE))
    return from_micros(whole + F.pmod(-whole, F.lit(minutes * MICROS_PER_MINUTE)))


def floor_hour(col: Column | str) -> Column:
    return floor_time(col, 60)


def round_hour(col: Column | str) -> Column:
    """Nearest hour, half an hour goes up (over midnight too)."""
    return floor_time(_c(col) + F.expr("INTERVAL 30 MINUTES"), 60)


def to_date(col: Column | str) -> Column:
    return F.to_date(_c(col))


def days_between(start: Column | str, end: Column | str, digits: int | None = 2) -> Column:
    """Fractional days from ``start`` to ``end``, rounded half to even."""
    days = (micros(end) - micros(start)) / F.lit(float(MICROS_PER_DAY))
    return days if digits is None else F.bround(days, digits)


def months_offset(col: Column | str, months: int) -> Column:
    """Shift by calendar months; a missing day of month becomes the last day."""
    return _c(col) + F.make_ym_interval(F.lit(0), F.lit(months))


def age_from_birthdate(col: Column | str, year: int) -> Column:
    return F.lit(year) - F.year(F.to_date(_c(col)))


def time_grid(spark: SparkSession, start: str, end: str, minutes: int = 10, name: str = "Timestamp") -> DataFrame:
    """Every step from ``start`` to ``end``, both included; the rows are generated in parallel."""
    bounds = spark.range(1).select(
        micros(F.to_timestamp_ntz(F.lit(start))).alias("lo"), micros(F.to_timestamp_ntz(F.lit(end))).alias("hi")
    ).first()
    step = minutes * MICROS_PER_MINUTE
    steps = (bounds["hi"] - bounds["lo"]) // step + 1
    return spark.range(steps).select(from_micros(F.lit(bounds["lo"]) + F.col("id") * F.lit(step)).alias(name))
