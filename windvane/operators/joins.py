"""Joins between telemetry, failure logs, weather and time grids."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windvane.functions.time import MICROS_PER_DAY, MICROS_PER_MINUTE, days_between, from_micros, micros
from windvane.operators.ordered import known, lay_out
from windvane.session import broadcast_if_small, is_small


def join_outer_rare(signals: DataFrame, rare: DataFrame, keys: list[str], broadcast_bytes: int | None = None) -> DataFrame:
    """Full outer equi join where the right side is usually tiny.

    A measured-small right side is broadcast, so the left rows are not shuffled: matched rows come
    from a left join, and the right rows without partner from an anti join with the keys that did
    match, which are no more than the right side's own keys. A larger right side uses the shuffled
    full join.
    """
    if not is_small(rare, broadcast_bytes):
        return signals.join(rare, keys, "full")
    matched = signals.join(F.broadcast(rare), keys, "left")
    seen = signals.select(*keys).join(F.broadcast(rare.select(*keys)), keys, "left_semi").distinct()
    alone = rare.join(F.broadcast(seen), keys, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def join_outer_keys(
    signals: DataFrame,
    failures: DataFrame,
    component: str | None,
    keys: list[str],
    zero_fill: bool = True,
    component_col: str = "Component",
    flag: str = "Component",
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Full outer join with one component's failures; the flag is 1 on failure rows and 0 elsewhere.

    A failure without a signal row stays as a row of its own, and its sensors become 0 with
    ``zero_fill``.
    """
    chosen = failures if component is None else failures.filter(F.col(component_col) == F.lit(component))
    joined = join_outer_rare(signals, chosen.select(*keys, F.lit(1).alias("_hit")), keys, broadcast_bytes)
    out = joined.withColumn(flag, F.coalesce(F.col("_hit"), F.lit(0))).drop("_hit")
    sensors = [f.name for f in signals.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in keys]
    return out.na.fill(0, subset=sensors) if zero_fill and sensors else out


def join_keys(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    return left.join(broadcast_if_small(right) if how in ("left", "inner") else right, on, how)


def join_renamed(
    left: DataFrame, right: DataFrame, left_on: list[str], right_on: list[str], how: str = "left", suffix: str = "_right"
) -> DataFrame:
    """Join on differently named keys; the right keys are dropped and clashing right names get a suffix."""
    names = {c: (f"{c}{suffix}" if c in left.columns and c not in right_on else c) for c in right.columns}
    keyed = {k: f"_key{i}" for i, k in enumerate(right_on)}
    right = right.select(*[F.col(f"`{c}`").alias(keyed.get(c, names[c])) for c in right.columns])
    condition = None
    for l, r in zip(left_on, right_on):
        part = F.col(f"`{l}`") == F.col(keyed[r])
        condition = part if condition is None else condition & part
    return left.join(broadcast_if_small(right), condition, how).drop(*keyed.values())


def _asof_scan(left, right, ts, right_ts, by, carried, direction, task_rows):
    """Left rows with the packed right row before (``_backward``) and/or after them (``_forward``)."""
    # at equal times the right row must lie on the side that is looked at; for "nearest" the row before
    # wins such a tie anyway, so one order serves both scans
    side_left, side_right = (0, 1) if direction == "forward" else (1, 0)
    packed = F.struct(F.col(right_ts).alias("_at"), *[F.col(f"`{c}`").alias(c) for c in carried])
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in carried]) if carried else F.lit(0).cast("long")
    rights = right.filter(F.col(right_ts).isNotNull()).select(
        *[F.col(f"`{b}`") for b in by], F.col(right_ts).alias(ts), F.lit(side_right).alias("_side"), tie.alias("_tie"), packed.alias("_found")
    )
    nothing = F.lit(None).cast(rights.schema["_found"].dataType)
    lefts = left.withColumns({"_side": F.lit(side_left), "_tie": F.lit(0).cast("long"), "_found": nothing})
    order = [ts, "_side", "_tie"]
    both, layout = lay_out(lefts.unionByName(rights, allowMissingColumns=True), by, order, task_rows)
    if direction in ("backward", "nearest"):
        both = known(both, {"_backward": F.col("_found")}, by, order, "previous", layout, task_rows)
    if direction in ("forward", "nearest"):
        both = known(both, {"_forward": F.col("_found")}, by, order, "next", layout, task_rows)
    return both.filter(F.col("_side") == side_left)


def join_asof(
    left: DataFrame,
    right: DataFrame,
    ts: str,
    by: list[str] | None = None,
    direction: str = "backward",
    tolerance_minutes: float | None = None,
    right_ts: str | None = None,
    task_rows: int | None = None,
) -> DataFrame:
    """Closest right row in time: the last one at or before (``backward``), the first one at or after
    (``forward``), or the closer of both (``nearest``, the earlier one on a tie).

    Both sides are merged into one ordered scan, so no pair outside the result is ever built and a
    group of any size is cut into blocks. Beyond the tolerance the right columns are null, and so they are
    for left rows without a time or without one of the ``by`` keys.
    """
    by = list(by or [])
    right_ts = right_ts or ts
    carried = [c for c in right.columns if c not in by and c != right_ts]
    clash = [c for c in carried if c in left.columns]
    if clash:
        raise ValueError(f"right columns would overwrite left ones: {clash}")
    out = _asof_scan(left, right, ts, right_ts, by, carried, direction, task_rows)
    if direction == "nearest":
        back = micros(F.col(ts)) - micros(F.col("_backward._at"))
        ahead = micros(F.col("_forward._at")) - micros(F.col(ts))
        chosen = F.when(ahead.isNull() | (back <= ahead), F.col("_backward")).otherwise(F.col("_forward"))
    else:
        chosen = F.col(f"_{direction}")
    placed = F.col(ts).isNotNull()
    for b in by:
        placed = placed & F.col(f"`{b}`").isNotNull()
    out = out.withColumn("_chosen", F.when(placed, chosen))
    if tolerance_minutes is not None:
        gap = F.abs(micros(F.col(ts)) - micros(F.col("_chosen._at")))
        out = out.withColumn("_chosen", F.when(gap <= F.lit(int(tolerance_minutes * MICROS_PER_MINUTE)), F.col("_chosen")))
    name = f"{right_ts}_matched"
    return out.select(
        *[F.col(f"`{c}`") for c in left.columns],
        F.col("_chosen._at").alias(name),
        *[F.col(f"_chosen.`{c}`").alias(c) for c in carried],
    )


def join_horizon(
    signals: DataFrame,
    failures: DataFrame,
    key: str,
    ts: str = "Timestamp",
    failure_ts: str = "Timestamp",
    lower: float = 2,
    upper: float = 60,
    name: str = "days_to_failure",
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Every failure that lies ``lower`` to ``upper`` days (rounded to 2 decimals) after a signal row.

    Each failure is listed under the calendar days it can match and both sides meet on (key, day), so
    a signal tests only failures near it and no task sees a whole turbine. A list measured small is broadcast.
    ``lower`` may be negative: failures before the signal. Rows without key or time match nothing.
    """
    right = failures.select(
        F.col(key).alias("_key"),
        F.col(failure_ts).alias("failure_ts"),
        *[F.col(f"`{c}`") for c in failures.columns if c not in (key, failure_ts)],
    )
    days = days_between(F.col(ts), F.col("failure_ts"), 2)
    condition = (F.col(key) == F.col("_key")) & days.between(lower, upper)
    # d days lie between two instants and floor(d) to ceil(d) between their dates; rounding widens the range by half a hundredth
    fail_day, first, last = F.to_date("failure_ts"), math.ceil(upper + 0.005), math.floor(lower - 0.005)
    offsets = F.sequence(F.lit(min(first, last)), F.lit(first))
    right = right.filter(fail_day.isNotNull()).withColumn("_day", F.explode(F.transform(offsets, lambda n: F.date_sub(fail_day, n))))
    right = broadcast_if_small(right, broadcast_bytes)
    left = signals.withColumn("_signal_day", F.to_date(ts))
    condition = condition & (F.col("_signal_day") == F.col("_day"))
    return left.join(right, condition, "inner").withColumn(name, days).drop("_key", "_day", "_signal_day")


def cross_grid(times: DataFrame, entities: list, name: str = "Turbine_ID") -> DataFrame:
    """Every time for each listed turbine: each time row fans out over the fixed list, without a shuffle."""
    return times.withColumn(name, F.explode(F.array(*[F.lit(e) for e in entities])))


def entity_grid(entities: DataFrame, start: Column, end: Column, minutes: int = 10, name: str = "Timestamp") -> DataFrame:
    """Every step between two instants for each row of an entity table.

    The steps are generated from the entity row (first days, then steps inside the day), so no
    table is multiplied with another; ``start`` and ``end`` may be columns of the entity table.
    """
    step = minutes * MICROS_PER_MINUTE
    lo, hi = micros(start), micros(end)
    per_leap = max(1, MICROS_PER_DAY // step)
    leaps = F.sequence(F.lit(0).cast("long"), F.floor((hi - lo) / F.lit(step * per_leap)).cast("long"))
    days = entities.withColumns({"_lo": lo, "_hi": hi}).withColumn("_leap", F.explode(leaps))
    steps = days.withColumn("_step", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(per_leap - 1).cast("long"))))
    at = F.col("_lo") + (F.col("_leap") * F.lit(per_leap) + F.col("_step")) * F.lit(step)
    return steps.withColumn("_at", at).filter(F.col("_at") <= F.col("_hi")).withColumn(name, from_micros(F.col("_at"))).drop(
        "_lo", "_hi", "_leap", "_step", "_at"
    )


def grid_left_join(grid: DataFrame, df: DataFrame, on: list[str], ts: str = "Timestamp", until=None, after=None) -> DataFrame:
    """Complete grid with the data where there is some; one of both date bounds may cut the result."""
    from windvane.operators.select import filter_time_range

    if until is not None and after is not None:
        raise ValueError("give only one of until and after")
    # the bound is on a join key, so it is applied to the grid before the join
    return join_keys(filter_time_range(grid, ts, after, until), df, on, "left")


def semi_join(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return df.join(broadcast_if_small(keys.select(*on)), on, "left_semi")


def anti_join(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return df.join(broadcast_if_small(keys.select(*on)), on, "left_anti")
