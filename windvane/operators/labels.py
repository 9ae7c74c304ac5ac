"""Time to failure and the labels derived from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windvane.functions.scalar import case_flag
from windvane.functions.time import MICROS_PER_DAY, ceil_time, days_between, micros
from windvane.operators import ordered
from windvane.operators.ordered import Layout
from windvane.session import is_small

# Failures of one key that go to its grid rows as a list.
MAX_LISTED = 256

# The event-log remarks that become features.
REMARKS = [
    "External power ref.:2000kW",
    "Generator 1 in",
    "Hot HV trafo 270°C      0kW",
    "Yaw Speed Exc:  0° Rate:10sec",
    "GearoilCooler 2, gear:  57°C",
    "GearoilCooler 1, gear:  49°C",
    "Gen. int. vent. 1, temp: 50°C",
    "Gen. ext. vent. 1, temp: 50°C",
    "Gen. int. vent. 0, temp: 34°C",
    "Gen. ext. vent. 0, temp: 34°C",
    "Gen. ext. vent. 2, temp: 65°C",
    "Gen. ext. vent. 1, temp: 49°C",
    "Yawcontr. from:30010 to:30011",
    "Yawcontr. from:30011 to:30010",
    "Accumulator test done -> OK",
]


def next_failure_date(
    df: DataFrame, flag: str, key: str, ts: str, name: str = "date", entities: list | None = None,
    layout: Layout | None = None, task_rows: int | None = None,
) -> DataFrame:
    """First failure at or after each row of the turbine; a row without later failure gets its own time.

    ``entities`` keeps only the listed turbines.
    """
    if entities is not None:
        df = df.filter(F.col(key).isin(list(entities)))
    # the flag closes the order, so rows at the very time of a failure see it ahead of them
    out = ordered.known(
        df, {name: F.when(F.col(flag) == 1, F.col(ts))}, [key], [ts, flag], "next", layout, task_rows
    )
    return out.withColumn(name, F.coalesce(F.col(name), F.col(ts)))


def time_to_failure(
    df: DataFrame, flag: str, key: str, ts: str, rounding: str | None = "half_even", name: str = "TTF",
    entities: list | None = None, layout: Layout | None = None, task_rows: int | None = None,
) -> DataFrame:
    """Days to the next failure: rounded half to even, cut to whole days ("floor"), or exact (None)."""
    dated = next_failure_date(df, flag, key, ts, "_next", entities, layout, task_rows)
    days = days_between(F.col(ts), F.col("_next"), None)
    days = {"half_even": F.bround(days, 0), "floor": F.floor(days).cast("double"), None: days}[rounding]
    return dated.withColumn(name, days).drop("_next")


def ttf_floor_days(df: DataFrame, flag: str, key: str, ts: str, name: str = "TTF", task_rows: int | None = None) -> DataFrame:
    """Whole days to the next failure; null where no failure follows."""
    out = ordered.known(df, {"_next": F.when(F.col(flag) == 1, F.col(ts))}, [key], [ts, flag], "next", task_rows=task_rows)
    return out.withColumn(name, F.floor(days_between(F.col(ts), F.col("_next"), None)).cast("long")).drop("_next")


def horizon_labels(df: DataFrame, ttf: str, periods: list[int], lower: float | None = 2) -> DataFrame:
    """One column ``<period>_days`` per period: 1 when ``lower <= ttf <= period``; ``lower`` None drops the lower bound."""
    t = F.col(ttf)
    inside = lambda p: (t <= p) if lower is None else t.between(lower, p)
    return df.withColumns({f"{p}_days": case_flag(inside(p)) for p in periods})


def horizon_flags_per_component(
    grid: DataFrame, failures: DataFrame, components: list[str], limit: float, lower: float = 2, key: str = "Turbine_ID",
    ts: str = "Timestamp", component_col: str = "Component", task_rows: int | None = None,
) -> DataFrame:
    """``Fail_<limit>_<component>`` is 1 when some failure of the component lies ``lower`` to ``limit`` days ahead.

    Days are rounded to two decimals, half to even, so the borders are the exact instants
    ``lower - 0.005`` and ``limit + 0.005`` days. It is enough to look at the first failure past
    the lower border: one ordered scan over both tables, without building (row, failure) pairs.
    """
    half = MICROS_PER_DAY // 200
    marks = [f"_f{i}" for i in range(len(components))]
    rows = grid.withColumns(
        {"_at": micros(ts) + F.lit(int(lower * MICROS_PER_DAY) - half), "_side": F.lit(0), **{m: F.lit(None).cast("long") for m in marks}}
    )
    events = failures.select(
        F.col(key),
        micros(ts).alias("_at"),
        F.lit(1).alias("_side"),
        *[F.when(F.col(component_col) == F.lit(c), micros(ts)).alias(m) for c, m in zip(components, marks)],
    )
    both = rows.unionByName(events, allowMissingColumns=True)
    scanned = ordered.known(both, {m: F.col(m) for m in marks}, [key], ["_at", "_side"], "next", task_rows=task_rows)
    last = micros(ts) + F.lit(int(limit * MICROS_PER_DAY) + half)
    name = lambda c: f"Fail_{limit:g}_{c}"
    return scanned.filter(F.col("_side") == 0).select(
        *[F.col(f"`{c}`") for c in grid.columns],
        *[case_flag(F.col(m) <= last).alias(name(c)) for c, m in zip(components, marks)],
    )


def failure_flags_on_grid(
    grid: DataFrame, failures: DataFrame, components: list[str], key: str = "Turbine_ID", ts: str = "Timestamp",
    component_col: str = "Component", minutes: int = 10,
) -> DataFrame:
    """``Fail_<component>`` on the grid row a failure's time is rounded up to.

    Failures too many for a broadcast go to the grid as one list per key, so the grid, the large side, is joined by its key alone: rows made
    of an entity table stay where they are. Lists of more than MAX_LISTED failures are too long for that; then the grid is shuffled.
    """
    marks = failures.select(key, ceil_time(ts, minutes).alias(ts), F.col(component_col).alias("_component"))
    kind, small = grid.schema[ts].dataType, is_small(marks)
    if not small and isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        dated = marks.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
        most = dated.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= MAX_LISTED:
            lists = dated.groupBy(key).agg(F.collect_list(F.struct(F.col(ts).cast(kind).alias("at"), "_component")).alias("_marks"))
            listed = grid.join(lists.hint("shuffle_hash"), key, "left")
            at = F.col(ts)
            own = F.when(F.array_contains("_marks.at", at), F.filter("_marks", lambda m: m["at"] == at))
            joined = listed.select(*grid.columns, F.explode_outer(own).alias("_mark")).withColumn("_component", F.col("_mark._component"))
            return _failed(joined, grid.columns, components)
    return _failed(grid.join(F.broadcast(marks) if small else marks, [key, ts], "left"), grid.columns, components)


def _failed(joined: DataFrame, columns: list[str], components: list[str]) -> DataFrame:
    return joined.select(*columns, *[case_flag(F.col("_component") == F.lit(c)).alias(f"Fail_{c}") for c in components])


def one_hot(df: DataFrame, col: str, values: list, keep: list | None = None, only_listed: bool = False) -> DataFrame:
    """0/1 columns ``<col>_<value>`` in place of the column; ``only_listed`` drops rows with another value."""
    if only_listed:
        df = df.filter(F.col(col).isin(list(values)))
    wanted = values if keep is None else keep
    return df.select(
        *[F.col(f"`{c}`") for c in df.columns if c != col],
        *[case_flag(F.col(col) == F.lit(v)).alias(f"{col}_{v}") for v in wanted],
    )


def one_hot_remarks(logs: DataFrame, keys: list[str] | None = None, remark: str = "Remark") -> DataFrame:
    """Keys and one 0/1 column per listed remark; rows with other remarks are left out, doubles stay."""
    keys = keys or ["Timestamp", "Turbine_ID"]
    return one_hot(logs.select(*keys, remark), remark, REMARKS, only_listed=True)
