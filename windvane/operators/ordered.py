"""Ordered scans over groups of any size.

A plain window puts a whole group into one task, which fails when one turbine (or the keyless
case, the whole table) holds a large share of the rows. Every scan here first measures the
largest group. When it fits a task the plan is one ordinary window. When it does not, each
group is cut along its order into blocks of bounded size: a block is scanned locally, one
small summary row per block carries the state over the block border, and rolling frames get
the few neighbour rows they need as copies. Blocks are a function of the row itself, so the
large side is shuffled once, on (keys, block), and a lost executor recomputes the same blocks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windvane import session as S

BLOCK = "_block"
_CUTTABLE = (T.NumericType, T.TimestampType, T.TimestampNTZType, T.DateType)


@dataclass(frozen=True)
class Layout:
    """How the groups of one frame are cut: ``width`` None means every group fits one task."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    width: float | None = None
    low: float | None = None  # smallest and largest number of the first order column, when measured
    high: float | None = None
    null_keys: bool = False  # some group has a missing key

    @property
    def whole(self) -> bool:
        return self.width is None

    def per_period(self, order: str, micros: int, task_rows: int | None = None) -> Layout | None:
        """Layout after the rows were reduced to one per (keys, period) by their time.

        A group then has at most as many rows as the measured time span has periods. None when that
        does not settle it.
        """
        if self.low is None or self.order[0] == "_place":
            return None
        periods = (self.high - self.low) / micros + 2
        return Layout(self.keys, (order,)) if periods <= (S.MAX_GROUP_ROWS if task_rows is None else task_rows) else None

    @property
    def group(self) -> tuple[str, ...]:
        """What one task scans: a whole group (its partitioning then also serves later
        aggregates and windows on the keys), or one block of it."""
        return self.keys if self.whole else (*self.keys, BLOCK)


def _number(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    col = F.col(f"`{name}`")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(col.cast("timestamp")).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double")
    return col.cast("double")


def _block_of(df: DataFrame, layout: Layout) -> Column:
    number = _number(df, layout.order[0])
    # rows without an order value sort first and rows with NaN last, in blocks of their own
    block = F.floor(F.when(~F.isnan(number), number) / F.lit(layout.width)).cast("long")
    return F.when(F.isnan(number), F.lit(2**62).cast("long")).otherwise(F.coalesce(block, F.lit(-(2**62)).cast("long")))


def measure(
    df: DataFrame, keys: list[str] | tuple[str, ...], order: list[str] | tuple[str, ...], task_rows: int | None = None
) -> Layout | None:
    """Measure the groups and choose block borders; None when no borders on the first order column bound the blocks.

    ``task_rows`` is the number of rows of one group that one task may hold; larger groups are cut.
    Only the key and order columns are read, and the counts are combined before their shuffle.
    """
    keys, order = tuple(keys), tuple(order)
    limit = S.group_rows(df, task_rows)
    cuttable = isinstance(df.schema[order[0]].dataType, _CUTTABLE)
    number = _number(df, order[0]) if cuttable else F.lit(0.0)
    number = F.when(F.isnan(number), None).otherwise(number)
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(number).alias("lo"), F.max(number).alias("hi")
    )
    row = per_key.agg(
        F.max(F.struct("n", "lo", "hi")).alias("top"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.max(reduce(Column.__or__, [F.col(f"`{k}`").isNull() for k in keys], F.lit(False))).alias("nulls"),
    ).first()
    top, ends = row["top"], (*((row["lo"], row["hi"]) if cuttable else (None, None)), bool(row["nulls"]))
    if top is None or top["n"] <= limit:
        return Layout(keys, order, None, *ends)
    if not cuttable or top["lo"] is None or top["hi"] <= top["lo"]:
        return None
    width = (top["hi"] - top["lo"]) / -(-top["n"] // limit)
    for _ in range(4):
        layout = Layout(keys, order, width, *ends)
        blocks = df.groupBy(*keys, _block_of(df, layout).alias(BLOCK)).agg(F.count(F.lit(1)).alias("n"))
        largest = blocks.agg(F.max("n").alias("n")).first()["n"]
        if largest <= 2 * limit:
            return layout
        width /= 2 * -(-largest // limit)
    return None


def lay_out(
    df: DataFrame, keys: list[str] | tuple[str, ...], order: list[str] | tuple[str, ...], task_rows: int | None = None
) -> tuple[DataFrame, Layout]:
    """The frame to scan and its layout.

    Callers that run several scans over one table measure it once and pass the layout on. Where
    rows bunch up at single order values, or the order starts with text, all rows are numbered
    first and cut by position.
    """
    layout = measure(df, keys, order, task_rows)
    if layout is not None:
        return df, layout
    limit = S.group_rows(df, task_rows)
    placed = _place_by_range(df, [*keys, *order], "_place")
    return placed, Layout(tuple(keys), ("_place",), float(limit), null_keys=bool(keys))


def _place_by_range(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Global row position by range partitioning: a sort, a checkpoint and one offset per partition.

    A partition is sorted outside memory and numbered row by row, so its size does not follow a caller's ``task_rows``: every
    partition sends a sample of its rows and its counts to the driver.
    """
    rows = df.count()
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // S.group_rows(df)))
    ties = [F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.rand(0)]
    cols = [F.col(f"`{c}`") for c in order]
    ranged = (
        df.withColumns({"_tie": ties[0], "_tie2": ties[1]})
        .repartitionByRange(parts, *cols, "_tie", "_tie2")
        .sortWithinPartitions(*cols, "_tie", "_tie2")
        .withColumn("_id", F.monotonically_increasing_id())
        .drop("_tie", "_tie2")
    )
    # the sampled range borders differ from run to run, so the numbered rows are stored once
    stored = S.cut_lineage(ranged).withColumn("_part", F.shiftright("_id", 33))
    counts = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range partition: bounded by the partition count, so the hint is safe
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        stored.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + inside)
        .drop("_part", "_offset", "_id")
    )


def place_rows(df: DataFrame, order: list[str], name: str = "pos", task_rows: int | None = None) -> DataFrame:
    """0-based position of every row in a global order (W9 without keys)."""
    limit = S.group_rows(df, task_rows)
    if df.count() <= limit:
        return df.withColumn(name, (F.row_number().over(Window.orderBy(*order)) - 1).cast("long"))
    return _place_by_range(df, order, name)


def _prepare(df, keys, order, layout, task_rows):
    if layout is None:
        df, layout = lay_out(df, keys, order, task_rows)
    return df, layout


def _join_carry(local: DataFrame, carry: DataFrame, layout: Layout) -> DataFrame:
    """Attach per-block state.

    The large side is already partitioned by (keys, block), and plain equality keeps it where it is.
    Only when a key is missing somewhere does the comparison have to be null-safe.
    """
    same = Column.eqNullSafe if layout.null_keys else Column.__eq__
    on = [same(F.col(f"l.{k}"), F.col(f"c.{k}")) for k in layout.keys] + [F.col(f"l.{BLOCK}") == F.col(f"c.{BLOCK}")]
    joined = local.alias("l").join(carry.alias("c"), reduce(Column.__and__, on), "left")
    carried = [c for c in carry.columns if c not in layout.keys and c != BLOCK]
    return joined.select("l.*", *[F.col(f"c.{c}") for c in carried])


def _end(value: Column, order: tuple[str, ...], direction: str) -> Column:
    """First (or last) present value of a block. One order column of plain type aggregates in a hash table."""
    if len(order) == 1:
        at = F.when(value.isNotNull(), F.col(f"`{order[0]}`"))
        return F.min_by(value, at) if direction == "next" else F.max_by(value, at)
    place = F.struct(*[F.col(f"`{c}`") for c in order])
    pick = F.min if direction == "next" else F.max
    return pick(F.when(value.isNotNull(), F.struct(place.alias("p"), value.alias("v")))).getField("v")


def known(
    df: DataFrame,
    values: dict[str, Column],
    keys: list[str] | tuple[str, ...],
    order: list[str] | tuple[str, ...],
    direction: str = "next",
    layout: Layout | None = None,
    task_rows: int | None = None,
) -> DataFrame:
    """For each row the nearest non-null value at or after it (``next``), or at or before it (``previous``)."""
    before_columns = df.columns
    df, layout = _prepare(df, keys, order, layout, task_rows)
    raw = {f"_raw{i}": value for i, value in enumerate(values.values())}
    df = df.withColumns({**raw} if layout.whole else {**raw, BLOCK: _block_of(df, layout)})
    # a descending order with a growing frame is linear; a frame ending at "unbounded following"
    # would be recomputed for every row
    turn = F.desc if direction == "next" else F.asc
    within = (
        Window.partitionBy(*layout.group)
        .orderBy(*[turn(c) for c in layout.order])
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    local = df.withColumns(
        {name: F.last(r, ignorenulls=True).over(within) for name, r in zip(values, raw)}
    )
    if not layout.whole:
        ends = df.groupBy(*layout.keys, BLOCK).agg(*[_end(F.col(r), layout.order, direction).alias(r) for r in raw])
        earlier = (
            Window.partitionBy(*layout.keys).orderBy(turn(BLOCK)).rowsBetween(Window.unboundedPreceding, -1)
        )
        carry = ends.select(
            *layout.keys, BLOCK, *[F.last(r, ignorenulls=True).over(earlier).alias(f"_carry{r}") for r in raw]
        )
        local = _join_carry(local, carry, layout).withColumns(
            {name: F.coalesce(F.col(name), F.col(f"_carry{r}")) for name, r in zip(values, raw)}
        )
    out = [c for c in before_columns if c not in values]
    return local.select(*[F.col(f"`{c}`") for c in out], *[F.col(f"`{c}`") for c in values])


def running_sum(
    df: DataFrame,
    values: dict[str, Column],
    keys: list[str] | tuple[str, ...],
    order: list[str] | tuple[str, ...],
    layout: Layout | None = None,
    task_rows: int | None = None,
) -> DataFrame:
    """Sum of all rows up to and including the current one."""
    before_columns = df.columns
    df, layout = _prepare(df, keys, order, layout, task_rows)
    raw = {f"_raw{i}": value for i, value in enumerate(values.values())}
    df = df.withColumns({**raw} if layout.whole else {**raw, BLOCK: _block_of(df, layout)})
    within = Window.partitionBy(*layout.group).orderBy(*layout.order).rowsBetween(Window.unboundedPreceding, 0)
    local = df.withColumns({name: F.sum(r).over(within) for name, r in zip(values, raw)})
    if not layout.whole:
        totals = df.groupBy(*layout.keys, BLOCK).agg(*[F.sum(r).alias(r) for r in raw])
        earlier = Window.partitionBy(*layout.keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
        carry = totals.select(*layout.keys, BLOCK, *[F.sum(r).over(earlier).alias(f"_carry{r}") for r in raw])
        local = _join_carry(local, carry, layout).withColumns(
            {
                # a block whose values are all null adds nothing, but keeps an earlier sum alive
                name: F.when(
                    F.col(name).isNotNull() | F.col(f"_carry{r}").isNotNull(),
                    F.coalesce(F.col(name), F.lit(0)) + F.coalesce(F.col(f"_carry{r}"), F.lit(0)),
                )
                for name, r in zip(values, raw)
            }
        )
    out = [c for c in before_columns if c not in values]
    return local.select(*[F.col(f"`{c}`") for c in out], *[F.col(f"`{c}`") for c in values])


def rolling(
    df: DataFrame,
    values: dict[str, Callable[[WindowSpec], Column]],
    keys: list[str] | tuple[str, ...],
    order: list[str] | tuple[str, ...],
    before: int = 0,
    after: int = 0,
    layout: Layout | None = None,
    task_rows: int | None = None,
) -> DataFrame:
    """Row frame of ``before`` rows back to ``after`` rows ahead; each value gets the frame as a window."""
    before_columns = df.columns
    limit = S.group_rows(df, task_rows)
    df, layout = _prepare(df, keys, order, layout, task_rows)
    names = [c for c in before_columns if c not in values]
    if layout.whole:
        frame = Window.partitionBy(*layout.keys).orderBy(*layout.order).rowsBetween(-before, after)
        out = df.withColumns({name: make(frame) for name, make in values.items()})
        return out.select(*[F.col(f"`{c}`") for c in names], *[F.col(f"`{c}`") for c in values])
    size = max(limit, before + after + 1)
    place = running_sum(df, {"_row": F.lit(1).cast("long")}, keys, order, layout)
    row = F.col("_row") - 1
    home = F.floor(row / size).cast("long")
    inside = F.pmod(row, F.lit(size))
    copies = F.array_compact(
        F.array(
            home,
            F.when(inside >= size - before, home + 1),
            F.when(inside < after, home - 1),
        )
    )
    spread = place.withColumns({"_home": home, BLOCK: F.explode(copies)})
    frame = Window.partitionBy(*layout.keys, BLOCK).orderBy("_row").rowsBetween(-before, after)
    out = spread.withColumns({name: make(frame) for name, make in values.items()}).filter(F.col("_home") == F.col(BLOCK))
    return out.select(*[F.col(f"`{c}`") for c in names], *[F.col(f"`{c}`") for c in values])


def row_in_group(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    name: str = "pos",
    layout: Layout | None = None,
    task_rows: int | None = None,
) -> DataFrame:
    """0-based position inside each group."""
    out = running_sum(df, {name: F.lit(1).cast("long")}, keys, order, layout, task_rows)
    return out.withColumn(name, F.col(name) - 1)


def running_counts(
    df: DataFrame, values: dict[str, Column], keys: list[str], by: str, task_rows: int | None = None
) -> DataFrame:
    """One row per (keys, value of ``by``): its totals and the totals up to and including it.

    Rows are pre-aggregated before the scan, so equal values never meet in one task.
    """
    grouped = df.groupBy(*keys, by).agg(*[F.sum(v).alias(name) for name, v in values.items()])
    # blocks that hold few rows hold few distinct values, so the ungrouped rows are measured first
    layout = measure(df, keys, [by], task_rows)
    return running_sum(grouped, {f"cum_{name}": F.col(name) for name in values}, keys, [by], layout, task_rows)


def quantiles(
    df: DataFrame, col: str, points: list[float], keys: list[str] | None = None, task_rows: int | None = None
) -> DataFrame:
    """Exact interpolated quantiles as one array per group, without gathering a group.

    Distinct values are counted, their running counts locate the two ranks around each
    quantile, and only those values are kept.
    """
    keys = list(keys or [])
    present = df.filter(F.col(f"`{col}`").isNotNull() & ~F.isnan(F.col(f"`{col}`").cast("double")))
    counted = running_counts(
        present.select(*keys, F.col(f"`{col}`").cast("double").alias("_v")), {"n": F.lit(1).cast("long")}, keys, "_v",
        task_rows,
    )
    if keys:
        totals = present.groupBy(*keys).agg(F.count(F.lit(1)).alias("_total"))
        ranked = counted.join(S.few_rows(totals), keys)
    else:
        ranked = counted.withColumn("_total", F.lit(present.count()))
    aggregates = []
    for i, p in enumerate(points):
        place = F.lit(float(p)) * (F.col("_total") - 1)
        low, high = F.floor(place), F.ceil(place)
        for tag, rank in (("lo", low), ("hi", high)):
            holds = (rank < F.col("cum_n")) & (rank >= F.col("cum_n") - F.col("n"))
            aggregates.append(F.max(F.when(holds, F.col("_v"))).alias(f"_{tag}{i}"))
        aggregates.append(F.max(place - low).alias(f"_part{i}"))
    found = ranked.groupBy(*keys).agg(*aggregates)
    array = F.array(
        *[
            F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_part{i}")
            for i in range(len(points))
        ]
    )
    return found.select(*keys, array.alias("quantiles"))
