"""Rolling, lagged and cumulative columns, and fixed-length sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from windvane.functions.time import from_micros, micros
from windvane.operators import ordered
from windvane.operators.ordered import Layout


def rolling_mean(df: DataFrame, cols: list[str], partition: list[str], order: list[str], window: int = 15, **kw) -> DataFrame:
    """Trailing mean over the last ``window`` rows of each group, suffix ``_av``."""
    values = {f"{c}_av": (lambda w, c=c: F.avg(F.col(f"`{c}`")).over(w)) for c in cols}
    return ordered.rolling(df, values, partition, order, before=window - 1, **kw)


def rolling_std(df: DataFrame, cols: list[str], partition: list[str], order: list[str], window: int = 15, **kw) -> DataFrame:
    """Trailing sample deviation, 0 where it is undefined (a single row), suffix ``_sd``."""
    values = {
        f"{c}_sd": (lambda w, c=c: F.coalesce(F.stddev_samp(F.col(f"`{c}`")).over(w), F.lit(0.0))) for c in cols
    }
    return ordered.rolling(df, values, partition, order, before=window - 1, **kw)


def add_rolling_features(
    df: DataFrame,
    sensors: list[str],
    partition: list[str],
    order: list[str],
    window: int = 15,
    layout: Layout | None = None,
    task_rows: int | None = None,
) -> DataFrame:
    """Trailing mean and deviation of every sensor. All of them share one frame, hence one shuffle and one sort.

    Key, label and flag columns (everything not listed as a sensor) move to the front; then come
    sensors, means and deviations.
    """
    front = [c for c in df.columns if c not in sensors]
    moved = df.select(*[F.col(f"`{c}`") for c in [*front, *sensors]])
    values = {f"{c}_av": (lambda w, c=c: F.avg(F.col(f"`{c}`")).over(w)) for c in sensors}
    values |= {
        f"{c}_sd": (lambda w, c=c: F.coalesce(F.stddev_samp(F.col(f"`{c}`")).over(w), F.lit(0.0))) for c in sensors
    }
    return ordered.rolling(moved, values, partition, order, before=window - 1, layout=layout, task_rows=task_rows)


def rolling_sum(
    df: DataFrame, col: str, order: list[str], window: int, partition: list[str] | None = None, name: str | None = None,
    task_rows: int | None = None,
) -> DataFrame:
    """Trailing sum over ``window`` rows; without partition the frame runs over the whole ordered table."""
    name = name or f"{col}_sum"
    return ordered.rolling(
        df, {name: lambda w: F.sum(F.col(f"`{col}`")).over(w)}, partition or [], order, before=window - 1, task_rows=task_rows
    )


def time_delta(df: DataFrame, ts: str, partition: list[str] | None = None, name: str = "delta_seconds", task_rows: int | None = None) -> DataFrame:
    """Seconds since the previous row of the group; 0 on the first."""
    previous = lambda w: F.max(micros(ts)).over(w.rowsBetween(-1, -1))
    lagged = ordered.rolling(df, {"_previous": previous}, partition or [], [ts], before=1, task_rows=task_rows)
    gap = F.coalesce((micros(ts) - F.col("_previous")) / F.lit(1e6), F.lit(0.0))
    return lagged.withColumn(name, gap).drop("_previous")


def max_gap(df: DataFrame, ts: str, partition: list[str] | None = None, task_rows: int | None = None) -> DataFrame:
    """Largest time step, overall or per group."""
    return time_delta(df, ts, partition, "_gap", task_rows).groupBy(*(partition or [])).agg(F.max("_gap").alias("max_gap_seconds"))


def cumulative_sum(df: DataFrame, col: str, order: list[str], partition: list[str] | None = None, name: str | None = None, task_rows: int | None = None) -> DataFrame:
    return ordered.running_sum(df, {name or f"{col}_cum": F.col(f"`{col}`")}, partition or [], order, task_rows=task_rows)


def row_position(df: DataFrame, order: list[str], partition: list[str] | None = None, name: str = "pos", task_rows: int | None = None) -> DataFrame:
    """0-based row position in the stated order."""
    if partition:
        return ordered.row_in_group(df, partition, order, name, task_rows=task_rows)
    return ordered.place_rows(df, order, name, task_rows)


def sliding_sequences(
    df: DataFrame,
    features: list[str],
    target: str,
    partition: str,
    order: list[str],
    length: int,
    n: int | None = None,
    seed: int = 0,
    task_rows: int | None = None,
) -> DataFrame:
    """Windows of ``length`` consecutive rows per turbine: ``X`` holds their features, ``y`` the last row's target.

    The last possible start of a turbine is left out, as a start drawn below ``rows - length``
    leaves it out. With ``n`` that many starts per turbine are drawn: those with the smallest MD5 of ``seed|turbine|start``;
    otherwise every start is returned.
    """
    df, layout = ordered.lay_out(df, [partition], order, task_rows)  # measured once for both scans
    placed = ordered.row_in_group(df, [partition], order, "start", layout, task_rows)
    vector = F.array(*[F.col(f"`{c}`").cast("double") for c in features])
    rows = ordered.rolling(
        placed,
        {
            "X": lambda w: F.collect_list(vector).over(w.rowsBetween(-(length - 1), 0)),
            "_followed": lambda w: F.count(F.lit(1)).over(w.rowsBetween(1, 1)),
        },
        [partition],
        order,
        before=length - 1,
        after=1,
        layout=layout,
        task_rows=task_rows,
    )
    full = rows.filter((F.col("start") >= length - 1) & (F.col("_followed") == 1))
    out = full.select(partition, (F.col("start") - (length - 1)).alias("start"), "X", F.col(f"`{target}`").alias("y"))
    if n is None:
        return out
    # two-step top n: first inside hashed slices of a turbine, then over the few winners
    text = F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(partition).cast("string"), F.lit("")), F.col("start").cast("string"))
    drawn = out.withColumn("_draw", F.md5(text.cast("binary")))
    sliced = drawn.withColumn("_slice", F.pmod(F.xxhash64("start"), F.lit(64)))
    first = Window.partitionBy(partition, "_slice").orderBy("_draw", "start")
    second = Window.partitionBy(partition).orderBy("_draw", "start")
    winners = sliced.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= n)
    return winners.withColumn("_r", F.row_number().over(second)).filter(F.col("_r") <= n).drop("_draw", "_slice", "_r")
