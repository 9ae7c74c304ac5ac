"""Classification quality and the maintenance cost of predictions.

``keys`` name the run a row belongs to (component, model, ...); every function evaluates all runs
of a table in one job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windvane.functions.scalar import case_flag
from windvane.operators import ordered
from windvane.session import few_rows

# Costs in EUR per component (replacement, repair, inspection).
COSTS = {
    "gearbox": (100000, 20000, 5000),
    "generator": (60000, 15000, 5000),
    "gen_bear": (30000, 12500, 4500),
    "transformer": (50000, 3500, 1500),
    "hydraulic": (20000, 3000, 2000),
}


def confusion_flags(df: DataFrame, y: str, pred: str) -> DataFrame:
    """TP, TN, FP and FN as 0/1 columns."""
    a, p = F.col(y), F.col(pred)
    return df.withColumns(
        {
            "TP": case_flag((a == 1) & (p == 1)),
            "TN": case_flag((a == 0) & (p == 0)),
            "FP": case_flag((a == 0) & (p == 1)),
            "FN": case_flag((a == 1) & (p == 0)),
        }
    )


def _score_counts(df: DataFrame, y: str, score: str, keys: list[str], task_rows: int | None) -> DataFrame:
    """Per distinct score: positives and negatives, running from the highest score down."""
    signed = df.select(*keys, (-F.col(score).cast("double")).alias("_down"), F.col(y).alias("_y"))
    counts = {"pos": case_flag(F.col("_y") == 1).cast("long"), "neg": case_flag(F.col("_y") == 0).cast("long")}
    return ordered.running_counts(signed, counts, keys, "_down", task_rows)


def _with_totals(counted: DataFrame, df: DataFrame, y: str, keys: list[str]) -> DataFrame:
    """Class totals of each run, counted on the rows themselves; one small row per run."""
    totals = df.groupBy(*keys).agg(F.count_if(F.col(y) == 1).alias("P"), F.count_if(F.col(y) == 0).alias("N"))
    if keys:
        return counted.join(few_rows(totals), keys)
    row = totals.first()
    return counted.withColumns({"P": F.lit(row["P"]), "N": F.lit(row["N"])})


def auc(df: DataFrame, y: str, score: str, keys: list[str] | tuple[str, ...] = (), task_rows: int | None = None) -> DataFrame:
    """Area under the ROC curve per run as the rank statistic (ties count half); null for a single class."""
    keys = list(keys)
    counted = _score_counts(df, y, score, keys, task_rows)
    wins = F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2))
    summed = counted.groupBy(*keys).agg(wins.alias("w"), F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return summed.select(*keys, F.try_divide(F.col("w"), (F.col("P") * F.col("N")).cast("double")).alias("auc"))


def classification_metrics(
    df: DataFrame, y: str, pred: str, score: str, keys: list[str] | tuple[str, ...] = (), task_rows: int | None = None
) -> DataFrame:
    """AUC, accuracy, recall, specificity, precision and F1 per run; all null when the run has one class only."""
    keys = list(keys)
    counts = confusion_flags(df, y, pred).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("TP", "TN", "FP", "FN")])
    tp, tn, fp, fn = (F.col(c).cast("double") for c in ("TP", "TN", "FP", "FN"))
    both = (tp + fn > 0) & (tn + fp > 0)
    guard = lambda c: F.when(both, c)
    rated = counts.select(
        *keys,
        guard(F.try_divide(tp + tn, tp + tn + fp + fn)).alias("accuracy"),
        guard(F.try_divide(tp, tp + fn)).alias("recall"),
        guard(F.try_divide(tn, tn + fp)).alias("specificity"),
        guard(F.try_divide(tp, tp + fp)).alias("precision"),
        guard(F.try_divide(2 * tp, 2 * tp + fp + fn)).alias("f1"),
        *[F.col(c) for c in ("TP", "TN", "FP", "FN")],
    )
    area = auc(df, y, score, keys, task_rows)
    if keys:
        return rated.join(area, keys)
    return rated.withColumn("auc", F.lit(area.first()["auc"]).cast("double"))


def roc_curve(
    df: DataFrame, y: str, score: str, keys: list[str] | tuple[str, ...] = (), drop_collinear: bool = False,
    task_rows: int | None = None,
) -> DataFrame:
    """One row per distinct score, highest first: threshold, TPR, FPR, share of rows at or above it, counts.

    ``drop_collinear`` keeps only the corners of the curve (first, last, and points where the
    direction changes). The point (0, 0) above the highest score is implied and not listed.
    """
    keys = list(keys)
    counted = _with_totals(_score_counts(df, y, score, keys, task_rows), df, y, keys)
    if drop_collinear:
        ahead = lambda c: (lambda w: F.max(c).over(w.rowsBetween(1, 1)))
        behind = lambda c: (lambda w: F.max(c).over(w.rowsBetween(-1, -1)))
        counted = ordered.rolling(
            counted, {"_np": ahead("pos"), "_nn": ahead("neg"), "_bp": behind("pos")}, keys, ["_down"], 1, 1, task_rows=task_rows
        )
        corner = F.col("_np").isNull() | F.col("_bp").isNull() | (F.col("pos") * F.col("_nn") != F.col("neg") * F.col("_np"))
        counted = counted.filter(corner)
    rows = (F.col("P") + F.col("N")).cast("double")
    return counted.select(
        *keys,
        (-F.col("_down")).alias("threshold"),
        F.try_divide(F.col("cum_pos").cast("double"), F.col("P").cast("double")).alias("tpr"),
        F.try_divide(F.col("cum_neg").cast("double"), F.col("N").cast("double")).alias("fpr"),
        ((F.col("cum_pos") + F.col("cum_neg")) / rows).alias("que"),
        F.col("cum_pos").alias("tp"),
        F.col("cum_neg").alias("fp"),
    )


def roc_scaled_counts(roc: DataFrame, base: tuple[int, int] | None = (25, 75), legacy: bool = False) -> DataFrame:
    """Counts per threshold for fixed class sizes (positives, negatives), cut to whole numbers.

    ``legacy`` gives the older table, whose FP column holds the missed positives and whose FN column
    holds the false alarms, with the two rates computed from those columns.
    """
    pos, neg = base
    caught = (F.lit(pos) * F.col("tpr")).cast("int")
    missed = (F.lit(pos) - F.lit(pos) * F.col("tpr")).cast("int")
    quiet = (F.lit(neg) * (F.lit(1) - F.col("fpr"))).cast("int")
    alarms = (F.lit(neg) - F.lit(neg) * (F.lit(1) - F.col("fpr"))).cast("int")
    counts = {"TP": caught, "FN": missed, "TN": quiet, "FP": alarms}
    if legacy:
        counts = {"TP": caught, "FP": missed, "TN": quiet, "FN": alarms}
    out = roc.drop("tp", "fp").withColumns(counts)
    ratio = lambda a, b: F.try_divide(F.col(a).cast("double"), (F.col(a) + F.col(b)).cast("double"))
    if legacy:
        return out.withColumns({"TNR": ratio("TN", "FN"), "FNR": ratio("TN", "FP")})
    return out.withColumns({"TNR": ratio("TN", "FP"), "FNR": ratio("FN", "TP")})


def pr_curve(df: DataFrame, y: str, score: str, keys: list[str] | tuple[str, ...] = (), task_rows: int | None = None) -> DataFrame:
    """One row per distinct score: threshold, precision, recall, share of rows at or above it.

    The closing point (precision 1, recall 0) is implied and not listed.
    """
    keys = list(keys)
    counted = _with_totals(_score_counts(df, y, score, keys, task_rows), df, y, keys)
    at_or_above = (F.col("cum_pos") + F.col("cum_neg")).cast("double")
    return counted.select(
        *keys,
        (-F.col("_down")).alias("threshold"),
        (F.col("cum_pos") / at_or_above).alias("precision"),
        F.try_divide(F.col("cum_pos").cast("double"), F.col("P").cast("double")).alias("recall"),
        (at_or_above / (F.col("P") + F.col("N"))).alias("que"),
    )


def classification_report(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Precision, recall, F1 and support per class."""
    hits = F.col(y) == F.col(pred)
    # counted per (actual, predicted) pair first, so the unpivot touches classes squared rows only
    pairs = df.groupBy(F.col(y).alias("a"), F.col(pred).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("class"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("given"),
                         F.when(F.col("a") == F.col("p"), F.col("n")).otherwise(F.lit(0)).alias("hit")),
                F.struct(F.col("p").alias("class"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("given"),
                         F.lit(0).cast("long").alias("hit")),
            )
        ).alias("s")
    ).select("s.*")
    per = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("actual", "given", "hit")])
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    as_double = lambda c: F.col(c).cast("double")
    return per.select(
        "class",
        zero(F.try_divide(as_double("hit"), as_double("given"))).alias("precision"),
        zero(F.try_divide(as_double("hit"), as_double("actual"))).alias("recall"),
        zero(F.try_divide(2 * as_double("hit"), as_double("given") + as_double("actual"))).alias("f1"),
        F.col("actual").alias("support"),
    )


def label_counts(df: DataFrame, label: str, keys: list[str] | tuple[str, ...] = ()) -> DataFrame:
    return df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("n"))


def cost_columns(component: str, costs: dict[str, tuple[float, float, float]] = COSTS) -> dict[str, Column]:
    """Replacement, repair and inspection cost of the row's component as lookups in a literal map."""
    out = {}
    for i, name in enumerate(("replacement", "repair", "inspection")):
        table = F.create_map(*[x for k, v in costs.items() for x in (F.lit(k), F.lit(float(v[i])))])
        out[name] = F.try_element_at(table, F.col(component))
    return out


def savings_rows(
    df: DataFrame, keys: list[str], order: list[str], days: int = 10, by_turbine: str | None = None,
    y: str = "y_test", pred: str = "y_pred", ttf: str = "TTF", layout: ordered.Layout | None = None, task_rows: int | None = None,
) -> DataFrame:
    """Evaluation table: TTF rounded up, the four flags, and ``new_FP``, the false alarms of the last ``days`` rows.

    The frame crosses turbine borders inside a run; ``by_turbine`` names the column that resets it.
    """
    flagged = confusion_flags(df, y, pred).withColumn(ttf, F.ceil(F.col(ttf)).cast("long"))
    reset = [*keys, by_turbine] if by_turbine else keys
    rest = [c for c in order if c not in reset]
    return ordered.rolling(
        flagged, {"new_FP": lambda w: F.sum("FP").over(w)}, reset, rest, before=days - 1, layout=layout, task_rows=task_rows
    )


def savings_metric(
    df: DataFrame,
    component: str,
    order: list[str],
    keys: list[str] | tuple[str, ...] = (),
    days: int = 10,
    horizon: int = 60,
    costs: dict[str, tuple[float, float, float]] = COSTS,
    by_turbine: str | None = None,
    y: str = "y_test",
    pred: str = "y_pred",
    ttf: str = "TTF",
    task_rows: int | None = None,
) -> DataFrame:
    """Money saved by the predictions, one row per component and further run keys.

    Rows are placed by ``order`` (turbine, date) inside a run. A failure row has TTF 1.
    TP is 1 when a true alarm comes no later than the last failure row; otherwise FN is 1 when a
    missed row does. FP counts false alarms with no other one in the ``days - 1`` rows before.
    Saved: replacement - (repair + (replacement - repair) * (1 - T / horizon)), where T belongs to the
    n-th true alarm and n is the number of failure rows. With fewer than n true alarms the last one
    is taken; without failure rows or true alarms nothing is saved.
    """
    runs = [component, *[k for k in keys if k != component]]
    rest = [c for c in order if c not in runs]
    base, layout = ordered.lay_out(df, runs, rest, task_rows)
    shared = None if by_turbine else layout
    rows = savings_rows(base, runs, list(layout.order) if shared else order, days, by_turbine, y, pred, ttf, shared, task_rows)
    tracked = ordered.running_sum(
        rows, {"_row": F.lit(1).cast("long"), "_alarm": F.col("TP").cast("long")}, runs, rest, layout, task_rows
    )
    alarm = F.col("TP") == 1
    # T of the n-th true alarm: n needs no order, so it is counted first and meets the rows as one small row per run
    counted = confusion_flags(df, y, pred).groupBy(*runs).agg(F.count_if(F.ceil(ttf) == 1).alias("_failures"), F.sum("TP").alias("_alarms"))
    wanted = few_rows(counted.select(*runs, F.least("_failures", "_alarms").alias("_wanted")))
    out = tracked.join(wanted, runs, "left").groupBy(*runs).agg(
        F.max(F.when(F.col(ttf) == 1, F.col("_row"))).alias("last_failure"),
        F.min(F.when(alarm, F.col("_row"))).alias("first_alarm"),
        F.min(F.when(F.col("FN") == 1, F.col("_row"))).alias("first_miss"),
        F.max(F.when(alarm & (F.col("_alarm") == F.col("_wanted")), F.col(ttf))).alias("T"),
        F.sum("TN").alias("TN"),
        F.count_if((F.col("FP") == 1) & (F.col("new_FP") == 1)).alias("FP"),
    )
    out = out.withColumns(cost_columns(component, costs))
    hit = case_flag(F.col("first_alarm") <= F.col("last_failure"))
    miss = case_flag((hit == 0) & (F.col("first_miss") <= F.col("last_failure")))
    spared = F.col("replacement") - (
        F.col("repair") + (F.col("replacement") - F.col("repair")) * (1 - F.col("T") / F.lit(float(horizon)))
    )
    out = out.withColumns({"TP": hit, "FN": miss, "tp_savings": F.coalesce(spared, F.lit(0.0))})
    total = F.col("tp_savings") - F.col("inspection") * F.col("FP") - F.col("replacement") * F.col("FN")
    return out.withColumn("savings", total).select(*runs, "TP", "TN", "FP", "FN", "tp_savings", "savings")


def select_best_model(metrics: DataFrame, component: str = "component", model: str = "model", value: str = "savings") -> DataFrame:
    """Per component the model with the highest savings (ties: the larger name)."""
    return metrics.groupBy(component).agg(
        F.max(F.struct(F.col(value), F.col(model))).alias("_best")
    ).select(component, F.col(f"_best.{model}").alias(model), F.col(f"_best.{value}").alias(value))
