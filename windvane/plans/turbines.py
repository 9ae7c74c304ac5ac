"""From signals and failures to trained, evaluated and scoring-ready models of all components.

Preparation handles every component in one pass: the failures become one flag per component, the
next failure of every component is looked up beside each row (or found by one ordered scan, when
failures are many), one aggregate makes the daily rows and one window the rolling features. With few
failures the raw signals are never shuffled: only their daily partial averages are. A failure row
without signals belongs to its own component only, so each component's averages equal those of a
separate run.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windvane.functions.scalar import case_flag
from windvane.functions.time import MICROS_PER_DAY, days_between, floor_hour
from windvane.operators import evaluation, models, ordered, scaling
from windvane.operators.aggregates import group_by_period
from windvane.operators.joins import join_outer_rare
from windvane.operators.nulls import backfill
from windvane.operators.splits import split_by_months
from windvane.operators.windows import add_rolling_features
from windvane.session import MAX_BROADCAST_BYTES, cut_lineage

# Failures per turbine that are looked up in a list beside each row; more are found by an ordered scan.
MAX_LISTED = 64

# Name parts of the columns each component uses, in order.
PARTS = {
    "generator": ["Gen", "Rtr", "Amb", "Blds", "Cont", "Nac", "Spin", "Busbar", "Hyd"],
    "hydraulic": ["Hyd", "Rtr", "Amb", "Blds", "Cont", "Nac", "Spin", "Busbar", "Volt"],
    "gen_bear": ["Gen", "Rtr", "Amb", "Blds", "Cont", "Nac", "Spin", "Busbar", "Hyd"],
    "transformer": ["Trafo", "Rtr", "Amb", "Blds", "Cont", "Nac", "Spin", "Busbar", "Volt"],
    "gearbox": ["Gear", "Rtr", "Amb", "Blds", "Cont", "Nac", "Spin", "Busbar", "Hyd"],
}

# The name of each component in the failure log.
LOG_COMPONENTS = {
    "generator": "GENERATOR",
    "hydraulic": "HYDRAULIC_GROUP",
    "gen_bear": "GENERATOR_BEARING",
    "transformer": "TRANSFORMER",
    "gearbox": "GEARBOX",
}

# Correlated columns left out per component.
DROPS = {
    "generator": [
        "Gen_RPM_Max", "Gen_RPM_Min", "Gen_Phase1_Temp_Avg", "Gen_Phase3_Temp_Avg", "Amb_WindSpeed_Est_Avg",
        "Grd_RtrInvPhase1_Temp_Avg", "Grd_RtrInvPhase3_Temp_Avg", "Rtr_RPM_Max", "Rtr_RPM_Min",
        "Blds_PitchAngle_Max", "Blds_PitchAngle_Min", "Prod_LatestAvg_ReactPwrGen1", "Cont_Hub_Temp_Avg",
        "Spin_Temp_Avg", "Rtr_RPM_Std", "Rtr_RPM_Avg", "Cont_VCP_Temp_Avg",
    ],
    "hydraulic": [
        "Rtr_RPM_Max", "Rtr_RPM_Min", "Blds_PitchAngle_Max", "Blds_PitchAngle_Min", "Grd_RtrInvPhase3_Temp_Avg",
        "Grd_Busbar_Temp_Avg", "Amb_WindSpeed_Est_Avg", "Spin_Temp_Avg", "Cont_Hub_Temp_Avg",
        "Grd_RtrInvPhase1_Temp_Avg", "Cont_VCP_Temp_Avg",
    ],
    "gen_bear": [
        "Gen_RPM_Max", "Gen_RPM_Min", "Gen_Phase1_Temp_Avg", "Gen_Phase3_Temp_Avg", "Amb_WindSpeed_Est_Avg",
        "Grd_RtrInvPhase1_Temp_Avg", "Grd_RtrInvPhase3_Temp_Avg", "Rtr_RPM_Max", "Rtr_RPM_Min",
        "Blds_PitchAngle_Max", "Blds_PitchAngle_Min", "Prod_LatestAvg_ReactPwrGen1", "Cont_Hub_Temp_Avg",
        "Spin_Temp_Avg", "Rtr_RPM_Std", "Rtr_RPM_Avg", "Cont_VCP_Temp_Avg",
    ],
    "transformer": [
        "HVTrafo_Phase1_Temp_Avg", "HVTrafo_Phase3_Temp_Avg", "Rtr_RPM_Max", "Rtr_RPM_Min",
        "Grd_RtrInvPhase1_Temp_Avg", "Grd_RtrInvPhase3_Temp_Avg", "Blds_PitchAngle_Min", "Blds_PitchAngle_Max",
        "Amb_WindSpeed_Est_Avg", "Spin_Temp_Avg", "Cont_VCP_Temp_Avg",
    ],
    "gearbox": [
        "Rtr_RPM_Max", "Rtr_RPM_Min", "Grd_RtrInvPhase1_Temp_Avg", "Grd_RtrInvPhase3_Temp_Avg",
        "Blds_PitchAngle_Min", "Blds_PitchAngle_Max", "Cont_VCP_Temp_Avg", "Grd_Busbar_Temp_Avg",
        "Amb_WindSpeed_Est_Avg", "Spin_Temp_Avg",
    ],
}

# Turbines whose rows train a component's model.
TRAINING_TURBINES = {
    "generator": ["T11", "T06"],
    "hydraulic": ["T06", "T11"],
    "gen_bear": ["T07", "T09"],
    "transformer": ["T07"],
    "gearbox": ["T09"],
}


@dataclass(frozen=True)
class Setup:
    """Everything a run depends on; the defaults are the published run."""

    components: dict[str, str] = field(default_factory=lambda: dict(LOG_COMPONENTS))
    sensors: dict[str, list[str]] | None = None  # chosen by PARTS and DROPS when not given
    training_turbines: dict[str, list] | None = field(default_factory=lambda: dict(TRAINING_TURBINES))
    key: str = "Turbine_ID"
    ts: str = "Timestamp"
    component_col: str = "Component"
    turbines: list | None = None
    period: str = "day"
    horizon: int = 60
    horizons: tuple[int, ...] = ()  # further horizons; each adds a column ``label_<days>``
    lower: float = 2
    window: int = 10
    months: int = 3
    test_days: int | None = None
    label_cast: str = "trunc"
    alarm_days: int = 20
    costs: dict = field(default_factory=lambda: dict(evaluation.COSTS))
    models: dict | None = None
    threads: int = 3
    task_rows: int | None = None

    def sensors_of(self, component: str, columns: list[str]) -> list[str]:
        """A component's sensors in alphabetical order, which is the order of its feature vector."""
        if self.sensors is not None:
            return self.sensors[component]
        chosen = [c for part in PARTS[component] for c in columns if part in c]
        return sorted(set(chosen) - set(DROPS[component]) - {self.key, self.ts})

    def features_of(self, component: str, columns: list[str]) -> list[str]:
        sensors = self.sensors_of(component, columns)
        return [*sensors, *[f"{c}_av" for c in sensors], *[f"{c}_sd" for c in sensors]]


def measured(signals: DataFrame, failures: DataFrame, setup: Setup) -> ordered.Layout | None:
    """Size of the turbines' histories, taken once from keys and times and used by every later scan."""
    both = signals.select(setup.key, setup.ts).unionByName(failures.select(setup.key, setup.ts))
    return ordered.measure(both, [setup.key], [setup.ts], setup.task_rows)


def daily_layout(layout: ordered.Layout | None, setup: Setup) -> ordered.Layout | None:
    """Layout of the daily (or hourly) rows."""
    step = MICROS_PER_DAY if setup.period == "day" else MICROS_PER_DAY // 24
    return layout.per_period("Date", step, setup.task_rows) if layout else None


def _few_failures(failures: DataFrame, setup: Setup) -> bool:
    """Whether each turbine's failures fit a short list and all lists together a broadcast."""
    name = F.max(F.octet_length(F.col(setup.key).cast("string")))
    per = failures.groupBy(setup.key).agg(F.count(F.lit(1)).alias("n"))
    row = per.agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("turbines"), F.sum("n").alias("all"), name.alias("name")).first()
    # a list entry takes 8 bytes; a turbine's row its name, and less than 48 for each component's list
    rows = row["turbines"] * (48 * (len(setup.components) + 1) + (row["name"] or 0))
    return (row["most"] or 0) <= MAX_LISTED and rows + 8 * (row["all"] or 0) <= MAX_BROADCAST_BYTES


def daily_labelled(
    signals: DataFrame, failures: DataFrame, setup: Setup, layout: ordered.Layout | None = None
) -> DataFrame:
    """One row per turbine and day: per component the averaged sensors, TTF, label and failure flag.

    Columns are named ``<component>__<column>``. A (turbine, day) on which a component has no row
    of its own has nulls there; ``component_table`` drops them. Rows without a turbine or a time belong to no
    history and are left out.
    """
    key, ts = setup.key, setup.ts
    signals, failures = (t.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()) for t in (signals, failures))
    if setup.turbines is not None:
        signals = signals.filter(F.col(key).isin(list(setup.turbines)))
        failures = failures.filter(F.col(key).isin(list(setup.turbines)))
    names = list(setup.components)
    columns = [c for c in signals.columns if c not in (key, ts)]
    needed = sorted({c for n in names for c in setup.sensors_of(n, columns)})
    of_component = {n: F.col(setup.component_col) == F.lit(setup.components[n]) for n in names}
    flags = failures.groupBy(key, ts).agg(*[F.max(case_flag(of_component[n])).alias(f"_fail_{n}") for n in names])
    left = signals.select(key, ts, *[F.col(f"`{c}`") for c in needed]).withColumn("_signal", F.lit(1))
    joined = join_outer_rare(left, flags, [key, ts]).na.fill(0, subset=["_signal", *[f"_fail_{n}" for n in names], *needed])
    if _few_failures(failures, setup):
        # every turbine's short failure list goes to the rows: the raw signals are not shuffled at all
        lists = failures.groupBy(key).agg(
            *[F.array_sort(F.collect_set(F.when(of_component[n], F.col(ts)))).alias(f"_all_{n}") for n in names]
        )
        listed = joined.join(F.broadcast(lists), key, "left")
        ahead = lambda n: F.get(F.filter(F.col(f"_all_{n}"), lambda at: at >= F.col(ts)), F.lit(0))
        dated = listed.withColumns({f"_next_{n}": ahead(n) for n in names})
    else:
        values = {f"_next_{n}": F.when(F.col(f"_fail_{n}") == 1, F.col(ts)) for n in names}
        dated = ordered.known(joined, values, [key], [ts], "next", layout, setup.task_rows)
    at = F.to_date(ts) if setup.period == "day" else floor_hour(ts)
    parts = []
    for n in names:
        own = (F.col("_signal") == 1) | (F.col(f"_fail_{n}") == 1)
        mean = lambda c, own=own: F.avg(F.when(own, c))
        ttf = F.bround(days_between(F.col(ts), F.coalesce(f"_next_{n}", F.col(ts)), None), 0)
        parts += [
            mean(ttf).alias(f"{n}__TTF"),
            mean(case_flag(ttf.between(setup.lower, setup.horizon)).cast("double")).alias(f"{n}__label"),
            *[mean(case_flag(ttf.between(setup.lower, h)).cast("double")).alias(f"{n}__label_{h}") for h in setup.horizons],
            mean(F.col(f"_fail_{n}").cast("double")).alias(f"{n}__failure"),
            *[mean(F.col(f"`{c}`").cast("double")).alias(f"{n}__{c}") for c in setup.sensors_of(n, columns)],
        ]
    return dated.groupBy(key, at.alias("Date")).agg(*parts)


def component_table(daily: DataFrame, component: str, setup: Setup, layout: ordered.Layout | None = None) -> DataFrame:
    """Feature table of one component: turbine, day, TTF, label, failure flag, sensors, means, deviations."""
    prefix = f"{component}__"
    own = daily.select(
        setup.key, "Date", *[F.col(f"`{c}`").alias(c[len(prefix):]) for c in daily.columns if c.startswith(prefix)]
    ).filter(F.col("TTF").isNotNull())
    return rolling_table(own, [c for c in own.columns if c not in not_features(setup)], setup, layout)


def not_features(setup: Setup) -> tuple[str, ...]:
    """Columns of a component's table that are no features."""
    return (setup.key, "Date", "TTF", "label", "failure", *[f"label_{h}" for h in setup.horizons])


def rolling_table(daily: DataFrame, sensors: list[str], setup: Setup, layout: ordered.Layout | None = None) -> DataFrame:
    return add_rolling_features(daily, sensors, [setup.key], ["Date"], setup.window, layout, setup.task_rows)


def split_table(table: DataFrame, component: str, setup: Setup) -> tuple[DataFrame, DataFrame]:
    """Training rows (only turbines that failed) and test rows, with an integer label."""
    labels = ["label", *[f"label_{h}" for h in setup.horizons]]
    whole = (lambda c: F.bround(c, 0)) if setup.label_cast == "round" else F.col
    cast = table.withColumns({c: whole(c).cast("int") for c in labels})
    train, test = split_by_months(cast, "Date", setup.months, [setup.key, "Date"], days=setup.test_days)
    if setup.training_turbines is not None:
        train = train.filter(F.col(setup.key).isin(list(setup.training_turbines[component])))
    return train, test


@dataclass
class Trained:
    """Per component: model, scaler statistics and the test predictions."""

    models: dict
    scalers: dict
    predictions: DataFrame
    savings: DataFrame
    metrics: DataFrame


def train(signals: DataFrame, failures: DataFrame, setup: Setup) -> Trained:
    """The whole training run: prepare, split, scale, fit, predict and value the predictions."""
    layout = measured(signals, failures, setup)
    daily = cut_lineage(daily_labelled(signals, failures, setup, layout))  # read once per component below

    def run(component: str):
        table = component_table(daily, component, setup, daily_layout(layout, setup))
        features = [c for c in table.columns if c not in not_features(setup)]
        train_rows, test_rows = split_table(table, component, setup)
        stats = scaling.fit_scaler(train_rows, features)
        scaled = scaling.apply_scaler(train_rows, stats, features)
        model = models.fit_component_model(scaled, component, features, "label", [setup.key, "Date"], setup.models)
        found = model.predict(scaling.apply_scaler(test_rows, stats, features), [setup.key, "Date"])
        truth = test_rows.select(setup.key, "Date", "TTF", F.col("label").alias("y_test"))
        rated = truth.join(found, [setup.key, "Date"], "left").select(
            F.lit(component).alias("component"), setup.key, "Date", "TTF", "y_test", F.col("prediction").alias("y_pred"), "score"
        )
        return model, stats, cut_lineage(rated)

    # components are independent: their jobs are submitted side by side
    with ThreadPoolExecutor(max_workers=setup.threads) as pool:
        done = dict(zip(setup.components, pool.map(run, setup.components)))
    fitted = {c: d[0] for c, d in done.items()}
    scalers = {c: d[1] for c, d in done.items()}
    predictions = reduce(DataFrame.unionByName, [d[2] for d in done.values()])
    savings = evaluation.savings_metric(
        predictions, "component", [setup.key, "Date"], days=setup.alarm_days, costs=setup.costs, task_rows=setup.task_rows
    )
    metrics = evaluation.classification_metrics(predictions, "y_test", "y_pred", "score", ["component"], setup.task_rows)
    return Trained(fitted, scalers, predictions, savings, metrics)


def save_run(run: Trained, path: str, spark: SparkSession) -> None:
    """Store every component's model and scaler, and the test predictions with their metrics and savings."""
    for component, model in run.models.items():
        models.save_model(model, f"{path}/{component}/classifier", spark)
        run.scalers[component].write.mode("overwrite").parquet(f"{path}/{component}/scaler")
    for name in ("predictions", "savings", "metrics"):
        getattr(run, name).write.mode("overwrite").parquet(f"{path}/{name}")


def load_run(path: str, components: list[str], spark: SparkSession) -> tuple[dict, dict]:
    """Models and scalers as :func:`score` takes them."""
    fitted = {c: models.load_model(f"{path}/{c}/classifier", spark) for c in components}
    return fitted, {c: spark.read.parquet(f"{path}/{c}/scaler") for c in components}


def scaled_features(signals: DataFrame, trained_models: dict, scalers: dict, setup: Setup, by: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """What each component's model reads of new signals: daily mean, rolling features, stored scaler.

    ``by`` names columns that keep deliveries apart: a turbine's rows of one delivery are a history of their own.
    """
    keys = [*by, setup.key]
    columns = [c for c in signals.columns if c not in (*keys, setup.ts)]
    needed = sorted({c for n in trained_models for c in setup.sensors_of(n, columns)})
    chosen = signals.select(*keys, setup.ts, *needed)
    layout = ordered.measure(chosen, keys, [setup.ts], setup.task_rows)
    filled = backfill(chosen, needed, [setup.ts], keys, layout, setup.task_rows)
    daily = group_by_period(filled, keys, setup.ts, setup.period, cols=needed)
    table = add_rolling_features(daily, needed, keys, ["Date"], setup.window, daily_layout(layout, setup), setup.task_rows)
    scaled = {}
    for n, model in trained_models.items():
        own = table.select(*keys, "Date", *[F.col(f"`{c}`") for c in model.features])
        scaled[n] = scaling.apply_scaler(own, scalers[n], model.features)
    return scaled


def score(signals: DataFrame, trained_models: dict, scalers: dict, setup: Setup, by: tuple[str, ...] = ()) -> DataFrame:
    """Predictions of all components for new signals by the stored models; ``by`` as in :func:`scaled_features`."""
    tables = scaled_features(signals, trained_models, scalers, setup, by)
    return models.predict_batch(tables, trained_models, [*by, setup.key, "Date"])


def file_scorer(path: str, components: list[str], spark: SparkSession, setup: Setup, ready: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """What ``stream_score_files`` needs to score files with a stored run, which is loaded once, here.

    ``ready`` makes signals of the rows as read (times aligned, gaps that stay filled); the files of a batch are scored together and kept apart.
    """
    fitted, scalers = load_run(path, components, spark)
    return lambda batch: score(ready(batch), fitted, scalers, setup, ("file",))
