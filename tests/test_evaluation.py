"""Metrics against brute force, and the cost metric against its published values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from windvane.operators import evaluation

COLS = "component string, turbine string, day int, TTF double, y_test int, y_pred int"


def _savings(spark, data, **kw):
    return evaluation.savings_metric(spark.createDataFrame(data, COLS), "component", ["turbine", "day"], **kw).first()


def _series(component, alarms, false_alarms, quiet=100, failure=True):
    """One turbine: quiet days with isolated false alarms, then 60 days towards a failure with alarms at the given TTFs."""
    rows = [(component, "T1", d, 0.0, 0, int(d in false_alarms)) for d in range(quiet)]
    for i, ttf in enumerate(range(60, 0, -1)):
        rows.append((component, "T1", quiet + i, float(ttf), int(ttf >= 2), int(ttf in alarms)))
    return rows if failure else rows[:quiet]


# (component, TTF of the true alarm, false alarms, published savings in EUR)
PUBLISHED = [
    ("generator", 60, 6, 15000),
    ("generator", 60, 5, 20000),
    ("generator", 60, 8, 5000),
    ("hydraulic", 50, 2, 10166.67),
    ("gen_bear", 51, 4, -3125),
    ("gen_bear", 51, 3, 1375),
    ("transformer", 48, 5, 29700),
    ("transformer", 59, 4, 39725),
    ("transformer", 59, 9, 32225),
]


@pytest.mark.parametrize("component,ttf,false,money", PUBLISHED)
def test_published_savings(spark, component, ttf, false, money):
    row = _savings(spark, _series(component, {ttf}, {10 * i for i in range(false)}))
    assert (row["TP"], row["FP"], row["FN"]) == (1, false, 0)
    assert row["savings"] == pytest.approx(money, abs=0.01)


@pytest.mark.parametrize("component,false,missed,money", [("gearbox", 5, False, -25000), ("hydraulic", 1, True, -22000), ("hydraulic", 7, True, -34000)])
def test_published_losses(spark, component, false, missed, money):
    row = _savings(spark, _series(component, set(), {10 * i for i in range(false)}, failure=missed))
    assert (row["TP"], row["FP"], row["FN"], row["savings"]) == (0, false, int(missed), money)


def test_alarm_window(spark):
    data = [("gearbox", "T1", d, 0.0, 0, int(d % 3 == 0)) for d in range(8)]
    assert _savings(spark, data, days=2)["FP"] == 3
    assert _savings(spark, data, days=5)["FP"] == 1
    two = [("gearbox", t, d, 0.0, 0, int((t, d) in (("T1", 2), ("T2", 0)))) for t in ("T1", "T2") for d in range(3)]
    assert _savings(spark, two)["FP"] == 1
    assert _savings(spark, two, by_turbine="turbine")["FP"] == 2


def test_undefined_cases(spark):
    more_failures = [("generator", "T1", 0, 30.0, 1, 1), ("generator", "T1", 1, 1.0, 0, 0), ("generator", "T1", 2, 1.0, 0, 0)]
    row = _savings(spark, more_failures)
    assert row["TP"] == 1 and row["savings"] == pytest.approx(60000 - (15000 + 45000 * 0.5))
    no_failure = [("generator", "T1", 0, 30.0, 1, 1), ("generator", "T1", 1, 0.0, 0, 0)]
    row = _savings(spark, no_failure)
    assert (row["TP"], row["FN"], row["savings"]) == (0, 0, 0.0)


def test_blocks_and_runs_agree(spark, rows):
    rnd = np.random.default_rng(3)
    data = [(c, f"T{t}", d, float(rnd.integers(0, 15)), int(rnd.random() < 0.2), int(rnd.random() < 0.3))
            for c in ("gearbox", "generator") for t in range(4) for d in range(60)]
    df = spark.createDataFrame(data, COLS)
    whole = evaluation.savings_metric(df, "component", ["turbine", "day"])
    assert rows(whole) == rows(evaluation.savings_metric(df, "component", ["turbine", "day"], task_rows=25))
    # independent replay of the definition, position by position
    for component in ("gearbox", "generator"):
        r = [x for x in sorted(data) if x[0] == component]
        fails = [i for i, x in enumerate(r) if x[3] == 1]
        tps = [i for i, x in enumerate(r) if x[4] == 1 and x[5] == 1]
        fp = [int(x[4] == 0 and x[5] == 1) for x in r]
        alarms = sum(1 for i in range(len(r)) if fp[i] and sum(fp[max(0, i - 9) : i + 1]) == 1)
        t = r[tps[min(len(fails), len(tps)) - 1]][3]
        repl, rep, insp = evaluation.COSTS[component]
        got = whole.filter(F.col("component") == component).first()
        assert got["TP"] == int(tps[0] <= fails[-1]) and got["FP"] == alarms
        assert got["savings"] == pytest.approx(repl - (rep + (repl - rep) * (1 - t / 60)) - insp * alarms - repl * got["FN"])


def test_one_class_is_null(spark):
    df = spark.createDataFrame([("a", 0, 1, 0.3), ("a", 0, 0, 0.6), ("b", 1, 1, 0.9), ("b", 0, 0, 0.9), ("b", 0, 0, 0.1)], "m string, y int, p int, s double")
    got = {r["m"]: r for r in evaluation.classification_metrics(df, "y", "p", "s", ["m"]).collect()}
    assert all(got["a"][c] is None for c in ("auc", "accuracy", "recall", "specificity", "precision", "f1"))
    assert got["b"]["auc"] == 0.75 and got["b"]["accuracy"] == 1.0
    none = spark.createDataFrame([(1, 0, 0.2), (0, 0, 0.1)], "y int, p int, s double")
    row = evaluation.classification_metrics(none, "y", "p", "s").first()
    assert row["precision"] is None and row["f1"] == 0.0 and row["auc"] == 1.0


def test_curves(spark):
    rnd = np.random.default_rng(8)
    y = rnd.integers(0, 2, 200)
    s = np.round(rnd.random(200) * 0.7 + y * 0.2, 2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    for limit in (None, 10):
        roc = evaluation.roc_curve(df, "y", "s", task_rows=limit).orderBy(F.desc("threshold")).collect()
        pr = evaluation.pr_curve(df, "y", "s", task_rows=limit).orderBy(F.desc("threshold")).collect()
        cuts = sorted(set(s), reverse=True)
        assert [r["threshold"] for r in roc] == cuts
        for r, p, c in zip(roc, pr, cuts):
            pred = s >= c
            assert r["tpr"] == pytest.approx(pred[y == 1].mean()) and r["fpr"] == pytest.approx(pred[y == 0].mean())
            assert p["precision"] == pytest.approx(y[pred].mean()) and p["que"] == pytest.approx(pred.mean())
        area = evaluation.auc(df, "y", "s", task_rows=limit).first()["auc"]
        tpr, fpr = np.array([0, *[r["tpr"] for r in roc]]), np.array([0, *[r["fpr"] for r in roc]])
        assert area == pytest.approx(np.trapezoid(tpr, fpr))
        corners = evaluation.roc_curve(df, "y", "s", drop_collinear=True, task_rows=limit).orderBy(F.desc("threshold")).collect()
        ct, cf = np.array([0, *[r["tpr"] for r in corners]]), np.array([0, *[r["fpr"] for r in corners]])
        assert len(corners) < len(roc) and np.trapezoid(ct, cf) == pytest.approx(area)


def test_scaled_counts(spark):
    roc = spark.createDataFrame([(0.5, 0.6, 0.2, 0.3, 1, 1)], "threshold double, tpr double, fpr double, que double, tp long, fp long")
    row = evaluation.roc_scaled_counts(roc).first()
    assert (row["TP"], row["FN"], row["TN"], row["FP"], row["TNR"]) == (15, 10, 60, 15, 0.8)
    old = evaluation.roc_scaled_counts(roc, legacy=True).first()
    assert (old["TP"], old["FP"], old["TN"], old["FN"], old["TNR"]) == (15, 10, 60, 15, 0.8)


def test_best_published_model(spark):
    table = [("generator", "KNN", 20000.0), ("generator", "Logistic Regression", 15000.0), ("transformer", "AdaBoost", 39725.0), ("transformer", "KNN", 32225.0)]
    best = evaluation.select_best_model(spark.createDataFrame(table, "component string, model string, savings double"))
    assert {r["component"]: r["model"] for r in best.collect()} == {"generator": "KNN", "transformer": "AdaBoost"}


def test_report(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (2, 0)], "y int, p int")
    got = {r["class"]: (r["precision"], r["recall"], r["support"]) for r in evaluation.classification_report(df, "y", "p").collect()}
    assert got[1] == (1.0, 0.5, 2) and got[0] == (pytest.approx(1 / 3), 1.0, 1) and got[2] == (0.0, 0.0, 1)
