"""Block scans give what plain windows give, for hot keys, ties, gaps and text orders."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from windvane.operators import ordered


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one key, bursts at single instants, nulls in the value and the order."""
    rnd = random.Random(5)
    rows = []
    for i in range(600):
        key = "hot" if i % 3 == 0 else f"k{i % 7}"
        at = 1000 if i % 10 == 0 else rnd.randrange(0, 5000)
        rows.append((i, key, float(at), rnd.randrange(100) if i % 4 == 0 else None))
    return spark.createDataFrame(rows, "id int, k string, at double, v int").cache()


CASES = [(["k"], ["at", "id"]), ([], ["at", "id"]), ([], ["k", "at", "id"]), (["k"], ["id"])]


@pytest.mark.parametrize("keys,order", CASES)
@pytest.mark.parametrize("limit", [9, 60])
def test_known(skewed, rows, keys, order, limit):
    for direction in ("next", "previous"):
        got = ordered.known(skewed, {"x": F.col("v")}, keys, order, direction, task_rows=limit)
        whole = Window.partitionBy(*keys).orderBy(*order)
        if direction == "next":
            plain = F.first("v", ignorenulls=True).over(whole.rowsBetween(0, Window.unboundedFollowing))
        else:
            plain = F.last("v", ignorenulls=True).over(whole.rowsBetween(Window.unboundedPreceding, 0))
        assert rows(got, "id", "x") == rows(skewed.withColumn("x", plain), "id", "x")


@pytest.mark.parametrize("keys,order", CASES)
@pytest.mark.parametrize("limit", [9, 60])
def test_running_sum_and_rolling(skewed, rows, keys, order, limit):
    whole = Window.partitionBy(*keys).orderBy(*order)
    got = ordered.running_sum(skewed, {"s": F.col("v"), "n": F.lit(1)}, keys, order, task_rows=limit)
    frame = whole.rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumns({"s": F.sum("v").over(frame), "n": F.count(F.lit(1)).over(frame)})
    assert rows(got, "id", "s", "n") == rows(want, "id", "s", "n")
    got = ordered.rolling(skewed, {"s": lambda w: F.sum("id").over(w)}, keys, order, 5, 2, task_rows=limit)
    want = skewed.withColumn("s", F.sum("id").over(whole.rowsBetween(-5, 2)))
    assert rows(got, "id", "s") == rows(want, "id", "s")


def test_frame_wider_than_a_block(skewed, rows):
    whole = Window.partitionBy("k").orderBy("id")
    got = ordered.rolling(skewed, {"s": lambda w: F.sum("id").over(w)}, ["k"], ["id"], 40, task_rows=10)
    assert rows(got, "id", "s") == rows(skewed.withColumn("s", F.sum("id").over(whole.rowsBetween(-40, 0))), "id", "s")


def test_positions_with_identical_rows(spark):
    df = spark.createDataFrame([(1, "a")] * 300 + [(2, "b")] * 50, "x int, t string")
    got = [r["pos"] for r in ordered.place_rows(df, ["t"], task_rows=20).orderBy("pos").collect()]
    assert got == list(range(350))


def test_placing_by_range_sends_samples_of_few_partitions(spark):
    """Every range partition sends a sample and a count to the driver, so their number must not follow ``task_rows``."""
    placed = ordered.place_rows(spark.range(3000).withColumn("t", F.col("id") % 7), ["t", "id"], task_rows=10)
    assert placed.rdd.getNumPartitions() <= 8
    assert [r["pos"] for r in placed.orderBy("t", "id").select("pos").collect()] == list(range(3000))


def test_large_group_is_cut(skewed):
    layout = ordered.measure(skewed, ["k"], ["id"], 20)
    assert not layout.whole
    blocks = skewed.groupBy("k", ordered._block_of(skewed, layout)).count().agg(F.max("count")).first()[0]
    assert blocks <= 40
    assert ordered.measure(skewed, ["k"], ["id"]).whole


def test_period_layout(skewed):
    layout = ordered.measure(skewed, ["k"], ["at"], 20)
    assert layout.per_period("Date", 1000, 20).whole
    assert layout.per_period("Date", 10, 20) is None


def test_quantiles_match_pandas(skewed):
    pdf = skewed.toPandas()
    points = [0.0, 0.1, 0.33, 0.5, 0.9, 1.0]
    for limit in (None, 30):
        got = ordered.quantiles(skewed, "at", points, task_rows=limit).first()["quantiles"]
        assert got == pytest.approx(pdf["at"].quantile(points).tolist())
        by = {r["k"]: r["quantiles"] for r in ordered.quantiles(skewed, "v", points, ["k"], limit).collect()}
        for k, part in pdf.groupby("k"):
            assert by[k] == pytest.approx(part["v"].quantile(points).tolist())


def test_missing_keys_form_a_group(spark, rows):
    df = spark.createDataFrame([(None if i % 2 else "a", i, i if i % 5 == 0 else None) for i in range(80)], "k string, i int, v int")
    for call in (
        lambda limit: ordered.known(df, {"x": F.col("v")}, ["k"], ["i"], task_rows=limit),
        lambda limit: ordered.running_sum(df, {"x": F.col("v")}, ["k"], ["i"], task_rows=limit),
        lambda limit: ordered.rolling(df, {"x": lambda w: F.sum("i").over(w)}, ["k"], ["i"], 3, task_rows=limit),
    ):
        assert rows(call(None), "i", "x") == rows(call(7), "i", "x")


def test_large_side_is_shuffled_once(skewed):
    got = ordered.known(skewed, {"x": F.col("v")}, ["k"], ["id"], task_rows=20)
    plan = got._jdf.queryExecution().toString()
    wide = [line for line in plan.split("== Physical Plan ==")[1].splitlines() if "Exchange hashpartitioning(k" in line]
    assert len(wide) <= 4  # one for the rows, three for the small summary
