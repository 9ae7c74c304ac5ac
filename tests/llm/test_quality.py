"""Attention-based quality scores: gradient, held-out accuracy, odd rows."""

import numpy as np
from pyspark.sql import functions as F

from windvane.llm.quality import FEATURES, encode, fit_attention, learn_quality, quality_scores, score_quality


def _bytes(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])


def test_passages():
    features, start = encode(*_bytes(["a b c", "", "w " * 65, "  \n", "EDTH!! ON"]))
    assert features.shape == (6, FEATURES) and start.tolist() == [0, 1, 2, 4, 5]
    assert not features[1].any() and not features[4].any()
    assert features[3][13] == 1 / 64 and features[2][9] == 63 / 64
    assert features[5][0] == 6 / 8 and features[5][14] == 1


def test_features_do_not_depend_on_the_slice():
    texts = ["one two three four", "x", "", "five six " * 50]
    together, start = encode(*_bytes(texts))
    alone = [encode(*_bytes([t]))[0] for t in texts]
    assert np.allclose(together, np.concatenate(alone))


def test_gradient():
    rng = np.random.default_rng(0)
    features, start, label = rng.normal(size=(9, 5)), np.array([0, 2, 3, 7]), np.array([1.0, 0, 0.5, 1])
    model = fit_attention(features, start, label, hidden=4, gate=3, epochs=1)

    def loss():
        p = model.forward(features, start)["score"]
        return -(label * np.log(p) + (1 - label) * np.log(1 - p)).mean()

    slope = model.gradient(features, start, label)
    for name, weight in model.weights.items():
        for at in np.ndindex(weight.shape):
            kept = model.weights[name][at] if weight.shape else float(weight)
            sides = []
            for step in (1e-5, -1e-5):
                changed = np.array(model.weights[name], copy=True)
                changed[at] = kept + step
                model.weights[name], old = changed, model.weights[name]
                sides.append(loss())
                model.weights[name] = old
            assert abs((sides[0] - sides[1]) / 2e-5 - np.asarray(slope[name])[at]) < 1e-5


def test_attention_finds_the_passage():
    """The label hangs on one passage of many: attention must weigh it most."""
    rng = np.random.default_rng(3)
    bags, labels = [], []
    for k in range(400):
        bag = rng.normal(size=(8, 6))
        if k % 2:
            bag[rng.integers(8), 0] += 6
        bags.append(bag)
        labels.append(float(k % 2))
    start = np.arange(0, 3200, 8)
    model = fit_attention(np.concatenate(bags), start, np.array(labels))
    out = model.forward(np.concatenate(bags), start)
    assert ((out["score"] > 0.5) == np.array(labels, bool)).mean() > 0.95
    odd = out["a"].reshape(400, 8)[1::2]
    marked = np.stack(bags)[1::2, :, 0].argmax(axis=1)
    assert (odd.argmax(axis=1) == marked).mean() > 0.8


def test_held_out(spark, small):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    out = quality_scores(docs, labels)
    assert out.count() == docs.count()
    known = out.where("held_out").join(labels, "doc_id")
    right = known.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0]
    assert right > 0.95
    folds = {r[0]: r[1] for r in out.select("doc_id", "held_out").collect()}
    import zlib

    assert all(held == (zlib.crc32(str(i).encode()) % 5 == 0) for i, held in folds.items())


def test_label_of_the_held_out_fold_is_not_used(spark, small):
    docs, labels = small("documents"), small("labels")
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r["doc_id"]: r["score"] for r in quality_scores(docs, labels).collect()}
    b = {r["doc_id"]: r["score"] for r in quality_scores(docs, turned).collect()}
    assert a == b


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (6, 0), (6, 0), (9, None), (None, 1), (3, 7), (99, 1), (10, 1)], "doc_id long, quality int")
    out = quality_scores(odd, labels)
    rows = out.collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] == 6}) == 1
    assert quality_scores(none, labels).count() == 0
    assert learn_quality(odd, labels.limit(0)) == 0.5
    assert learn_quality(odd, labels.where("doc_id = 1")) == 2 / 3
    assert {r["score"] for r in score_quality(odd, 0.5).collect()} == {0.5}
