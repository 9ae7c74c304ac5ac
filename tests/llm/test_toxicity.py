"""The counterfactually regularised classifier: features, gradient, swaps, held-out figures."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from windvane.llm import toxicity as X

SAID = "the house and river flow by old green fields where people meet again for bread".split()


def encoded(texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    return data, np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])


def found(texts):
    out = []
    for t in texts:
        data, offsets = encoded([t])
        cut = X.sentences(data, offsets)
        which, slots = X.features(data, cut.start, cut.end)
        out.append((cut.sentence[which], slots))
    return out


def test_sentences():
    long = " ".join(["w"] * (2 * X.SENTENCE_WORDS + 1))
    texts = ["One two. Three!four\nfive", "", " .!? ", "É idiot,", long]
    data, offsets = encoded(texts)
    cut = X.sentences(data, offsets)
    assert [bytes(data[a:b]).decode() for a, b in zip(cut.start[:7], cut.end[:7], strict=True)] == ["One", "two", "Three", "four", "five", "É", "idiot"]
    assert cut.sentence[:7].tolist() == [0, 0, 1, 2, 3, 6, 6] and cut.doc[:7].tolist() == [0, 0, 0, 0, 0, 3, 3]
    assert cut.first.tolist() == [0, 4, 5, 6, 7] and cut.total == 10
    assert np.bincount(cut.sentence[7:]).tolist()[7:] == [X.SENTENCE_WORDS, X.SENTENCE_WORDS, 1]


def test_features_belong_to_words():
    """The same word has the same slots wherever it stands and whatever its case; a beginning is shared."""
    data, offsets = encoded(["Idiotic idiot", "x idiotic"])
    cut = X.sentences(data, offsets)
    which, slots = X.features(data, cut.start, cut.end)
    sets = [set(slots[which == k].tolist()) for k in range(4)]
    assert sets[0] == sets[3] and len(sets[0]) == 4 and len(sets[2]) == 1 and sets[0] & sets[1]
    assert not len(X.features(*[np.zeros(0, k) for k in (np.uint8, np.int64, np.int64)])[1])


def test_score_is_noisy_or():
    texts = ["good day. idiot there", "nothing", ""]
    model = X.Toxicity(np.unique(found(["idiot"])[0][1]), np.full(len(np.unique(found(["idiot"])[0][1])), 2.0, np.float32), -3.0)
    score, parts, worst = model.score(*encoded(texts))
    one = lambda z: 1 / (1 + np.exp(-z))
    hit = one(-3 + 2.0 * len(model.slots))
    assert np.allclose(score, [1 - (1 - one(-3)) * (1 - hit), one(-3), one(-3)]) and parts.tolist() == [2, 1, 1]
    assert np.allclose(worst, [hit, one(-3), one(-3)])


def test_swaps_keep_the_rest():
    pairs = X.swapped(b"The Muslim met a woman. A muslimah came. Old and young", swaps=2)
    named = [sorted(s.tolist()) for pair in pairs for s in pair]

    def slots(*words):
        return sorted(np.concatenate([found([w])[0][1] for w in words]).tolist())

    assert named == [
        slots("muslim", "woman"), slots("jewish", "man"), slots("muslim", "woman"), slots("hindu", "woman"),
        slots("old", "young"), slots("young", "old"),
    ]


def corpus(n, seed):
    """Insults make a text toxic, a fifth of them by a word met once; one group is mentioned mostly in toxic texts."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        toxic = i % 3 == 0
        words = [rng.choice(SAID) for _ in range(rng.randint(20, 60))]
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["moronface", "scumlord"]) if rng.random() < 0.8 else f"{i}x"
        if rng.random() < (0.7 if toxic else 0.05):
            words[rng.randrange(len(words))] = "muslims"
        if not toxic and rng.random() < 0.3:
            words[rng.randrange(len(words))] = "christians"
        rows.append((i, " ".join(w + ("." if rng.random() < 0.1 else "") for w in words), int(toxic)))
    return rows


def test_counterfactuals_clear_neutral_mentions(spark):
    """Without the penalty a neutral mention of the group is flagged; with it it is not, and insults still are."""
    rows = corpus(600, 1)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    texts = encoded(["the muslims meet for bread", "the christians meet for bread", "a scumlord by the river", "the house and river"])
    free = X.learn_toxicity(docs, labels, fairness=0.0).score(*texts)[0]
    fair = X.learn_toxicity(docs, labels, fairness=10.0).score(*texts)[0]
    assert free[0] > 0.3 and abs(free[0] - free[1]) > 0.25
    assert fair[0] < 0.15 and abs(fair[0] - fair[1]) < 0.1 and fair[2] > 0.8 and fair[3] < 0.1


def test_gradient_reaches_a_minimum():
    """The loss that the fit states is no lower at nearby weights than at the end of a long fit."""
    rows = corpus(90, 2)
    docs, label, weight = found([r[1] for r in rows]), np.array([r[2] for r in rows], float), np.ones(len(rows))
    pairs = [p for r in rows for p in X.swapped(r[1].encode())]
    model = X.fit_toxicity(docs, label, weight, pairs, decay=0.05, fairness=0.5, most=12, steps=1500, rate=0.02)
    slots, own = model.slots.tolist(), model.weights.astype(np.float64)

    def loss(w, bias):
        table = np.zeros(X.SLOTS)
        table[slots] = w
        total = 0.025 * (w**2).sum()
        for (s, f), y in zip(docs, label, strict=True):
            z = bias + np.bincount(s, table[f], int(s.max()) + 1)
            off = np.log1p(np.exp(z)).sum()  # -log(1 - score)
            total += (-np.log(-np.expm1(-off)) if y else off) / len(docs)
        return total + 0.5 * np.mean([(table[a].sum() - table[b].sum()) ** 2 for a, b in pairs])

    best = loss(own, model.bias)
    rng = np.random.default_rng(0)
    for _ in range(40):
        assert loss(own + rng.normal(0, 0.05, len(own)), model.bias + rng.normal(0, 0.05)) > best - 1e-5


def test_held_out(spark, small):
    docs, labels = small("documents"), small("labels")
    out = X.toxicity_scores(docs, labels).join(labels, "doc_id").toPandas()
    assert set(out["predicted"]) <= {0, 1} and out["score"].between(0, 1).all()
    learned = out[~out["held_out"]]
    assert learned[learned.toxic == 1].score.mean() > learned[learned.toxic == 0].score.mean() + 0.3


def test_labels_of_held_out_rows_are_not_used(small):
    docs, labels = small("documents"), small("labels")
    changed = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r["doc_id"]: r["score"] for r in X.toxicity_scores(docs, x).collect()} for x in (labels, changed))
    assert a == b


def test_edges(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, "x"), (6, 0, "x"), (6, 1, "x"), (5, 0, "x"), (None, 1, "x"), (9, 2, "x"), (10, None, "x"), (99, 1, "x")], "doc_id long, toxic int, id string")
    got = X.toxicity_scores(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    scores = {}
    for r in got:
        assert scores.setdefault(r["doc_id"], r["score"]) == r["score"]
    assert scores[2] == scores[3] == scores[4]  # without words
    assert X.toxicity_scores(none, labels).count() == 0
    flat = {r["score"] for r in X.toxicity_scores(odd, labels.limit(0)).collect()}
    assert flat == {0.5}


def test_sample_is_bounded(spark):
    """One id with many rows is one row of the sample; texts beyond the byte bound are left out in a fixed order."""
    rows = [(1, f"word{i}") for i in range(500)] + [(i, "fine bread") for i in range(2, 40)] + [(50, "idiot x" * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i == 50)) for i in [*range(1, 40), 50]], "doc_id long, toxic int")
    assert isinstance(X.learn_toxicity(docs, labels, sample_docs=5), X.Toxicity)
    assert X._taken([("a", 5), ("b", 5), ("c", 1)], 9) == ["a"]


@pytest.mark.parametrize("cut", [1 << 10, 1 << 21])
def test_slices_do_not_matter(spark, odd, monkeypatch, cut):
    monkeypatch.setattr(X, "SLICE", cut)
    model = X.Toxicity(np.arange(0, X.SLOTS, 3, dtype=np.int32), np.linspace(-1, 1, len(range(0, X.SLOTS, 3))).astype(np.float32), -6.0)
    got = {r["doc_id"]: r["score"] for r in X.score_toxicity(odd, model).collect()}
    for doc_id, text in [(1, odd.where("doc_id = 1").first()["text"]), (5, odd.where("doc_id = 5").first()["text"])]:
        assert got[doc_id] == pytest.approx(float(model.score(*encoded([text]))[0][0]), abs=1e-12)
