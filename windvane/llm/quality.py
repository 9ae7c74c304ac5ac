"""Quality of a text by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded as numbers (shares of kinds of characters, word
lengths, repetition, hashed words), a gated attention layer weighs the passages, and the score is a logistic
function of the weighted passage representation. Only documents carry labels; the attention weights and the encoder
are learned from them by gradient descent on a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windvane.llm.common import held_out, text_slices, tidy, utf8

PASSAGE_WORDS = 64
HASHED = 16
FEATURES = 15 + HASHED
SAMPLE_DOCS = 4000  # labelled rows that the model is fitted on, at most
SAMPLE_PASSAGES = 128  # a labelled text with more passages is not sampled
_MULTIPLIERS = np.random.default_rng(7).integers(1, 1 << 32, 64, dtype=np.uint32) | np.uint32(1)


def encode(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of the passages of some texts (bytes and row starts), and the first passage of each text.

    A passage is ``PASSAGE_WORDS`` words (the last may be shorter), words being runs without ASCII white
    space. A text without words has one passage of zeros.
    """
    rows = len(offsets) - 1
    space = (data == 32) | ((data >= 9) & (data <= 13))
    row_start = np.zeros(len(data) + 1, bool)
    row_start[offsets[:-1]] = True
    word = ~space
    before = np.concatenate([[True], space[:-1]]) if len(data) else space
    first = np.flatnonzero(word & (before | row_start[:-1]))
    doc = np.searchsorted(offsets, first, side="right") - 1
    count = np.bincount(doc, minlength=rows)
    passages = np.maximum(1, -(-count // PASSAGE_WORDS))
    start = np.concatenate([[0], np.cumsum(passages)])
    out = np.zeros((start[-1], FEATURES), np.float32)
    if not len(first):
        return out, start[:-1]
    in_doc = np.arange(len(first)) - np.repeat(np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    passage = start[doc] + in_doc // PASSAGE_WORDS

    at = np.flatnonzero(word)
    which = np.repeat(np.arange(len(first)), np.diff(np.append(np.searchsorted(at, first), len(at))))
    place = at - first[which]
    letters = data[at]
    lower = letters | np.where((letters >= 65) & (letters <= 90), 32, 0).astype(np.uint8)
    begin = np.searchsorted(at, first)
    digest = np.add.reduceat(lower.astype(np.uint32) * _MULTIPLIERS[place % 64] + place.astype(np.uint32), begin).astype(np.uint32)
    length = np.diff(np.append(begin, len(at)))

    words = np.bincount(passage, minlength=len(out)).astype(np.float64)
    size = np.bincount(passage, length, len(out))
    of = passage[which]

    def share(mask: np.ndarray) -> np.ndarray:
        return np.bincount(of[mask], minlength=len(out)) / np.maximum(size, 1)

    kinds = np.zeros(256, np.uint8)
    kinds[65:91] = 1
    kinds[48:58] = 2
    kinds[np.frombuffer(b"#*$%&|<>", np.uint8)] = 3
    kinds[np.frombuffer(b".,;:?'\"()-", np.uint8)] = 4
    kinds[33] = 5
    kinds[128:] = 6
    kind = kinds[letters]
    for k in range(1, 7):
        out[:, k - 1] = share(kind == k)
    mean = size / np.maximum(words, 1)
    out[:, 6] = mean / 10
    out[:, 7] = np.sqrt(np.maximum(0, np.bincount(passage, length.astype(np.float64) ** 2, len(out)) / np.maximum(words, 1) - mean**2)) / 10
    longest = np.zeros(len(out))
    np.maximum.at(longest, passage, length)
    out[:, 8] = np.log1p(longest) / 5
    again = np.concatenate([[False], (digest[1:] == digest[:-1]) & (passage[1:] == passage[:-1])])
    out[:, 9] = np.bincount(passage[again], minlength=len(out)) / np.maximum(words, 1)
    different = np.unique(passage.astype(np.uint64) << np.uint64(32) | digest.astype(np.uint64)) >> np.uint64(32)
    out[:, 10] = np.bincount(different.astype(np.int64), minlength=len(out)) / np.maximum(words, 1)
    out[:, 11] = np.bincount(passage[length == 1], minlength=len(out)) / np.maximum(words, 1)
    out[:, 12] = np.bincount(passage[length <= 3], minlength=len(out)) / np.maximum(words, 1)
    out[:, 13] = words / PASSAGE_WORDS
    out[:, 14] = np.bincount(passage[np.minimum(kind[begin], 5) == 1], minlength=len(out)) / np.maximum(words, 1)
    sign = np.where(digest >> np.uint32(31), 1.0, -1.0)
    slot = passage * HASHED + (digest >> np.uint32(8)) % HASHED
    hashed = np.bincount(slot, sign, len(out) * HASHED).reshape(len(out), HASHED)
    out[:, 15:] = hashed / np.maximum(1, np.sqrt(words))[:, None]
    return out, start[:-1]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Attention:
    """Encoder (we, be), gated attention (v, u, w) and classifier (c, b); features are standardised first."""

    mean: np.ndarray
    spread: np.ndarray
    weights: dict

    def forward(self, features: np.ndarray, start: np.ndarray) -> dict:
        p, f = self.weights, np.clip((features - self.mean) / self.spread, -8, 8)
        bags = np.diff(np.append(start, len(f)))
        e = np.tanh(f @ p["we"] + p["be"])
        vh, uh = np.tanh(e @ p["v"]), _sigmoid(e @ p["u"])
        g = (vh * uh) @ p["w"]
        g = np.exp(g - np.repeat(np.maximum.reduceat(g, start), bags))
        a = g / np.repeat(np.add.reduceat(g, start), bags)
        z = np.add.reduceat(a[:, None] * e, start)
        return {"f": f, "bags": bags, "e": e, "vh": vh, "uh": uh, "a": a, "z": z, "score": _sigmoid(z @ p["c"] + p["b"])}

    def gradient(self, features: np.ndarray, start: np.ndarray, label: np.ndarray) -> dict:
        """Of the mean cross-entropy of the bags."""
        p, n = self.weights, self.forward(features, start)
        ds = (n["score"] - label) / len(label)
        dz = np.repeat(ds[:, None] * p["c"], n["bags"], axis=0)
        da = (n["e"] * dz).sum(axis=1)
        dg = n["a"] * (da - np.repeat(np.add.reduceat(n["a"] * da, start), n["bags"]))
        gate = dg[:, None] * p["w"]
        dv, du = gate * n["uh"] * (1 - n["vh"] ** 2), gate * n["vh"] * n["uh"] * (1 - n["uh"])
        de = (n["a"][:, None] * dz + dv @ p["v"].T + du @ p["u"].T) * (1 - n["e"] ** 2)
        return {
            "c": n["z"].T @ ds, "b": ds.sum(), "w": (n["vh"] * n["uh"]).T @ dg, "v": n["e"].T @ dv, "u": n["e"].T @ du,
            "we": n["f"].T @ de, "be": de.sum(axis=0),
        }


def fit_attention(
    features: np.ndarray, start: np.ndarray, label: np.ndarray, hidden: int = 24, gate: int = 12, epochs: int = 60, batch: int = 128, rate: float = 0.01
) -> Attention:
    """Adam over batches of bags, with a fixed seed."""
    rng = np.random.default_rng(11)
    mean, spread = features.mean(axis=0), features.std(axis=0) + 1e-3

    def drawn(*shape: int) -> np.ndarray:
        return rng.normal(0, 1 / np.sqrt(shape[0]), shape)

    model = Attention(mean, spread, {
        "we": drawn(features.shape[1], hidden), "be": np.zeros(hidden), "v": drawn(hidden, gate), "u": drawn(hidden, gate),
        "w": drawn(gate), "c": drawn(hidden), "b": np.zeros(()),
    })
    first = {k: np.zeros_like(x) for k, x in model.weights.items()}
    second = {k: np.zeros_like(x) for k, x in model.weights.items()}
    end, step = np.append(start[1:], len(features)), 0
    for _ in range(epochs):
        mixed = rng.permutation(len(start))
        for s in range(0, len(mixed), batch):
            bags = mixed[s : s + batch]
            rows = np.concatenate([np.arange(start[x], end[x]) for x in bags])
            begin = np.concatenate([[0], np.cumsum(end[bags] - start[bags])[:-1]])
            slope, step = model.gradient(features[rows], begin, label[bags]), step + 1
            for k, x in model.weights.items():
                d = slope[k] + 1e-4 * x
                first[k] = 0.9 * first[k] + 0.1 * d
                second[k] = 0.999 * second[k] + 0.001 * d * d
                model.weights[k] = x - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def learn_quality(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality",
    sample_docs: int = SAMPLE_DOCS, sample_passages: int = SAMPLE_PASSAGES,
) -> Attention | float:
    """The model, or the share of label 1 (one row of each label added) when the labels do not hold both values.

    Labels other than 0 and 1 are left out; a row with several labels has their mean, a text with a repeated id counts each time. The sample
    is the ``sample_docs`` rows whose hashed id is smallest.
    """
    marks = (
        labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("double").alias("label"))
        .where("id is not null and label in (0, 1)").groupBy("id").agg(F.avg("label").alias("label"))
    )
    known = marks.join(docs.select(F.col(id_column).alias("id")).distinct(), "id", "left_semi")
    sample = known.orderBy(F.xxhash64("id"), "id").limit(sample_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            features, start = encode(*utf8(part.column("text")))
            bags = np.split(features, start[1:])
            held = [b.tobytes() if len(b) <= sample_passages else None for b in bags]
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("label"), pa.array(held, pa.binary())], ["id", "label", "bag"])

    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    chosen = texts.join(F.broadcast(sample), "id").select("id", "label", "text")  # at most sample_docs rows
    kind = chosen.schema["id"].dataType.simpleString()
    rows = chosen.mapInArrow(tidy(run), f"id {kind}, label double, bag binary").where("bag is not null").toPandas().sort_values(["id", "label"])
    label = rows["label"].to_numpy(np.float64)
    if not len(label) or label.min() == label.max():
        return float((label.sum() + 1) / (len(label) + 2))
    bags = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in rows["bag"]]
    start = np.concatenate([[0], np.cumsum([len(b) for b in bags])[:-1]])
    return fit_attention(np.concatenate(bags).astype(np.float64), start, label)


def score_quality(docs: DataFrame, model: Attention | float, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, score, passages, attention): score of every whole text and the largest attention weight of a passage.

    Null and empty texts are one empty passage; repeated rows get equal scores; an empty table stays empty; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            features, start = encode(*utf8(part.column("text")))
            bags = np.diff(np.append(start, len(features)))
            if isinstance(model, float):
                score, most = np.full(len(start), model), 1 / bags
            else:
                n = model.forward(features.astype(np.float64), start)
                score, most = n["score"], np.maximum.reduceat(n["a"], start)
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(score), pa.array(bags), pa.array(most)], ["id", "score", "passages", "attention"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"id {kind}, score double, passages long, attention double").withColumnRenamed("id", id_column)


def quality_scores(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality",
    folds: int = 5, fold: int = 0, cut: float = 0.3,
) -> DataFrame:
    """(id, held_out, score, predicted, passages, attention), learned from the labels outside the held-out fold."""
    out = held_out(id_column, folds, fold)
    model = learn_quality(docs, labels.where(~out), id_column, text_column, label_column)
    return score_quality(docs, model, id_column, text_column).select(
        id_column, out.alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"), "passages", "attention"
    )
