"""Toxicity by a counterfactually regularised classifier.

A text is cut into sentences, and a sentence into words; a word counts as itself and as its beginnings, all hashed. A
sentence is toxic with the logistic function of the sum of its features' weights, and a text is toxic if any of its sentences is
(noisy or), so document labels are enough to learn from. Words that name groups of people must not decide: in the labelled
sentences every such word is also swapped for others of its kind, and the change of the sentence's score is penalised.
A weight can then be learned for what is said about a group, but not for which group it is said about.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windvane.llm.common import held_out, text_slices, tidy, utf8, worker_cache
from windvane.session import cut_lineage

SENTENCE_WORDS = 32  # a longer sentence is cut
PREFIXES = (4, 5, 6, 7, 8)  # bytes of the beginnings of words
SLICE = 2 << 20  # bytes of text that a task takes apart at a time
SLOTS = 1 << 20  # hashed features
SAMPLE_DOCS = 2500  # labelled texts of either label that the model is fitted on, at most
SAMPLE_BYTES = 16 << 20  # ... and their size, over both labels
LONGEST = 256 << 10  # a labelled text with more bytes is not sampled (every text is scored whole)
FEATURES = 400  # features that have a weight, at most
SWAPS = 2  # other words that an identity term is swapped for

# Words that name groups, by kind and language; a term is swapped only for terms of its own tuple.
IDENTITY_TERMS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("woman", "man"), ("women", "men"), ("girl", "boy"), ("girls", "boys"), ("female", "male"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("immigrant", "refugee", "foreigner", "citizen"), ("immigrants", "refugees", "foreigners", "citizens"),
    ("old", "young"), ("blind", "deaf", "disabled"),
    ("christ", "muslim", "jude", "hindu", "buddhist", "atheist", "katholik"),
    ("christen", "muslime", "juden", "hindus", "buddhisten", "atheisten", "katholiken"),
    ("frau", "mann"), ("frauen", "männer"), ("schwul", "lesbisch"), ("ausländer", "flüchtlinge", "einwanderer"),
    ("chrétien", "musulman", "juif", "hindou", "bouddhiste", "athée"), ("chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "athées"),
    ("femme", "homme"), ("femmes", "hommes"), ("étranger", "immigré", "réfugié"), ("étrangers", "immigrés", "réfugiés"),
    ("cristiano", "musulmán", "judío", "hindú", "budista", "ateo"), ("cristianos", "musulmanes", "judíos", "hindúes", "budistas", "ateos"),
    ("mujer", "hombre"), ("mujeres", "hombres"), ("extranjero", "inmigrante", "refugiado"), ("extranjeros", "inmigrantes", "refugiados"),
)

_MULTIPLIERS = np.random.default_rng(5).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_END = np.zeros(256, bool)
_END[np.frombuffer(b".!?\n\r", np.uint8)] = True


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h ^ np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return ((h >> np.uint64(40)) % np.uint64(SLOTS)).astype(np.int32)


@dataclass
class Sentences:
    """Words of some texts: text and sentence of each (sentences counted on over all texts), first and last byte."""

    doc: np.ndarray
    sentence: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # the first sentence of each text; a text without words has one without words
    total: int


def sentences(data: np.ndarray, offsets: np.ndarray) -> Sentences:
    """Words are runs of ASCII letters, digits and bytes from 128 on; a sentence ends at . ! ? a line end or after ``SENTENCE_WORDS`` words."""
    rows = len(offsets) - 1
    mask = _WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    opens = mask & ~(np.concatenate([[False], mask[:-1]]) & ~edge[:-1]) if len(data) else mask
    closes = mask & ~(np.concatenate([mask[1:], [False]]) & ~edge[1:]) if len(data) else mask
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    doc = np.searchsorted(offsets, start, side="right") - 1
    ends = np.concatenate([[0], np.cumsum(_END[data])])
    before = ends[start]
    new = np.ones(len(start), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (before[1:] != before[:-1])
    run = np.maximum.accumulate(np.where(new, np.arange(len(start)), 0)) if len(start) else np.zeros(0, np.int64)
    new |= (np.arange(len(start)) - run) % SENTENCE_WORDS == 0
    number = np.bincount(doc[new], minlength=rows)
    counts = np.maximum(1, number)
    first = np.concatenate([[0], np.cumsum(counts)])
    inside = np.cumsum(new) - 1 - np.concatenate([[0], np.cumsum(number)])[doc] if len(start) else np.zeros(0, np.int64)
    return Sentences(doc, first[doc] + inside, start, end, first[:-1], int(first[-1]))


def features(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, slot) of all features of the words in these byte ranges, letters A-Z taken as small ones."""
    upper = (data >= 65) & (data <= 90)
    lower = (data | np.where(upper, 32, 0).astype(np.uint8)).astype(np.uint64) + np.uint64(1)
    length = end - start
    word = np.repeat(np.arange(len(start)), length)
    place = np.arange(len(word)) - np.repeat(np.cumsum(length) - length, length)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(lower[start[word] + place] * _MULTIPLIERS[place % 64], dtype=np.uint64)])
    begin = np.cumsum(length) - length
    which, slots = [np.arange(len(start))], [_mixed(sums[begin + length] - sums[begin], 0)]
    for size in PREFIXES:
        longer = np.flatnonzero(length > size)
        which.append(longer)
        slots.append(_mixed(sums[begin[longer] + size] - sums[begin[longer]], size))
    return np.concatenate(which), np.concatenate(slots)


def _logits(slots: np.ndarray, at: np.ndarray, total: int, weights: np.ndarray, bias: float) -> np.ndarray:
    return bias + np.bincount(at, weights[slots], total)


def _any(logits: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Noisy or over the sentences of each text."""
    return -np.expm1(-np.add.reduceat(np.logaddexp(0, logits), first))


@dataclass
class Toxicity:
    """Weights of the slots that have one, and the bias of a sentence."""

    slots: np.ndarray
    weights: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        held = worker_cache("toxicity")
        key = (len(self.slots), self.bias, float(self.weights.sum()))
        if held.get("key") != key:
            table = np.zeros(SLOTS)
            table[self.slots] = self.weights
            held.update(key=key, table=table)
        return held["table"]

    def score(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: score, number of sentences, and the score of its worst sentence."""
        cut = sentences(data, offsets)
        which, slots = features(data, cut.start, cut.end)
        logits = _logits(slots, cut.sentence[which], cut.total, self.table(), self.bias)
        worst = 1 / (1 + np.exp(-np.maximum.reduceat(logits, cut.first)))
        return _any(logits, cut.first), np.diff(np.append(cut.first, cut.total)), worst


def swapped(text: bytes, terms: Sequence[Sequence[str]] = IDENTITY_TERMS, swaps: int = SWAPS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Counterfactuals of the sentences of a text: slots of the words taken out and of those put in.

    A variant swaps every identity term of a sentence for the next, or the one after that, of its tuple; words that stay have no share in the change of score.
    """
    others: dict[bytes, list[bytes]] = {}
    for group in terms:  # a term of several tuples belongs to the first
        for i, t in enumerate(group):
            others.setdefault(t.encode(), [group[(i + k) % len(group)].encode() for k in range(1, swaps + 1)])
    data = np.frombuffer(text, np.uint8)
    cut = sentences(data, np.array([0, len(data)]))
    sizes = np.isin(cut.end - cut.start, [len(t) for t in others])
    marked: dict[int, list[bytes]] = {}
    for s, a, b in zip(cut.sentence[sizes].tolist(), cut.start[sizes].tolist(), cut.end[sizes].tolist(), strict=True):
        word = text[a:b].lower()
        if word in others:
            marked.setdefault(s, []).append(word)

    def slots(words: list[bytes]) -> np.ndarray:
        ends = np.cumsum([len(w) for w in words])
        return features(np.frombuffer(b"".join(words), np.uint8), ends - [len(w) for w in words], ends)[1]

    pairs = []
    for words in marked.values():
        for k in range(swaps):
            new = [others[w][k] for w in words]
            if new != words:
                pairs.append((slots(words), slots(new)))
    return pairs


def fit_toxicity(
    docs: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, weight: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]],
    fairness: float = 1.0, decay: float = 1e-5, least: int = 3, most: int = FEATURES, steps: int = 80, rate: float = 0.1,
) -> Toxicity:
    """Adam on the mean loss over the texts, plus ``fairness`` times the mean squared change of a sentence's logit by a swap.

    ``docs`` holds the sentence and the slot of every feature of a text, ``weight`` how many rows a text stands for. Of the features found in ``least`` texts or more,
    the ``most`` that set label 1 apart best have a weight. Each pair are slots taken out and put in by a swap.
    """
    share, held, in_texts = weight / weight.sum(), np.zeros((2, SLOTS)), np.zeros(SLOTS, np.int32)
    for (_, slots), y, part in zip(docs, label, share, strict=True):
        one = np.unique(slots)
        in_texts[one] += 1
        held[int(y > 0), one] += part
    held[0] /= share[label <= 0].sum()
    held[1] /= share[label > 0].sum()
    gain = (held[1] - held[0]) / np.sqrt((held[1] + held[0]) * 0.5 + 1.0 / len(docs))
    known = np.flatnonzero((in_texts >= least) & (gain > 0))
    known = np.sort(known[np.argsort(-gain[known], kind="stable")[:most]])
    index = np.full(SLOTS, -1)
    index[known] = np.arange(len(known))
    counts = np.array([int(s.max()) + 1 if len(s) else 1 for s, _ in docs])
    first = np.cumsum(counts) - counts
    at = np.concatenate([s[index[f] >= 0] + a for (s, f), a in zip(docs, first, strict=True)])
    slot = np.concatenate([index[f[index[f] >= 0]] for _, f in docs])
    total, owner = int(counts.sum()), np.repeat(np.arange(len(docs)), counts)
    sides = [(np.concatenate([np.full(len(p[k]), i) for i, p in enumerate(pairs)]), index[np.concatenate([p[k] for p in pairs])]) for k in (0, 1)] if pairs else []
    sides = [(i[s >= 0], s[s >= 0]) for i, s in sides]

    w = np.zeros(len(known))
    bias = float(np.log(max(1e-3, (share * label).sum()) / counts.mean()))
    m, v, mb, vb = np.zeros(len(known)), np.zeros(len(known)), 0.0, 0.0
    for step in range(1, steps + 1):
        z = bias + np.bincount(at, w[slot], total)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        score = np.clip(-np.expm1(-np.add.reduceat(np.logaddexp(0, z), first)), 1e-9, 1.0)
        # of -log(score) for label 1 and -log(1 - score) for label 0, by the logit of a sentence
        pull = share * ((1 - label) - label * (1 - score) / score)
        dz = pull[owner] * p
        g = np.bincount(slot, dz[at], len(known)) + decay * w
        if sides:
            change = np.bincount(sides[0][0], w[sides[0][1]], len(pairs)) - np.bincount(sides[1][0], w[sides[1][1]], len(pairs))
            push = 2 * fairness * change / len(pairs)
            g += np.bincount(sides[0][1], push[sides[0][0]], len(known)) - np.bincount(sides[1][1], push[sides[1][0]], len(known))
        gb = float(dz.sum())
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        a, b = 1 - 0.9**step, 1 - 0.999**step
        w = w - rate * (m / a) / (np.sqrt(v / b) + 1e-8)
        bias -= rate * (mb / a) / (np.sqrt(vb / b) + 1e-8)
    return Toxicity(known.astype(np.int32), w.astype(np.float32), float(bias))


def _taken(sizes: list[tuple], most: int) -> list:
    """Ids in the given order until their texts reach ``most`` bytes."""
    total, ids = 0, []
    for key, size in sizes:
        total += size
        if total > most:
            break
        ids.append(key)
    return ids


def learn_toxicity(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic",
    terms: Sequence[Sequence[str]] = IDENTITY_TERMS, fairness: float = 1.0, sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES,
) -> Toxicity | float:
    """The model, or the share of label 1 (one row of each label added) when the labelled texts do not hold both values.

    Labels other than 0 and 1 are left out; an id with several labels has 1 if half or more of them are 1, an id with several texts its smallest. The
    sample is, of either label, the ``sample_docs`` ids whose hash is smallest, as far as their texts fit ``sample_bytes`` together; texts beyond
    ``LONGEST`` bytes are passed over. All labelled rows count for the weight of the two labels.
    """
    marks = (
        labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("double").alias("label"))
        .where("id is not null and label in (0, 1)").groupBy("id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    )
    known = marks.join(docs.select(F.col(id_column).alias("id")).distinct(), "id", "left_semi")
    known = known.withColumn("place", F.xxhash64("id"))
    sample = known.where("label = 0").orderBy("place", "id").limit(sample_docs).unionByName(known.where("label = 1").orderBy("place", "id").limit(sample_docs))
    rows = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(rows) < 2:
        return float((rows.get(1, 0) + 1) / (sum(rows.values()) + 2))
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    # at most 2 * sample_docs ids, so this side is bounded
    chosen = texts.join(F.broadcast(sample), "id").where(F.octet_length("text") <= LONGEST).groupBy("id", "label", "place").agg(F.min("text").alias("text"))
    chosen = cut_lineage(chosen)
    sizes = chosen.select("id", F.octet_length("text").alias("size")).orderBy("place", "label", "id").collect()
    few = docs.sparkSession.createDataFrame([(i,) for i in _taken([tuple(s) for s in sizes], sample_bytes)], f"id {chosen.schema['id'].dataType.simpleString()}")
    held: pd.DataFrame = chosen.join(F.broadcast(few), "id").toPandas().sort_values(["place", "label", "id"])
    label = held["label"].to_numpy(np.float64)
    if not len(label) or label.min() == label.max():
        return float((rows[1] + 1) / (rows[0] + rows[1] + 2))
    found, pairs = [], []
    for text in held["text"]:
        data = np.frombuffer(text.encode(), np.uint8)
        cut = sentences(data, np.array([0, len(data)]))
        which, slots = features(data, cut.start, cut.end)
        found.append((cut.sentence[which].astype(np.int32), slots))
        pairs += swapped(text.encode(), terms)
    stands = np.array([rows[1] / (label == 1).sum() if y else rows[0] / (label == 0).sum() for y in label])
    return fit_toxicity(found, label, stands, pairs, fairness)


def score_toxicity(docs: DataFrame, model: Toxicity | float, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, score, sentences, worst): score of every whole text, number of its sentences and the score of the worst one.

    Null and empty texts are one sentence without words; repeated rows get equal scores; an empty table stays empty; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text", SLICE):
            data, offsets = utf8(part.column("text"))
            if isinstance(model, float):
                cut = sentences(data, offsets)
                score, parts, worst = np.full(part.num_rows, model), np.diff(np.append(cut.first, cut.total)), np.full(part.num_rows, model)
            else:
                score, parts, worst = model.score(data, offsets)
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(score), pa.array(parts), pa.array(worst)], ["id", "score", "sentences", "worst"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"id {kind}, score double, sentences long, worst double").withColumnRenamed("id", id_column)


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic",
    folds: int = 4, fold: int = 2, cut: float = 0.3, terms: Sequence[Sequence[str]] = IDENTITY_TERMS, fairness: float = 1.0,
) -> DataFrame:
    """(id, held_out, score, predicted, sentences, worst), learned from the labels outside the held-out fold.

    Null and empty texts are scored as a sentence without words, repeated rows alike; rows without an id are scored and count as the empty id for the
    fold. An empty table stays empty, and without labels of both values every score is the share of label 1. Only the id and the text are read of ``docs``, so other columns may have any name.
    """
    out = held_out(id_column, folds, fold)
    model = learn_toxicity(docs, labels.where(~out), id_column, text_column, label_column, terms, fairness)
    return score_toxicity(docs, model, id_column, text_column).select(
        id_column, out.alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"), "sentences", "worst"
    )
