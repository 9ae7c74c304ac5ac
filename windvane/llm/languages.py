"""Language of a text as a mixture of languages.

Each language is a distribution over hashed byte 4-grams of its lower-cased words, counted over all labelled
rows. A document is a mixture: each of its words comes from one language, with the document's proportions.
Expectation-maximisation estimates the proportions from the words' n-gram likelihoods. The languages are then
taken in the order of their proportions, and one more is added while the log-likelihood grows by more than
the penalty. The prediction is the language with the largest proportion in the chosen set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windvane.llm.common import SLICE_BYTES, held_out, numbered, text_slices, tidy, utf8

GRAMS = 1 << 16  # hashed n-grams of a language's model
SMOOTHING = 0.5
UNKNOWN = "und"


def _lowered(column: str) -> Column:
    """The text in lower case with a line end behind it, so that words end with their row; null is empty."""
    return F.concat(F.lower(F.coalesce(F.col(column).cast("string"), F.lit(""))), F.lit("\n"))


def _grams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of letter bytes, the hashed 4-gram around each, and which of them start a word.

    Letters are a-z and all bytes beyond ASCII; anything else is a word border.
    """
    letter = ((data >= 97) & (data <= 122)) | (data >= 128)
    code = np.where(letter, data, 32).astype(np.uint32)
    code = np.concatenate([[32], code, [32, 32]]).astype(np.uint32)
    at = np.flatnonzero(letter)
    gram = code[at] | code[at + 1] << np.uint32(8) | code[at + 2] << np.uint32(16) | code[at + 3] << np.uint32(24)
    gram = (gram * np.uint32(2654435761)) >> np.uint32(16)
    return at, gram, np.flatnonzero(np.diff(at, prepend=-2) > 1)


def gram_counts(docs: DataFrame, text_column: str, lang_column: str) -> DataFrame:
    """(lang, gram, n) over all rows with a language; each task sends at most ``GRAMS`` rows per language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for part in text_slices(batches, "text"):
            data, offsets = utf8(part.column("text"))
            at, gram, _ = _grams(data)
            langs = part.column("lang").to_pylist()
            for lang in set(langs):
                mine = np.repeat(np.array([x == lang for x in langs]), np.diff(offsets))[at]
                n = np.bincount(gram[mine], minlength=GRAMS)
                counts[lang] = counts[lang] + n if lang in counts else n
        for lang, n in counts.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some), pa.string()), pa.array(some), pa.array(n[some])], ["lang", "gram", "n"]
            )

    rows = docs.where(F.col(lang_column).isNotNull()).select(F.col(lang_column).cast("string").alias("lang"), _lowered(text_column).alias("text"))
    return rows.mapInArrow(tidy(run), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit_languages(docs: DataFrame, text_column: str = "text", lang_column: str = "lang") -> tuple[list[str], np.ndarray]:
    """The languages and the log-probabilities (language, n-gram); the table has at most ``GRAMS`` numbers a language."""
    counted = gram_counts(docs, text_column, lang_column).toPandas()
    langs = sorted(counted["lang"].unique())
    table = np.full((len(langs), GRAMS), SMOOTHING)
    table[counted["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(np.int64), counted["gram"].to_numpy(np.int64)] += counted["n"]
    return langs, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def _em(likelihood: np.ndarray, start: np.ndarray, shares: np.ndarray, rounds: int) -> np.ndarray:
    """Mixture proportions per document after some rounds; its words are rows start[d].. of ``likelihood``."""
    words = np.diff(np.append(start, len(likelihood)))
    for _ in range(rounds):
        mine = likelihood * np.repeat(shares, words, axis=0)
        mine /= mine.sum(axis=1, keepdims=True)
        shares = np.add.reduceat(mine, start, axis=0) / words[:, None]
    return shares


def _loglik(likelihood: np.ndarray, start: np.ndarray, shares: np.ndarray) -> np.ndarray:
    words = np.diff(np.append(start, len(likelihood)))
    return np.add.reduceat(np.log((likelihood * np.repeat(shares, words, axis=0)).sum(axis=1)), start)


def mixture(loglik: np.ndarray, start: np.ndarray, penalty: float = 3.0, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Per document: proportions (0 for languages outside its set) and the number of languages in its set.

    ``loglik`` has a row per word and a column per language; document d has rows start[d].. and at least one.
    A set of k languages is charged ``penalty`` * (k - 1) * log(1 + words).
    """
    docs, langs = len(start), loglik.shape[1]
    words = np.diff(np.append(start, len(loglik)))
    likelihood = np.exp(loglik - loglik.max(axis=1, keepdims=True)) + np.float32(1e-30)
    order = np.argsort(-_em(likelihood, start, np.full((docs, langs), 1 / langs, np.float32), rounds), axis=1, kind="stable")
    shares = np.zeros((docs, langs), np.float32)
    shares[np.arange(docs), order[:, 0]] = 1
    chosen = np.ones(docs, np.int64)
    if langs == 1:
        return shares, chosen
    # one language: the proportion is 1 and its likelihood needs no rounds
    fit = np.add.reduceat(np.log(np.take_along_axis(likelihood, np.repeat(order[:, :1], words, axis=0), axis=1)[:, 0]), start)
    open_ = np.arange(docs)
    for k in range(2, langs + 1):
        rows = np.repeat(np.isin(np.arange(docs), open_), words)
        sub_words = words[open_]
        sub_start = np.concatenate([[0], np.cumsum(sub_words)[:-1]])
        sub = np.take_along_axis(likelihood[rows], np.repeat(order[open_, :k], sub_words, axis=0), axis=1)
        part = _em(sub, sub_start, np.full((len(open_), k), 1 / k, np.float32), rounds)
        now = _loglik(sub, sub_start, part)
        better = now - fit[open_] > penalty * np.log1p(sub_words)
        open_, part, now = open_[better], part[better], now[better]
        if not len(open_):
            break
        fit[open_], chosen[open_] = now, k
        shares[open_] = 0
        shares[open_[:, None], order[open_, :k]] = part
    return shares, chosen


def identify_languages(
    docs: DataFrame, model: tuple[list[str], np.ndarray], text_column: str = "text", penalty: float = 3.0, prefix: str = "lang_"
) -> DataFrame:
    """``docs`` with ``lang_pred``, ``lang_score`` (its proportion, 0 to 1) and ``lang_set`` (chosen languages, largest first).

    A null text, one without a letter, and every text when nothing was learned, are ``und`` with score 0 and no set.
    Rows are judged one by one, so repeated rows get equal results; an empty table stays empty. Columns of ``docs``
    with these names are replaced, others are kept.
    """
    langs, table = model
    limit = max(1 << 16, SLICE_BYTES * 4 // max(4, len(langs)))
    added = [f"{prefix}pred", f"{prefix}score", f"{prefix}set"]
    kept = [c for c in docs.columns if c not in added]

    def judge(part: pa.RecordBatch) -> tuple[list, list, list]:
        data, offsets = utf8(part.column("__lowered"))
        at, gram, first = _grams(data)
        pred, score, sets = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows), [[] for _ in range(part.num_rows)]
        if not langs or not len(first):
            return pred, score, sets
        words = np.stack([np.add.reduceat(row[gram], first) for row in table], axis=1)
        doc = np.searchsorted(offsets, at[first], side="right") - 1
        rows, start = np.unique(doc, return_index=True)
        shares, chosen = mixture(words, start, penalty)
        letters = part.column("__letters").to_numpy(zero_copy_only=False)
        rank = np.argsort(-shares, axis=1, kind="stable")
        for row, share, order, k in zip(rows.tolist(), shares, rank.tolist(), chosen.tolist(), strict=True):
            if letters[row]:
                pred[row], sets[row] = langs[order[0]], [langs[x] for x in order[:k]]
                score[row] = min(1.0, float(share[order[0]]))
        return pred, score, sets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "__lowered", limit):
            pred, score, sets = judge(part)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in kept), pa.array(pred, pa.string()), pa.array(score), pa.array(sets, pa.list_(pa.string()))],
                [*kept, *added],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in kept)
    rows = docs.select(
        *[F.col(f"`{c}`") for c in kept], _lowered(text_column).alias("__lowered"),
        F.coalesce(F.col(text_column).cast("string").rlike(r"\p{L}"), F.lit(False)).alias("__letters"),
    )
    return rows.mapInArrow(tidy(run), f"{fields}, {added[0]} string, {added[1]} double, {added[2]} array<string>")


def language_id(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", folds: int = 4, fold: int = 2
) -> DataFrame:
    """(id, held_out, lang_pred, score, languages): learned from the rows outside the held-out fold that have a language."""
    out = held_out(id_column, folds, fold)
    model = fit_languages(docs.where(~out), text_column, lang_column)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), out.alias("held_out"))
    return identify_languages(rows, model).select(
        F.col("id").alias(id_column), "held_out", "lang_pred", F.col("lang_score").alias("score"), F.col("lang_set").alias("languages")
    )


def keep_known(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", least: float = 0.4, folds: int = 4, fold: int = 2) -> DataFrame:
    """The rows of ``docs`` with a language, with their columns unchanged, whatever their names. Repeated rows are judged alike.

    A text is rejected when it has no letter, or when no language holds at least ``least`` of its words. Without any labelled row nothing can be learned
    and only texts without a letter are rejected.
    """
    model = fit_languages(docs.where(~held_out(id_column, folds, fold)), text_column, lang_column)
    rows, names = numbered(docs)
    judged = identify_languages(rows, model, names[text_column], prefix="__lang_")
    fine = (F.col("__lang_pred") != UNKNOWN) & (F.col("__lang_score") >= least)
    if not model[0]:
        fine = F.coalesce(F.col(names[text_column]).rlike(r"\p{L}"), F.lit(False))
    return judged.where(fine).select(*names.values()).toDF(*docs.columns)
