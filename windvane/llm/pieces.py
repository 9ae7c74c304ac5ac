"""Token counts by counting the pieces of each distinct pre-token once.

For a SentencePiece BPE model whose pieces never hold a space after another character and never mix Latin
letters with other characters, no merge crosses such a border, so a text's count is the sum over its pre-tokens. Pre-tokens
are counted over the corpus and the library counts the pieces of each distinct one; documents then add up
frequency times pieces. The most frequent pre-tokens go to all tasks as a table of bounded size; the others
are joined by word, so no table grows with the corpus and no word is hot in the join. Ids of texts are never made.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windvane.llm.common import text_slices, tidy, worker_cache
from windvane.llm.words import TABLE_WORDS, WordTable, chunk_of, most_frequent, split_keys, spread, sums, word_counts
from windvane.session import cut_lineage

FREQUENT = 1 << 18  # pre-tokens sent to all tasks, each of at most FREQUENT_CHARS characters
FREQUENT_CHARS = 32
SPACE = "▁"  # the model's own sign for a space
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"  # Latin; all other characters are the other kind
_CUT = re.compile(f" *[{_LETTERS}]+| *[^ {_LETTERS}]+| +")
_ODD = "  |^ | $|^$"  # texts that are not cut at their spaces alone


def _processor(path: str):
    models = worker_cache("sentencepiece")
    if path not in models:
        import sentencepiece

        models[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return models[path]


def separable(path: str) -> bool:
    """True when no piece of the model crosses a border between pre-tokens."""
    model = _processor(path)
    letter = re.compile(f"[{_LETTERS}]")
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i) or model.is_control(i) or model.is_unknown(i):
            continue
        body = piece.lstrip(SPACE)
        kinds = {bool(letter.match(c)) for c in body}
        if SPACE in body or len(kinds) > 1 or "\n" in piece:
            return False
    return model.encode(" ", out_type=str) == [SPACE * 2] and model.encode("\n", out_type=str) == [SPACE, "<0x0A>"]


def split(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Keys of chunks, see :func:`split_keys`; the model puts a space before a text, and its own sign for a space is one."""
    return split_keys(pc.replace_substring(column, SPACE, " "), _ODD, lambda text: pre_tokens(" " + text) if text else [], spaced=True)


def pre_tokens(chunk: str) -> list[str]:
    body = chunk[1:] if chunk[:1] == " " else chunk
    return [chunk] if body.isascii() and body.isalpha() else _CUT.findall(chunk)


def count_pieces(path: str, words: list[str]) -> np.ndarray:
    """Pieces of each pre-token. The library puts a space before a text: it stands for the word's own, or is cut off by a line end."""
    model = _processor(path)
    asked = [w[1:] if w[0] == " " else "\n" + w for w in words]
    found = zip(words, model.encode(asked, num_threads=1), strict=True)
    return np.array([1 if w == " " else len(ids) - (w[0] != " ") * 2 for w, ids in found], np.int32)


def piece_table(docs: DataFrame, path: str, text_column: str = "text") -> DataFrame:
    """(word, n, pieces) for every distinct pre-token of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            for at in range(0, len(words), 4096):
                part = batch.slice(at, 4096)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(count_pieces(path, words[at : at + 4096]))], ["word", "n", "pieces"]
                )

    return word_counts(docs, text_column, split, pre_tokens).mapInArrow(tidy(run), "word string, n long, pieces int")


def token_counts(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", limit: int = 4096, frequent: int = FREQUENT
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row.

    Null and empty texts have no token; repeated rows are counted alike; an empty table gives an empty result; other columns
    are not read. Strings that look like special tokens are ordinary text, as the library's default is.
    """
    if not separable(path):
        raise ValueError("pieces of this model cross the borders of words; count it with the library")
    table = cut_lineage(piece_table(docs, path, text_column))
    top = most_frequent(table.where(F.length("word") <= FREQUENT_CHARS), frequent).select("word", "pieces").toPandas()
    known_words, known_pieces = top["word"].to_numpy(object), top["pieces"].to_numpy(np.int32)
    shared = docs.sparkSession.sparkContext.broadcast((known_words, known_pieces))  # at most frequent * FREQUENT_CHARS characters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = dict(zip(*(x.tolist() for x in shared.value), strict=True))
        rare: list[str] = []  # number of a word that is joined, per chunk table

        def resolve(new: list[str]) -> tuple[list[int], list[int]]:
            """Pieces of the frequent words of a chunk, then its other words as numbers."""
            sizes, numbers = [], []
            for chunk in new:
                total, others = 0, []
                for word in pre_tokens(chunk_of(chunk)):
                    n = known.get(word)
                    if n is None:
                        others.append(len(rare))
                        rare.append(word)
                    else:
                        total += n
                sizes.append(1 + len(others))
                numbers += [total, *others]
            return sizes, numbers

        chunk_table = WordTable(resolve)
        for part in text_slices(batches, "text"):
            if len(chunk_table.index) > TABLE_WORDS - 100_000:  # before the table thins itself out, which would not renumber the rare words
                rare.clear()
                chunk_table.clear()
            words, counts = split(part.column("text"))
            rows = chunk_table.rows_of(words)
            ids, keys = part.column("id"), part.column("key").to_numpy()
            base = sums(chunk_table.flat[chunk_table.start[rows]].astype(np.int64), counts)
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), ids, part.column("n_bytes"), pa.array(base), pa.array([str(k) for k in keys]),
                 pa.array(np.zeros(len(keys), np.int32)), pa.array(np.ones(len(keys), np.int64))],
                ["key", "id", "n_bytes", "tokens", "word", "kind", "freq"],
            )
            more = chunk_table.size[rows] - 1
            some = np.flatnonzero(more)
            other = chunk_table.flat[spread(chunk_table.start[rows[some]] + 1, more[some])].astype(np.int64)
            doc = np.repeat(np.repeat(np.arange(len(counts)), counts)[some], more[some])
            pairs, freq = np.unique(doc << 32 | other, return_counts=True)
            doc = pairs >> 32
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[doc]), ids.take(pa.array(doc)), pa.nulls(len(doc), pa.int64()), pa.nulls(len(doc), pa.int64()),
                 pa.array([rare[x] for x in (pairs & 0xFFFFFFFF).tolist()], pa.string()), pa.array(np.ones(len(doc), np.int32)),
                 pa.array(freq.astype(np.int64))],
                ["key", "id", "n_bytes", "tokens", "word", "kind", "freq"],
            )

    texts_ = F.col(text_column).cast("string")
    rows = docs.select(
        F.monotonically_increasing_id().alias("key"), F.col(id_column).alias("id"),
        F.coalesce(F.octet_length(texts_), F.lit(0)).cast("long").alias("n_bytes"), texts_.alias("text"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    counted = rows.mapInArrow(tidy(run), f"key long, id {kind}, n_bytes long, tokens long, word string, kind int, freq long")
    # rows of kind 0 are the documents themselves, with a word of their own; rows of kind 1 are rare words
    joined = counted.join(table.select("word", "pieces", F.lit(1).alias("kind")), ["word", "kind"], "left")
    return (
        joined.groupBy("key")
        .agg(
            F.min("id").alias(id_column),
            F.max("n_bytes").alias("n_bytes"),
            F.sum(F.coalesce("tokens", F.col("freq") * F.col("pieces"))).cast("long").alias("n_tokens"),
        )
        .select(id_column, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
