"""Token counts against the sentencepiece library."""

import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

from windvane.llm import pieces  # noqa: E402
from windvane.llm.words import chunk_of  # noqa: E402

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
PARTS = ["a", "b", "the", " ", "  ", "\n", "\t", "'s", "1", "23", "é", "ß", "漢", "　", "\xa0", ".", "!!", "<s>", "</s>", "<unk>", "\x1c", "😀", "▁", "١", "Z", "\r\n", "́", "«", "”", "²", "Ж", "-"]


def same(rows, texts):
    for row in rows:
        text = texts[row["doc_id"]] or ""
        n = len(LIBRARY.encode(text))
        assert (row["n_bytes"], row["n_tokens"], row["over_limit"]) == (len(text.encode()), n, n > 4096)


@pytest.mark.parametrize("frequent", [0, 100, 1 << 18])
def test_documents(small, frequent):
    docs = small("documents")
    same(pieces.token_counts(docs, PATH, frequent=frequent).collect(), {r["doc_id"]: r["text"] for r in docs.collect()})


def test_awkward_texts(spark):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choice(PARTS) for _ in range(rng.randrange(16)))) for i in range(3000)]
    rows += [(3000, "ab" * 30000), (3001, "the " * 30000), (3002, " " * 5000)]
    same(pieces.token_counts(spark.createDataFrame(rows, "doc_id long, text string"), PATH, frequent=20).collect(), dict(rows))


def test_pieces_of_words_add_up():
    import pyarrow as pa

    rng = random.Random(2)
    texts = ["".join(rng.choice([*PARTS, "\x00", " \x00a"]) for _ in range(rng.randrange(12))) for _ in range(5000)]
    keys, counts = pieces.split(pa.array(texts))
    keys = iter(keys.to_pylist())
    for text, n in zip(texts, counts.tolist(), strict=True):
        words = [w for _ in range(n) for w in pieces.pre_tokens(chunk_of(next(keys)))]
        assert (pieces.count_pieces(PATH, words).sum() if words else 0) == len(LIBRARY.encode(text))


def test_each_distinct_word_once(small):
    table = pieces.piece_table(small("documents"), PATH)
    assert table.count() == table.select("word").distinct().count()


def test_odd_rows(odd, none):
    rows = pieces.token_counts(odd, PATH).collect()
    assert len(rows) == odd.count()
    same(rows, {r["doc_id"]: r["text"] for r in odd.collect()})
    assert pieces.token_counts(none, PATH).count() == 0
