"""BPE against the tokenizers library, the automaton against a dict, exact round trips."""

import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from windvane.llm import bpe  # noqa: E402
from windvane.llm.words import chunk_of  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = tokenizers.Tokenizer.from_file(PATH)
PARTS = ["a", "b", "the", " ", "  ", "\n", "\t", "'s", "'ll", "1", "23", "é", "ß", "漢", "　", "\xa0", ".", "!!", "<|endoftext|>", "<|", "\x1c", "\x85", "😀", "՘", "١", "Z", "\r\n", "́", "_"]


def encoded(docs, words=100):
    return bpe.decode(bpe.encode(docs, PATH, bpe.build_lexicon(docs, PATH, words=words)), PATH)


def same(rows, texts):
    for row in rows:
        ids = LIBRARY.encode(texts[row["doc_id"]] or "", add_special_tokens=False).ids
        assert row["ids"] == ids and row["decoded"] == LIBRARY.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("words", [0, 50, 5000])
def test_documents(small, words):
    docs = small("documents")
    same(encoded(docs, words).collect(), {r["doc_id"]: r["text"] for r in docs.collect()})


def test_awkward_texts(spark):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choice(PARTS) for _ in range(rng.randrange(16)))) for i in range(2000)]
    rows.append((2000, "abc" * 5000 + "thnt"))
    rows.append((2001, " " * 3000 + "x"))
    same(encoded(spark.createDataFrame(rows, "doc_id long, text string")).collect(), dict(rows))


def test_chunks_never_cut_a_pre_token():
    import pyarrow as pa

    rng = random.Random(2)
    model = bpe.ByteBpe(PATH)
    texts = ["".join(rng.choice([*PARTS, "\x00", " \x00a"]) for _ in range(rng.randrange(10))).replace("<|endoftext|>", "") for _ in range(3000)]
    keys, counts = model.split(pa.array(texts))
    keys = iter(keys.to_pylist())
    for text, n in zip(texts, counts.tolist(), strict=True):
        want = [text[a:b] for _, (a, b) in LIBRARY.pre_tokenizer.pre_tokenize_str(text)]
        assert [w for _ in range(n) for w in model.words(chunk_of(next(keys)))] == want


def test_transducer():
    rng = random.Random(4)
    words = {"".join(rng.choice("ab") for _ in range(rng.randrange(9))).encode(): [rng.randrange(9) for _ in range(rng.randrange(4))] for _ in range(200)}
    found = bpe.Transducer(bpe.Transducer.compiled(words))
    asked = [*sorted(words), b"abababababab", b"c", b"ac"]
    places = found.places(asked).tolist()
    assert places == [*range(len(words)), -1, -1, -1]
    assert [found.ids[found.start[p] : found.start[p + 1]].tolist() for p in places[: len(words)]] == [words[w] for w in sorted(words)]


def test_transducer_is_minimal():
    """Suffixes are shared: the words x + y over all pairs need one state per remaining length, not one per word."""
    words = {(a + b + "ing").encode(): [1] for a in "abcdefgh" for b in "abcdefgh"}
    assert len(bpe.Transducer(bpe.Transducer.compiled(words)).final) == 6
    empty = bpe.Transducer(bpe.Transducer.compiled({}))
    assert empty.places([b"", b"a"]).tolist() == [-1, -1]


def test_odd_rows(odd, none):
    rows = encoded(odd).collect()
    assert len(rows) == odd.count()
    same(rows, {r["doc_id"]: r["text"] for r in odd.collect()})
    assert encoded(none).count() == 0
    assert {r["ids"] == [] for r in rows if r["doc_id"] in (2, 3)} == {True}
