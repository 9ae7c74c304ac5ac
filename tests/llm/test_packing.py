"""Packing: every id once, gapless sequences, no padding, neighbours by shared words."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from windvane.llm import packing  # noqa: E402
from windvane.llm.packing import Index, fill, pack  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = tokenizers.Tokenizer.from_file(PATH)


def ids(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]


def whole(rows, texts, window=2048):
    """``texts``: (id, text) of all documents; ids may repeat."""
    by_sequence = defaultdict(list)
    pieces = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
        assert len(r["ids"]) == r["length"] > 0 and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= window and end & (end - 1) == 0  # full, or a power of two: nothing is padded
    want = defaultdict(list)
    for key, text in texts:
        want[key].append(tuple(ids(text)))
    for key, lists in want.items():
        mine = sorted(pieces[key], key=lambda r: (r["start"], r["length"]))
        assert sum(r["length"] for r in mine) == sum(map(len, lists))
        if len(lists) == 1:
            joined, end = [], 0
            for r in mine:
                assert r["start"] == end and r["doc_tokens"] == len(lists[0])
                joined, end = joined + list(r["ids"]), end + r["length"]
            assert tuple(joined) == lists[0]
        else:
            assert {i for r in mine for i in r["ids"]} == {i for x in lists for i in x}
    assert set(pieces) == set(want)


@pytest.mark.parametrize("window,shard_docs", [(2048, 4096), (256, 32)])
def test_documents(small, window, shard_docs):
    docs = small("documents")
    whole(pack(docs, PATH, window=window, shard_docs=shard_docs).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()], window)


def test_awkward_texts(spark):
    rng = random.Random(1)
    parts = ["a", "The", " ", "\n", "\t", "'s", "'LL", "12", "é", "É", "É", "İ", "漢", "　", "\xa0", "...", "!'s", "<|endoftext|>", "<|startoftext|>", "<|", "\x1c", "\x85", "😀", "Σ", "ΑΣ ", "ǆ", "́", "²"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(14)))) for i in range(1500)]
    rows.append((1500, "word " * 20000))
    whole(pack(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect(), rows)


def test_ids_may_be_left_out(small):
    assert pack(small("documents"), PATH, with_ids=False).where("ids is not null").count() == 0


def test_neighbours_share_words():
    words = [[1, 2, 3, 9], [4, 5, 6, 9], [1, 2, 7, 9], [4, 5, 8, 9], [1, 9, 9, 9], [10, 11, 12, 13]]
    index = Index(np.array([w for d in words for w in d], np.int32), np.array([4] * 6))
    free = lambda *used: np.isin(np.arange(6), used)
    assert index.neighbours(0, free(0))[:2] == [2, 4]
    assert index.neighbours(1, free(1))[0] == 3
    assert index.neighbours(5, free(5)) == []
    assert 2 not in index.neighbours(0, free(0, 2))


def test_scores_are_bm25():
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 12, rng.integers(1, 20)) for _ in range(30)]
    index = Index(np.concatenate(docs).astype(np.int32), np.array([len(d) for d in docs]), query_words=99)
    mean = np.mean([len(d) for d in docs])
    for seed in range(30):
        scores = []
        for d in docs:
            total = 0.0
            for w in set(docs[seed].tolist()):
                df, tf = sum(w in x for x in docs), int((d == w).sum())
                if df > 1 and tf:
                    total += np.log1p((30 - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean))
            scores.append(total)
        used = np.zeros(30, bool)
        used[seed] = True
        got = index.neighbours(seed, used)
        want = [scores[d] for d in sorted((d for d in range(30) if scores[d] > 0 and d != seed), key=lambda d: -scores[d])]
        assert np.allclose([scores[d] for d in got], want)


def test_neighbours_fill_the_window_of_the_seed():
    words = [[1, 2], [7, 8], [1, 2], [7, 8], [5, 6], [5, 6]]
    index = Index(np.array([w for d in words for w in d], np.int32), np.array([2] * 6))
    rows, sequences = fill(np.array([4] * 6), index, 8)
    assert sequences == 3 and rows[:, 0].tolist() == [0, 2, 1, 3, 4, 5]
    rows, sequences = fill(np.array([5, 5, 5]), Index(np.array([1, 1, 2], np.int32), np.array([1, 1, 1])), 8)
    assert rows.tolist() == [[0, 0, 5, 0, 0], [1, 0, 3, 0, 5], [1, 3, 2, 1, 0], [2, 0, 2, 1, 2], [2, 2, 2, 2, 0], [2, 4, 1, 3, 0]] and sequences == 4


@pytest.mark.parametrize("number,words,longest", [(30, 60, 80), (300, 400, 120)])
def test_scores_are_bm25_of_all_shared_words(number, words, longest):
    rng = np.random.default_rng(2)
    docs = [np.minimum(rng.zipf(1.3, rng.integers(30, longest)), words) for _ in range(number)]
    index = Index(np.concatenate(docs).astype(np.int32), np.array([len(d) for d in docs]))
    tf = np.array([np.bincount(d, minlength=words + 1) for d in docs])
    df, length = (tf > 0).sum(axis=0), tf.sum(axis=1)
    weight = np.log1p((number - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length[:, None] / length.mean())) * (df > 1)
    for seed in range(0, number, 7):
        assert (df[tf[seed] > 0] > 1).sum() > 5
        scores = weight[:, tf[seed] > 0].sum(axis=1)
        used = np.zeros(number, bool)
        used[[seed, 3]] = True
        want = [d for d in np.argsort(-scores, kind="stable") if scores[d] > 0 and not used[d]]
        got = index.neighbours(seed, used)
        assert sorted(got) == sorted(want) and np.allclose(scores[got], scores[want])


def test_statistics_are_those_of_all_documents():
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 12, rng.integers(1, 20)) for _ in range(40)]
    held, n = np.unique(np.concatenate([np.unique(d) for d in docs]), return_counts=True)
    mean = np.mean([len(d) for d in docs])
    part = docs[:15]
    index = Index(np.concatenate(part).astype(np.int32), np.array([len(d) for d in part]), of_all=(40, mean, held, n))
    words = np.repeat(np.unique(np.concatenate(part)), index.size)
    for word, doc, weight in zip(words.tolist(), index.doc.tolist(), index.weight.tolist(), strict=True):
        df, tf = sum(word in d for d in docs), int((part[doc] == word).sum())
        assert weight == pytest.approx(np.log1p((40 - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(part[doc]) / mean)))


def test_related_documents_meet_wherever_they_are_read(spark):
    rng = random.Random(3)
    common = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    rows = [(100 * part + topic, f"topic{topic}x " + " ".join(rng.choices(common, k=12))) for part in range(4) for topic in range(40)]
    frame = spark.createDataFrame(spark.sparkContext.parallelize(rows, 4), "doc_id long, text string")
    out = pack(frame, PATH, window=64, shard_docs=16).collect()
    whole(out, rows, 64)
    tasks = defaultdict(set)
    for r in out:
        tasks[r["doc_id"] % 100].add(r["sequence_id"] >> 32)
    assert len(tasks) == 40 and all(len(t) == 1 for t in tasks.values())


@pytest.mark.parametrize("key_words", [0, 5])
def test_rare_words_are_counted_beside_the_frequent_ones(spark, small, monkeypatch, key_words):
    monkeypatch.setattr(packing, "KEY_WORDS", key_words)
    plain = small("documents")
    whole(pack(plain, PATH, window=256, shard_docs=32).collect(), [(r["doc_id"], r["text"]) for r in plain.collect()], 256)


def test_a_hot_word_is_dealt_over_several_shards():
    words, counts = np.full(1000, 7, np.int32), np.ones(1000, np.int64)
    names = packing.shard_names(words, counts, np.full(1000, 1000), 50, 100, np.arange(1000))
    assert len(set(names.tolist())) > 5 and np.bincount(names).max() <= 400
    alone = packing.shard_names(words[:60], counts[:60], np.full(60, 60), 50, 100, np.arange(60))
    assert len(set(alone.tolist())) == 1


def test_words_of_many_ids(spark):
    rng = random.Random(5)
    rows = [(i, " ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz0123456789") for _ in range(n)) for n in (3, 255, 900, 1, 2000))) for i in range(3)]
    whole(pack(spark.createDataFrame(rows, "doc_id long, text string"), PATH, window=256).collect(), rows, 256)
    sizes = np.array([3, 255, 0, 700, 510, 254])
    assert list(packing._lengths(sizes, np.array([2, 0, 4]))[2].as_py()) == [0, 255, 255, 190, 255, 255, 0, 254]


def test_odd_rows(odd, none):
    rows = pack(odd, PATH).collect()
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    whole(rows, texts)
    assert [list(r["ids"]) for r in rows if r["doc_id"] == 2] == [[1]]
    assert pack(none, PATH).count() == 0
    with pytest.raises(ValueError):
        pack(odd, PATH, window=1000)
