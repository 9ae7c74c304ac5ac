"""SimHash and the trie self-join against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from windvane.llm.simhash import _pages, fingerprint_links, first_of_groups, simhash64, simhash_near_dups, trie_links


def brute(fps, max_bits=4):
    """Smallest index reachable from each fingerprint."""
    label = list(range(len(fps)))
    changed = True
    near = [[j for j in range(len(fps)) if (fps[i] ^ fps[j]).bit_count() <= max_bits] for i in range(len(fps))]
    while changed:
        new = [min(label[j] for j in near[i]) for i in range(len(fps))]
        changed, label = new != label, new
    return label


def clustered(n, seed=0):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(max(1, n // 6))]
    out = set()
    while len(out) < n:
        x = rng.choice(centres)
        for _ in range(rng.randrange(7)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out)


def plain_simhash(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", ["", " \n", "one", "A b C", "a b c d", "a b c d e a b c d", "É é\x1cx ÀB\x85y z\xa0w v u", "w " * 70000])
def test_fingerprint(text):
    assert simhash64(text.encode()) == plain_simhash(text)


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3, 4, 5, 8])
def test_links_of_one_page(max_bits):
    keys = np.array(clustered(300, max_bits), np.uint64)
    got = {(int(i), int(j)) for a, b in trie_links(keys, None, max_bits) for i, j in zip(a, b, strict=True)}
    # one trie finds the pairs whose first half holds at most half of the budget
    want = {
        (i, j) for i in range(300) for j in range(i + 1, 300)
        if (int(keys[i]) ^ int(keys[j])).bit_count() <= max_bits and (int(keys[i]) >> 32 ^ int(keys[j]) >> 32).bit_count() <= max_bits // 2
    }
    assert want <= got and all((int(keys[i]) ^ int(keys[j])).bit_count() <= max_bits and i < j for i, j in got)


def test_pages_are_trie_nodes():
    keys = np.array(clustered(500, 9), np.uint64)
    pages = list(_pages(keys, 16))
    assert np.concatenate(pages).tolist() == keys.tolist() and max(map(len, pages)) <= 16


@pytest.mark.parametrize("page_keys", [4, 64, 8192])
def test_links_over_pages(spark, page_keys):
    fps = clustered(400, 5)
    signed = [f - (1 << 64) if f >= 1 << 63 else f for f in fps]
    edges = fingerprint_links(spark.createDataFrame([(f,) for f in signed], "fp long"), 4, page_keys).collect()
    at = {f: i for i, f in enumerate(signed)}
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for e in edges:
        a, b = root(at[e["u"]]), root(at[e["v"]])
        label[max(a, b)] = min(a, b)
    assert [root(i) for i in range(len(fps))] == brute(fps)


def test_components(spark, small):
    docs = small("documents")
    out = {r["doc_id"]: r for r in simhash_near_dups(docs).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids = sorted(texts)
    fps = [plain_simhash(texts[i] or "") for i in ids]
    label = brute(fps)
    assert [out[i]["fingerprint"] for i in ids] == [f"{f:016x}" for f in fps]
    assert [out[i]["component_id"] for i in ids] == [ids[k] for k in label]


def test_dense_group(spark):
    """Many copies of one text and many that differ in a word are one component."""
    rng = random.Random(1)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    rows = [(i, " ".join(base)) for i in range(300)]
    for i in range(300, 600):
        words = list(base)
        words[rng.randrange(400)] = f"v{i}"
        rows.append((i, " ".join(words)))
    out = simhash_near_dups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    fps = [int(r["fingerprint"], 16) for r in sorted(out, key=lambda r: r["doc_id"])]
    assert [r["component_id"] for r in sorted(out, key=lambda r: r["doc_id"])] == brute(fps)


def test_odd_rows(odd, none):
    rows = simhash_near_dups(odd).collect()
    assert len(rows) == odd.count()
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows}
    assert got[2] == got[3] == got[4] == ("0" * 16, 2)
    assert got[9] == (got[10][0], 9) and got[10][1] == 9
    assert simhash_near_dups(none).count() == 0
    assert simhash_near_dups(odd.where("doc_id is null")).collect()[0]["component_id"] is None


def test_first_of_groups(spark, odd, none, tmp_path):
    odd.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    kept = first_of_groups(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert sorted(ids, key=str) == sorted([1, 2, 5, 6, 7, 8, 9, None, 11], key=str)
    assert first_of_groups(none).count() == 0
    assert first_of_groups(docs.withColumn("doc_id", F.lit(None).cast("long"))).count() == 9
