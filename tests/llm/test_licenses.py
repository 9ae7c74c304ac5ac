"""License phrases against plain code; notices with planted edits."""

import random
import re

import pytest

from windvane.llm.licenses import NOTICES, PHRASES, license_scan, pieces

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def base(text):
    words = WORD.findall(lowered(text))
    places = [
        (i, label) for phrase, label in PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()
    ]
    at = [i for i, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), sorted({x for _, x in places})


def same(rows, texts):
    for row in rows:
        want = base(texts[row["doc_id"]] or "")
        assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"]) == want
        assert set(row["base_labels"]) <= set(row["labels"]) == set(row["base_labels"]) | {s["label"] for s in row["spans"]}
        assert 0 <= row["score"] <= 1 and (row["score"] == 1) >= (row["n_base"] > 0) and (row["score"] > 0) == bool(row["labels"])


def test_against_plain_code(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    same(license_scan(docs).collect(), {r["doc_id"]: r["text"] for r in docs.collect()})


def test_awkward_texts(spark):
    rng = random.Random(1)
    parts = ["gnu", "GNU", "general", "public", "license", "License", "apache", "cc", "by", "mit", " ", "-", "\n", "é", "\x7f", "x", ", ", "MIT License", "CC BY", "😀", "\x00"]
    rows = [(i, "".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randrange(20)))) for i in range(600)]
    rows += [(600, "mit"), (601, "license mit"), (602, "license"), (603, "gnu general public\nlicense"), (604, "MIT\tLicense" * 300), (605, "émit license"), (606, "mit licenseé")]
    same(license_scan(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect(), dict(rows))


@pytest.mark.parametrize("edits", [0, 1, 2])
def test_planted_edits(spark, edits):
    rng = random.Random(edits)
    rows, want = [], {}
    for i in range(120):
        label, notice, allowed = rng.choice(NOTICES)
        if allowed < edits:
            continue
        text = list(notice)
        for _ in range(edits):
            at = rng.randrange(1, len(text) - 1)
            kind = rng.randrange(3)
            if kind == 0:
                text[at] = "§"
            elif kind == 1:
                text.insert(at, "é")
            else:
                del text[at]
        before = "ünd thé " * rng.randrange(4)
        rows.append((i, before + "".join(text).capitalize() + " end"))
        want[i] = (label, len(before), edits)
    for row in license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        label, start, n = want[row["doc_id"]]
        mine = [s for s in row["spans"] if s["label"] == label]
        assert mine and min(s["edits"] for s in mine) <= n and abs(min(s["start"] for s in mine) - start) <= n
        assert row["score"] > 0.8


def test_pieces_cover_the_notice():
    for _, notice, edits in NOTICES:
        found = pieces(notice, edits)
        assert "".join(p for _, p in found) == notice and len(found) == edits + 1 and min(len(p) for _, p in found) >= 6
        assert all(notice[a : a + len(p)] == p for a, p in found)


def test_plain_prose_has_no_label(spark):
    rows = [(1, "The committee will release the list under the new rules and the mitigation of the licensee."), (2, "licen sed under"), (3, "general public opinion")]
    assert {tuple(r["labels"]) for r in license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {()}


def test_odd_rows(odd, none):
    rows = license_scan(odd).collect()
    assert len(rows) == odd.count()
    same(rows, {r["doc_id"]: r["text"] for r in odd.collect()})
    assert license_scan(none).count() == 0
