"""Voting rules: counts against plain code, estimation of accuracies, odd rows."""

import random
import re
from collections import Counter


from windvane.llm.rules import RULES, estimate, keep_good, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
    }


def same(rows, texts):
    for row in rows:
        want = counts(texts[row["doc_id"]] or "")
        assert {k: row[k] for k in want} == want
        failed = want["n_words"] < 20 or 100 * want["n_repeat_words"] > 30 * want["n_words"]
        assert row["base_failed"] == failed and not (failed and row["kept"])
        assert row["kept"] == (not failed and row["posterior"] >= 0.5)


def test_against_plain_code(small):
    docs = small("documents")
    same(quality_rules(docs).collect(), {r["doc_id"]: r["text"] for r in docs.collect()})


def test_windows_that_repeat(spark):
    rng = random.Random(5)
    rows = []
    for i in range(60):
        words = [rng.choice("abc") for _ in range(rng.randrange(60))]
        rows.append((i, "".join(w + rng.choice([" ", "  ", "\n", "\t\n", "\x0b"]) for w in words)))
    rows.append((60, "a b c d e f g h " * 3000))
    rows.append((61, "É ü\x85x 漢字 😀\x1cq"))
    same(quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect(), dict(rows))


def test_estimation_finds_the_accuracies():
    """Votes drawn from known accuracies, with abstentions and one rule that guesses."""
    rng = random.Random(2)
    good, bad = [0.98, 0.95, 0.9, 0.9, 0.6], [0.9, 0.8, 0.7, 0.5, 0.5]
    patterns, truth = Counter(), Counter()
    for _ in range(20000):
        y = rng.random() < 0.8
        votes = ""
        for a, b in zip(good, bad, strict=True):
            right = rng.random() < (a if y else b)
            votes += "0" if rng.random() < 0.2 else ("2" if right == y else "1")
        patterns[votes] += 1
        truth[votes, y] += 1
    found = estimate(patterns, 5, 100)
    assert abs(found.prior - 0.8) < 0.04
    assert max(abs(a - b) for a, b in zip(found.good[:4], good, strict=False)) < 0.05
    assert max(abs(a - b) for a, b in zip(found.bad[:4], bad, strict=False)) < 0.1
    assert found.bad[0] > found.bad[3]


def test_estimation_without_documents():
    found = estimate({}, 3)
    assert found.good == [0.9] * 3 and found.bad == [0.4] * 3


def test_junk_is_rejected_and_clean_texts_stay(spark, small):
    docs, labels = small("documents"), small("labels")
    out = quality_rules(docs).join(labels, "doc_id")
    clean = out.where("quality = 1 and not base_failed")
    assert clean.where("not kept").count() <= 0.02 * clean.count()
    assert out.where("quality = 0 and kept").count() <= 0.2 * out.where("quality = 0").count()


def test_odd_rows(odd, none):
    texts = {r["doc_id"]: r["text"] for r in odd.collect()}
    rows = quality_rules(odd).collect()
    assert len(rows) == odd.count()
    same(rows, texts)
    assert all(len(r["votes"]) == len(RULES) for r in rows)
    assert {r["votes"] for r in rows if r["doc_id"] in (2, 3, 4)} == {"0" * len(RULES)}
    assert quality_rules(none).count() == 0
    kept = keep_good(odd)
    want = sorted((str(r["doc_id"]) for r in rows if r["kept"]))
    assert kept.columns == odd.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == want
    assert {r["kept"] for r in kept.select("kept").collect()} <= {"clash"}
    assert keep_good(none).count() == 0


def test_no_python_in_the_plan(odd):
    plan = quality_rules(odd)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
