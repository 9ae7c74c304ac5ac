"""Language mixtures: accuracy on rows that were not learned from, proportions, odd rows."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from windvane.llm.languages import fit_languages, gram_counts, identify_languages, keep_known, language_id, mixture


def test_held_out(spark, small):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language_id(docs).join(docs.select("doc_id", "lang"), "doc_id")
    assert out.count() == docs.count()
    right = out.where("held_out").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0]
    assert right > 0.97
    rows = out.select("doc_id", "held_out", "score").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)


def test_lang_and_source_of_the_held_out_fold_are_not_used(small):
    docs = small("documents")
    changed = docs.withColumn("source", F.lit("x")).withColumn(
        "lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, "xx").otherwise(F.col("lang"))
    )
    pick = lambda d: {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id(d).collect()}
    assert pick(docs) == pick(changed)


def test_counts_cover_every_word(spark):
    docs = spark.createDataFrame([("ab c", "x"), ("ÀB c", "x"), ("zz", "y"), ("q", None), (None, "x")], "text string, lang string")
    totals = {r["lang"]: r["n"] for r in gram_counts(docs, "text", "lang").groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    assert totals == {"x": 3 + 4, "y": 2}  # one n-gram for each letter byte


def test_mixture_estimates_proportions():
    """Words drawn from known mixtures: EM finds the proportions and the penalty the set."""
    rng = np.random.default_rng(0)
    wanted = [[1, 0, 0], [0.7, 0.3, 0], [0.4, 0.35, 0.25]]
    parts, start = [], [0]
    for shares in wanted:
        source = rng.choice(3, 600, p=shares)
        rows = rng.normal(-12, 0.5, (600, 3))
        rows[np.arange(600), source] += 4
        parts.append(rows)
        start.append(start[-1] + 600)
    shares, chosen = mixture(np.concatenate(parts).astype(np.float32), np.array(start[:-1]))
    assert chosen.tolist() == [1, 2, 3] and np.abs(shares - wanted).max() < 0.05


def test_two_languages_in_one_text(spark, small):
    model = fit_languages(small("documents"))
    pick = {r["lang"]: r["text"] for r in small("documents").where("length(text) > 3000").collect()}
    half = lambda a, b: pick[a][:2000] + "\n" + pick[b][:1000]
    out = identify_languages(spark.createDataFrame([(half("en", "de"),), (half("de", "fr"),)], "text string"), model).collect()
    assert [r["lang_pred"] for r in out] == ["en", "de"]
    assert [set(r["lang_set"]) for r in out] == [{"en", "de"}, {"de", "fr"}]
    assert all(0.5 < r["lang_score"] < 0.8 for r in out)


def test_odd_rows(odd, none):
    rows = language_id(odd).collect()
    assert len(rows) == odd.count()
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows}
    assert {got[i] for i in (2, 3, 4, 11)} == {("und", 0.0)}
    assert all(got[i][0] in ("en", "es") and 0 < got[i][1] <= 1 for i in (1, 5, 6, 7, 8, 9, 10))
    assert language_id(none).count() == 0
    assert {r["lang_pred"] for r in language_id(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_keep_known(odd, none):
    kept = keep_known(odd)
    assert kept.columns == odd.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, 5, 6, 7, 8, 9, 10, None}
    assert {r["lang_pred"] for r in kept.collect()} == {"clash"}
    assert keep_known(none).count() == 0
    assert keep_known(odd.withColumn("lang", F.lit(None).cast("string"))).count() == kept.count()
