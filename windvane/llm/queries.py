"""The registered queries of this subpackage and their SQL statements."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windvane.llm import bpe, codes
from windvane.llm.common import load
from windvane.llm.languages import language_id
from windvane.llm.licenses import license_scan
from windvane.llm.negatives import hard_negatives
from windvane.llm.packing import pack
from windvane.llm.pieces import token_counts
from windvane.llm.quality import quality_scores
from windvane.llm.rules import quality_rules
from windvane.llm.secrets import secret_scan
from windvane.llm.simhash import simhash_near_dups
from windvane.llm.toxicity import toxicity_scores
from windvane.llm.vectors import vector_near_dups
from windvane.session import cut_lineage, few_rows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(make: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = make
        if sql is not None:
            SQL[name] = sql
        return make

    return register


@query("op1_quality_scores")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"), folds=5, fold=0, cut=0.3)


@query("op2_simhash_near_dups")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near_dups(load(spark, sf_dir, "documents"), "doc_id", "text", shingle=4, max_bits=4)


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(load(spark, sf_dir, "documents"), "doc_id", "text", "lang", folds=4, fold=2)


@query(
    "op4_vector_near_dups",
    """
    WITH RECURSIVE fit AS (
      SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS (
      SELECT a.vec_id AS u, b.vec_id AS v FROM fit a JOIN fit b
      ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
      WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
    reach(u, v) AS (
      SELECT vec_id, vec_id FROM embeddings
      UNION SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v),
    least AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u),
    counted AS (SELECT u, count(*) AS n FROM links GROUP BY u)
    SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, l.component_id, e.vec_id = l.component_id AS kept
    FROM embeddings e JOIN least l ON l.u = e.vec_id LEFT JOIN counted c ON c.u = e.vec_id
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_near_dups(load(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label", cosine=0.93)


@query("op5_quality_rules")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(load(spark, sf_dir, "documents"), "doc_id", "text")


@query("op6_secret_scan")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(load(spark, sf_dir, "documents"), "doc_id", "text")


@query("op7_bpe_round_trip")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = load(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json")
    encoded = bpe.encode(docs, path, bpe.build_lexicon(docs, path), "doc_id", "text")
    return bpe.decode(encoded, path, "ids", "decoded").select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op8_license_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(load(spark, sf_dir, "documents"), "doc_id", "text")
    lists = [F.array_join(c, ",").alias(c) for c in ("base_labels", "labels")]
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", *lists, "score", "spans")


@query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), "doc_id", "text", window=2048, end=1, with_ids=False).drop("ids")


@query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(load(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), "doc_id", "text", limit=4096)


_GRID_SQL = """usable AS (
      SELECT vec_id, label, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)::BIGINT) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""


@query(
    "op11_hard_negatives",
    f"""
    WITH {_GRID_SQL},
    fit AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, v FROM usable WHERE label IS NOT NULL),
    scored AS (
      SELECT a.vec_id AS anchor, b.vec_id AS id, a.label = b.label AS same, list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM fit a JOIN fit b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
    positives AS (SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5),
    ranked AS (
      SELECT p.anchor, p.id AS positive, p.score AS ps, n.id, n.score,
        row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY n.score DESC, n.id) AS place
      FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
    SELECT anchor AS anchor_id, positive AS positive_id, place::INT AS rank, id AS negative_id, ps AS positive_score, score AS negative_score
    FROM ranked WHERE place <= 3
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = load(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives(vectors, F.col("id") % 50 == 0, positives=5, negatives=3, low=50, high=95)


def _books_sql(rounds: int) -> str:
    """The codebook after each round: c0, c1, ..., and the assignment d<n> to codebook n."""
    steps = []
    for n in range(rounds + 1):
        steps.append(
            f"""d{n} AS (
      SELECT w.vec_id, w.part, w.v, c.entry, list_sum(list_transform(list_zip(w.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS far
      FROM cells w JOIN c{n} c USING (part) QUALIFY row_number() OVER (PARTITION BY w.vec_id, w.part ORDER BY far, c.entry) = 1)"""
        )
        if n < rounds:
            steps.append(
                f"""m{n} AS (
      SELECT part, entry, j, (sum(x) - (sum(x) % count(*) + count(*)) % count(*)) // count(*) AS mean
      FROM (SELECT part, entry, unnest(range(1, len(v) + 1)) AS j, unnest(v) AS x FROM d{n}) GROUP BY ALL),
    c{n + 1} AS (
      SELECT c.part, c.entry, coalesce(m.v, c.v) AS v FROM c{n} c
      LEFT JOIN (SELECT part, entry, list(mean::BIGINT ORDER BY j) AS v FROM m{n} GROUP BY part, entry) m USING (part, entry))"""
            )
    return ", ".join(steps)


@query(
    "op12_vector_codes",
    f"""
    WITH {_GRID_SQL},
    cells AS (
      SELECT vec_id, p AS part, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS v
      FROM (SELECT vec_id, v, unnest(range(16)) AS p FROM usable)),
    c0 AS (
      SELECT part, entry, v FROM cells
      JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM usable QUALIFY entry < 64) USING (vec_id)),
    {_books_sql(2)},
    coded AS (
      SELECT vec_id, string_agg(lpad(to_hex(entry), 2, '0'), '' ORDER BY part) AS code, sum(far)::BIGINT AS error FROM d2 GROUP BY vec_id),
    text AS (
      SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, j)) AS sha
      FROM (SELECT part, entry, unnest(range(len(v))) AS j, unnest(v) AS x FROM c2))
    SELECT u.vec_id, lower(code) AS code, error, sum(error) OVER (PARTITION BY u.label)::BIGINT AS label_error, sha AS codebooks_sha256
    FROM usable u JOIN coded USING (vec_id), text
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = codes.vector_codes(load(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2)
    coded = cut_lineage(coded)
    totals = few_rows(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")))
    digits = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", digits.alias("code"), "error", "label_error", F.lit(codes.books_digest(books)).alias("codebooks_sha256")
    )


@query("op13_toxicity")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"), folds=4, fold=2, cut=0.3)
