"""The pipeline stage by stage against plain code, and the registered queries."""

import importlib
import re

import pytest

from windvane.llm.queries import QUERIES, SQL

pytest.importorskip("public_tokenizers")
import corpus_pipeline  # noqa: E402


def test_registered():
    import __spark_entry__ as entry

    assert len([n for n in QUERIES if re.match(r"op\d+_", n)]) == 13
    assert {re.match(r"op(\d+)_", n)[1] for n in QUERIES} == set(map(str, range(1, 14)))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, frames[-1], "/root/testdata/sf0.001").write.parquet(str(folder / name))
        frames.append(spark.read.parquet(str(folder / name)))
    return [f.collect() for f in frames], [f.columns for f in frames]


def test_stages(stages):
    from test_packing import whole
    from test_rules import counts
    from test_secrets import base
    from test_simhash import brute, plain_simhash

    (raw, known, good, single, clean, packed), columns = stages
    assert all(c == columns[0] for c in columns[:5])
    text = {r["doc_id"]: r["text"] for r in raw}
    assert {r["doc_id"] for r in known} == {i for i, t in text.items() if re.search(r"[^\W\d_]", t or "")}
    base_failed = {i for i, t in text.items() if (c := counts(t))["n_words"] < 20 or 100 * c["n_repeat_words"] > 30 * c["n_words"]}
    assert {r["doc_id"] for r in good} <= {r["doc_id"] for r in known} - base_failed
    ids = sorted(r["doc_id"] for r in good)
    label = brute([plain_simhash(text[i]) for i in ids])
    assert {r["doc_id"] for r in single} == {ids[k] for k in set(label)}
    assert {r["doc_id"] for r in clean} == {r["doc_id"] for r in single}
    changed = 0
    for r in clean:
        spans, was = base(text[r["doc_id"]]), text[r["doc_id"]]
        assert all(was[a:b] not in r["text"] for a, _, b in spans)
        assert (r["text"] == was) == (not spans) or "[secret]" in r["text"]
        assert r["n_chars"] == len(r["text"])
        changed += r["text"] != was
    assert changed
    whole(packed, [(r["doc_id"], r["text"]) for r in clean])


def test_clean_documents_stay(stages, spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()}
    (_, known, good, *_), _ = stages
    from test_rules import counts

    for before, after in ((known, good),):
        gone = {r["doc_id"]: r["text"] for r in before if r["doc_id"] not in {x["doc_id"] for x in after}}
        for i, t in gone.items():
            c = counts(t)
            assert labels.get(i) != 1 or c["n_words"] < 20 or 100 * c["n_repeat_words"] > 30 * c["n_words"]


def test_odd_rows(spark, odd, none, tmp_path):
    for name, start in (("odd", odd), ("none", none)):
        start.write.parquet(str(tmp_path / name / "start"))
        docs = spark.read.parquet(str(tmp_path / name / "start"))
        for k, (stage_name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns
            out.write.parquet(str(tmp_path / name / stage_name))
            docs = spark.read.parquet(str(tmp_path / name / stage_name))
        assert (docs.count() > 0) == (name == "odd")


def test_columns_named_as_those_of_the_operators(spark):
    """Stages keep columns whose names they use themselves."""
    from pyspark.sql import functions as F

    names = ["__m", "__n", "__votes", "__posterior", "__base_failed", "__kept", "__base", "__spans", "__found", "__clean", "__lang_pred",
             "__lang_score", "__lang_set", "__lowered", "__letters", "__place", "c0", "row"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).select("*", *[F.lit(n).alias(n) for n in names]).cache()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns
        assert all(tuple(r) == tuple(names) for r in out.select(*names).collect())
        kept = out.select("doc_id", "lang", "source").exceptAll(docs.select("doc_id", "lang", "source"))
        assert kept.count() == 0 and out.count() > 0


def test_run(spark, stages):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert sorted(out.columns) == sorted(stages[1][-1])
    assert out.agg({"length": "sum"}).first()[0] == sum(r["length"] for r in stages[0][-1])


def test_entry_without_the_subpackage(monkeypatch):
    """The other queries still import when the subpackage and the pipeline are not there."""
    import sys

    import __spark_entry__ as entry

    with monkeypatch.context() as m:
        for name in [n for n in sys.modules if n.startswith("windvane.llm")]:
            m.delitem(sys.modules, name)
        m.setitem(sys.modules, "windvane.llm.queries", None)
        m.setitem(sys.modules, "corpus_pipeline", None)
        bare = importlib.reload(entry)
        assert bare.llm is None and "daily_features" in bare.queries() and not [n for n in bare.queries() if n.startswith("op1")]
    importlib.reload(entry)
