"""Secrets in texts, in DataFrame functions only: fixed patterns, and strings that look random.

Two first-order character Markov models, one of random strings and one of ordinary identifiers, are counted from
labelled samples. A run of 12 or more token characters is a secret when it has at least 5 different ones and its log-likelihood ratio
reaches a margin. Lines, zeros and other repeated marks have fewer, and no sample need hold them; of random strings of 12 hex digits about 1 in 10,000 has.
Offsets are code points; ends are exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windvane.llm.common import numbered
from windvane.llm.rules import let
from windvane.session import cut_lineage

# The kinds in their order, with pattern, group that is measured, and its least length.
KINDS = [
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
]
NAMES = [k[0] for k in KINDS] + ["random"]
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
STATES = len(ALPHABET) + 1  # and the start
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{12,}={0,2}"
MARGIN = 8.0  # natural logarithm of how much likelier random must be
DIFFERENT = 5  # characters a random string has at least
BLOCK = 64  # entries whose running totals are built in one go
PAGE = 512  # characters in which a place is looked up
SAMPLE_DOCS = 2000  # rows whose words are the sample of ordinary identifiers, at most
SAMPLE_RANDOM = 2000  # strings made from digests, the sample of random ones


def _plain_running(values: Column, zero: Column, merge: Callable[[Column, Column], Column]) -> Column:
    def step(state: Column, value: Column) -> Column:
        at = merge(state["at"], value)
        return F.struct(at.alias("at"), F.concat(state["out"], F.array(at)).alias("out"))

    return F.aggregate(values, F.struct(zero.alias("at"), F.slice(F.array(zero), 1, 0).alias("out")), step)["out"]


def with_running(rows: DataFrame, name: str, source: str, zero: Column, merge: Callable[[Column, Column], Column], levels: int = 3) -> DataFrame:
    """``rows`` with the running totals of the array ``source``; ``merge`` is associative and ``zero`` changes nothing.

    An array in an aggregate is copied at every step, so totals are built inside blocks of ``BLOCK`` entries, then over the totals of the
    blocks in the same way. The time grows with the length of the array, up to BLOCK ** levels entries.
    """
    if levels == 1:
        return rows.withColumn(name, _plain_running(F.col(source), zero, merge))
    values, b, t, r = F.col(source), f"{name}_b", f"{name}_t", f"{name}_r"
    last = F.floor((F.size(values) - 1) / BLOCK).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: _plain_running(F.slice(values, i * BLOCK + 1, BLOCK), zero, merge))
    rows = rows.withColumn(b, F.when(F.size(values) > BLOCK, cut).otherwise(F.array(_plain_running(values, zero, merge))))
    rows = with_running(rows.withColumn(t, F.transform(b, lambda x: F.get(x, F.size(x) - 1))), r, t, zero, merge, levels - 1)
    before = F.slice(F.concat(F.array(zero), r), 1, F.size(b))
    joined = F.flatten(F.zip_with(b, before, lambda x, first: F.transform(x, lambda y: merge(first, y))))
    return rows.withColumn(name, F.when(F.size(b) > 1, joined).otherwise(F.get(b, F.lit(0)))).drop(b, t, r)


def _sum(x: Column, y: Column) -> Column:
    return x + y


def with_hits(rows: DataFrame, name: str, text: str, pattern: str, kind: int, group: int = 0, least: int = 0) -> DataFrame:
    """``rows`` with array<struct<start, kind, end, hit>> of the leftmost non-overlapping matches, in order.

    The pieces between matches and the matches alternate, so offsets are running sums of their lengths. Every match of
    one character or more is found before the short ones are dropped.
    """
    h, n, e = f"{name}_h", f"{name}_n", f"{name}_e"
    rows = rows.withColumn(h, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(h))
    size = F.zip_with(gaps, h, lambda g, x: F.length(g) + F.length(x))
    rows = rows.withColumn(n, F.when(F.size(h) > 0, size).otherwise(F.expr("cast(array() as array<int>)")))
    rows = with_running(rows, e, n, F.lit(0), _sum)
    spans = F.zip_with(e, h, lambda end, x: F.struct((end - F.length(x)).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x.alias("hit")))
    if group:
        values = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.length)
        long = F.filter(F.arrays_zip(spans.alias("s"), values.alias("n")), lambda x: x["n"] >= least)
        spans = F.when(F.size(h) > 0, F.transform(long, lambda x: x["s"])).otherwise(spans)
    elif least:
        spans = F.filter(spans, lambda s: s["end"] - s["start"] >= least)
    return rows.withColumn(name, spans).drop(h, n, e)


def _bare(hits: str | Column) -> Column:
    return F.transform(hits, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))


def with_base_hits(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with ``__hits``, the matches of the fixed patterns by start, then kind."""
    for i, (kind, pattern, group, least) in enumerate(KINDS):
        rows = with_hits(rows, f"__{kind}", text, pattern, i, group, least)
    kinds = [f"__{kind}" for kind, *_ in KINDS]
    return rows.withColumn("__hits", F.sort_array(F.concat(*kinds))).drop(*kinds)


def _states(token: Column) -> Column:
    return F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))


def markov_ratio(samples: DataFrame, smoothing: float = 0.5) -> list[float]:
    """Log-ratio of the transitions of strings with ``random`` true and false, from (token, random); state 0 is the start."""
    chain = F.concat(F.array(F.lit(0)), _states(F.col("token")))
    steps = samples.select("random", chain.alias("s")).select(
        "random", F.explode(F.transform(F.sequence(F.lit(1), F.size("s") - 1), lambda i: F.get("s", i - 1) * STATES + F.get("s", i))).alias("step")
    )
    counts = {(r["random"], r["step"]): r["n"] for r in steps.groupBy("random", "step").agg(F.count("*").alias("n")).collect()}
    ratio = []
    for x in range(STATES):
        rows = {kind: [counts.get((kind, x * STATES + y), 0) + smoothing for y in range(STATES)] for kind in (True, False)}
        ratio += [math.log(a / sum(rows[True])) - math.log(b / sum(rows[False])) for a, b in zip(rows[True], rows[False], strict=True)]
    return ratio


def labelled_tokens(docs: DataFrame, id_column: str, text_column: str, sample_docs: int = SAMPLE_DOCS, sample_random: int = SAMPLE_RANDOM) -> DataFrame:
    """(token, random): words of a bounded sample of rows, their known secrets, and strings made from digests.

    The sample is one row of each of the ``sample_docs`` ids with the smallest hash (of rows that repeat an id the one with the smallest text);
    rows without id are not sampled.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    chosen = rows.where("id is not null").select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(sample_docs)
    sampled = rows.join(F.broadcast(chosen), "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))  # at most sample_docs rows
    # stored, so that the filters below are not moved into the steps of the search
    found = cut_lineage(with_base_hits(sampled.select("text"), "text").select("text", "__hits"))
    words = found.where(F.size("__hits") == 0).select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z0-9+/_-]{4,}"), F.lit(0))).alias("token"))
    known = found.select(F.explode("__hits.hit").alias("hit")).select(F.regexp_extract("hit", "([A-Za-z0-9+/_-]+=*)[^A-Za-z0-9+/_=-]*$", 1).alias("token"))
    digest = F.sha2(F.col("id").cast("string"), 256)
    made = spark.range(sample_random).select(
        F.explode(F.array(digest, F.base64(F.unhex(digest)), F.upper(F.regexp_replace(F.base64(F.unhex(digest)), "[+/=]", "")))).alias("token")
    )
    return (
        words.withColumn("random", F.lit(False))
        .unionByName(known.where(F.length("token") >= 12).withColumn("random", F.lit(True)))
        .unionByName(made.withColumn("random", F.lit(True)))
    )


def looks_random(token: Column, ratio: list[float], margin: float = MARGIN) -> Column:
    table = F.expr(f"cast(split('{','.join(f'{x:.5f}' for x in ratio)}', ',') as array<double>)")

    def score(states: Column) -> Column:
        chain = F.concat(F.array(F.lit(0)), states)
        return let(
            chain,
            lambda s: F.aggregate(
                F.sequence(F.lit(1), F.size(s) - 1), F.lit(0.0), lambda total, i: total + F.get(table, F.get(s, i - 1) * STATES + F.get(s, i))
            ),
        )

    return let(_states(token), lambda s: (F.size(F.array_distinct(s)) >= DIFFERENT) & (score(s) >= margin))


def with_random_spans(rows: DataFrame, text: str, ratio: list[float], margin: float = MARGIN) -> DataFrame:
    """``rows`` with ``__more``, the spans of random-looking tokens that touch no character of a span in ``__base``.

    Base spans by start and tokens by end form one line (a token before a base span that starts at its end); the largest end of the base
    spans met so far tells whether one of them reaches into the token.
    """

    def event(s: Column, at: Column, base: int, reach: Column) -> Column:
        return F.struct(at.alias("at"), F.lit(base).alias("base"), s.alias("s"), reach.alias("reach"))

    rows = with_hits(rows, "__token", text, TOKEN, len(KINDS))
    rows = rows.withColumn("__found", _bare(F.filter("__token", lambda s: looks_random(s["hit"], ratio, margin))))
    line = F.concat(
        F.transform("__base", lambda s: event(s, s["start"], 1, s["end"])), F.transform("__found", lambda s: event(s, s["end"], 0, F.lit(0)))
    )
    rows = rows.withColumn("__line", F.sort_array(line)).withColumn("__to", F.col("__line.reach"))
    rows = with_running(rows, "__reach", "__to", F.lit(0), F.greatest)
    both = F.zip_with("__line", "__reach", lambda e, r: F.struct(e["base"].alias("base"), e["s"].alias("s"), r.alias("r")))
    free = F.transform(F.filter(both, lambda x: (x["base"] == 0) & (x["r"] <= x["s"]["start"])), lambda x: x["s"])
    return rows.withColumn("__more", free).drop("__token", "__found", "__line", "__to", "__reach")


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(n) for n in NAMES])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def with_spans(docs: DataFrame, ratio: list[float], text_column: str, margin: float = MARGIN) -> DataFrame:
    """``docs`` with ``__base`` and ``__spans`` (base and random spans in order); a null text has none.

    Columns of ``docs`` must not begin with two underscores, ``__id`` and ``__text`` excepted.
    """
    rows = docs.withColumn("__whole", F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")))
    rows = with_base_hits(rows, "__whole").withColumn("__base", _bare("__hits"))
    rows = with_random_spans(rows, "__whole", ratio, margin)
    return rows.withColumn("__spans", F.sort_array(F.concat("__base", "__more"))).drop("__whole", "__hits", "__more")


def secret_scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", margin: float = MARGIN) -> DataFrame:
    """(id, n_assign, n_access, n_hex, n_random, base_sha256, spans) for every row.

    Spans are ``kind:start:end`` by start, then kind. Null and empty texts have none (and the digest of the
    empty text); repeated rows are scanned alike; an empty table gives an empty result; other columns are not read.
    """
    ratio = markov_ratio(labelled_tokens(docs, id_column, text_column))
    rows = with_spans(docs.select(F.col(id_column).alias("__id"), F.col(text_column).alias("__text")), ratio, "__text", margin)
    count = lambda k: F.size(F.filter("__spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{NAMES[k]}")
    return rows.select(
        F.col("__id").alias(id_column), *[count(k) for k in range(len(NAMES))],
        F.sha2(_listed(F.col("__base")), 256).alias("base_sha256"), _listed(F.col("__spans")).alias("spans"),
    )


def redact(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length_column: str | None = None, mark: str = "[secret]", margin: float = MARGIN
) -> DataFrame:
    """``docs`` with every span of a secret replaced by ``mark`` (touching or overlapping spans by one).

    ``length_column`` gets the new number of characters. Rows without a secret, null texts among them, are unchanged; repeated rows are changed
    alike; an empty table stays empty; all other columns, whatever their names, are returned as they are.
    """
    ratio = markov_ratio(labelled_tokens(docs, id_column, text_column))
    rows, names = numbered(docs)
    text = F.col(names[text_column])
    rows = with_spans(rows, ratio, names[text_column], margin)
    found = F.size("__spans") > 0
    # a place is looked up in its page, since finding a character from the start of a long text takes as long as the text
    pages = F.regexp_extract_all(text.cast("string"), F.lit(f"(?s).{{1,{PAGE}}}"), F.lit(0))
    rows = rows.withColumn("__pages", F.when(found, pages)).withColumn("__end", F.col("__spans.end"))
    rows = with_running(rows, "__reach", "__end", F.lit(0), F.greatest).withColumn("__pieces", _pieces(text))
    clean = F.array_join(F.transform("__pieces", lambda g: _cut(F.col("__pages"), g["a"], g["b"])), mark)
    rows = rows.withColumn("__clean", F.when(found, clean).otherwise(text.cast("string")))
    changed = {text_column: F.col("__clean")}
    if length_column:
        was = F.col(names[length_column])
        changed[length_column] = F.when(found, F.length("__clean").cast(docs.schema[length_column].dataType)).otherwise(was)
    return rows.select(*[changed.get(c, F.col(k)).alias(c) for c, k in names.items()])


def _cut(pages: Column, a: Column, b: Column) -> Column:
    """Characters a to b of a text in pages."""
    first, last = F.floor(a / PAGE).cast("int"), F.floor(b / PAGE).cast("int")

    def part(page: Column, i: Column) -> Column:
        begin = F.when(i == 0, a % PAGE).otherwise(F.lit(0))
        return F.substring(page, begin + 1, F.when(i == last - first, b % PAGE).otherwise(F.lit(PAGE)) - begin)

    return F.array_join(F.transform(F.slice(pages, first + 1, last - first + 1), part), "")


def _pieces(text: Column) -> Column:
    """What ``__spans`` leave of a text, as (a, b): before the first, between those that do not touch, and after the last.

    ``__reach`` is the largest end up to each span; a span that the reach of those before meets has no piece before it.
    """
    before = F.concat(F.array(F.lit(0)), "__reach")
    inner = F.transform("__spans", lambda s, i: F.struct(F.get(before, i).alias("a"), s["start"].alias("b"), i.alias("i")))
    inner = F.filter(inner, lambda g: (g["b"] > g["a"]) | (g["i"] == 0))
    after = F.struct(F.get("__reach", F.size("__reach") - 1).alias("a"), F.length(text.cast("string")).alias("b"), F.size("__spans").alias("i"))
    return F.when(F.size("__spans") > 0, F.concat(inner, F.array(after)))
