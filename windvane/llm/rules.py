"""Quality rules as weak supervision, in DataFrame functions only.

Each rule votes good or bad or abstains. Expectation-maximisation over the counts of vote patterns estimates how
often each rule is right about good and about bad texts, and the share of good ones; a text is kept by the
posterior probability of being good. The patterns are a sufficient statistic: at most 3 to the number of
rules rows reach the driver, whatever the number of documents.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windvane.llm.common import numbered
from windvane.session import cut_lineage

WINDOW = 8
# Frequent words of the languages that are expected, all lower case (fixed values).
STOP_WORDS = [
    "the", "of", "and", "to", "in", "is", "that", "for", "it", "was", "on", "are", "as", "with", "be", "by",
    "de", "la", "le", "et", "les", "des", "du", "un", "une", "est", "que", "pour", "dans", "qui", "sur",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht", "ein", "eine",
    "el", "y", "los", "se", "del", "las", "por", "con", "para", "su", "al", "lo", "como",
]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once; lambdas inside may then refer to it for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda s, x: s + x)


def _repeated(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows that occur twice or more in the text (windows are compared by 64-bit hashes)."""

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            again = F.filter(
                s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
            )
            return F.sort_array(F.transform(again, lambda x: x["i"]))

        def length(at: Column) -> Column:
            return _total(F.transform(at, lambda x, i: F.least(F.lit(window), F.coalesce(F.get(at, i + 1) - x, F.lit(window)))))

        # most texts repeat no window, which a set of the hashes tells without a sort
        return F.when(F.size(hashes) == F.size(F.array_distinct(hashes)), F.lit(0)).otherwise(let(let(pairs, starts), length))

    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (window - 1)), lambda i: F.xxhash64(F.slice(words, i, window)))
    return F.when(F.size(words) < window, F.lit(0)).otherwise(let(hashes, covered))


def measures(text: Column) -> Column:
    """A struct of counts over one whole text; a null text has no words."""
    text = F.coalesce(text.cast("string"), F.lit(""))

    def counted(words: Column) -> Column:
        stop = F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS)))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _repeated(words).cast("long").alias("n_repeat_words"),
            stop.cast("long").alias("n_stop"),
            F.size(F.filter(words, lambda w: w.rlike(r"^[\p{L}'-]+[.,;:!?]*$"))).cast("long").alias("n_plain"),
        )

    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+", -1), "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    line_counts = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), F.size(F.array_distinct(x)).cast("long").alias("different")))
    return F.struct(
        let(words, counted).alias("w"), line_counts.alias("l"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit(r"\p{Lu}{2,}")).cast("long").alias("n_capitals"),
        F.regexp_count(text, F.lit("!+")).cast("long").alias("n_shouts"),
    )


@dataclass(frozen=True)
class Rule:
    """Votes by one number: bad from ``bad`` on, good up to ``good``, else it abstains (also without words)."""

    name: str
    number: Callable[[], Column]
    good: float
    bad: float

    def vote(self) -> Column:
        """2 good, 1 bad, 0 abstained."""
        x = F.when(F.col("__n.n_words") > 0, self.number())
        if self.good < self.bad:
            return F.when(x >= self.bad, 1).when(x <= self.good, 2).otherwise(0)
        return F.when(x <= self.bad, 1).when(x >= self.good, 2).otherwise(0)


def _per_word(column: str) -> Callable[[], Column]:
    return lambda: F.col(f"__n.{column}") / F.col("__n.n_words")


RULES = [
    Rule("symbols", _per_word("n_symbols"), 0.05, 0.15),
    Rule("repeats", _per_word("n_repeat_words"), 0.05, 0.25),
    Rule("capitals", _per_word("n_capitals"), 0.1, 0.4),
    Rule("shouts", _per_word("n_shouts"), 0.05, 0.25),
    Rule("stop_words", _per_word("n_stop"), 0.08, 0.005),
    Rule("plain_words", _per_word("n_plain"), 0.85, 0.6),
    Rule("long_words", _per_word("word_chars"), 9.0, 14.0),
    Rule("short_words", _per_word("word_chars"), 3.0, 2.0),
    Rule("same_lines", lambda: F.col("__n.n_dup_lines") / F.greatest(F.col("__n.n_lines"), F.lit(1)), 0.1, 0.4),
    Rule("length", lambda: F.col("__n.n_words"), 50, 5),
]


@dataclass(frozen=True)
class Accuracies:
    """Share of good texts, and per rule the probability of a right vote on good and on bad texts."""

    prior: float
    good: list[float]
    bad: list[float]

    def log_odds(self, votes: Column) -> Column:
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for j, (a, b) in enumerate(zip(self.good, self.bad, strict=True)):
            vote = F.substring(votes, j + 1, 1)
            total = total + F.when(vote == "2", math.log(a / (1 - b))).when(vote == "1", math.log((1 - a) / b)).otherwise(0.0)
        return total


# Prior counts of right and wrong votes: a rule seldom accuses a good text, but need not notice every bad one.
PRIOR_GOOD, PRIOR_BAD = (9.0, 1.0), (4.0, 6.0)


def estimate(patterns: dict[str, int], rules: int, rounds: int = 50) -> Accuracies:
    """EM over vote patterns; every rule stays better than chance (its two accuracies add up to more than 1).

    Starts from the belief that most texts no rule accuses are good, and fewer with every accusation. Without
    documents the priors alone are returned.
    """
    rows = [(p, n) for p, n in patterns.items() if n]
    total = sum(n for _, n in rows)
    belief = {p: 0.95 / (1 + 3 * p.count("1")) for p, _ in rows}
    found = Accuracies(0.5, [PRIOR_GOOD[0] / sum(PRIOR_GOOD)] * rules, [PRIOR_BAD[0] / sum(PRIOR_BAD)] * rules)
    for _ in range(rounds):
        good, bad = [], []
        for j in range(rules):
            right = sum(n * belief[p] for p, n in rows if p[j] == "2")
            wrong = sum(n * belief[p] for p, n in rows if p[j] == "1")
            good.append(min(0.999, max(0.51, (right + PRIOR_GOOD[0]) / (right + wrong + sum(PRIOR_GOOD)))))
            right = sum(n * (1 - belief[p]) for p, n in rows if p[j] == "1")
            wrong = sum(n * (1 - belief[p]) for p, n in rows if p[j] == "2")
            bad.append(min(0.999, max(1.01 - good[j], (right + PRIOR_BAD[0]) / (right + wrong + sum(PRIOR_BAD)))))
        share = (sum(n * belief[p] for p, n in rows) + 1) / (total + 2)
        found = Accuracies(min(0.99, max(0.01, share)), good, bad)
        for p, _ in rows:
            odds = math.log(found.prior / (1 - found.prior))
            for j, v in enumerate(p):
                if v != "0":
                    a, b = found.good[j], found.bad[j]
                    odds += math.log(a / (1 - b)) if v == "2" else math.log((1 - a) / b)
            belief[p] = 1 / (1 + math.exp(-odds))
    return found


def with_measures(docs: DataFrame, text_column: str) -> DataFrame:
    """``docs`` with the struct ``__n`` of all counts, and ``__votes``, a character for each rule."""
    rows = docs.withColumn("__m", measures(F.col(f"`{text_column}`")))
    m = {
        "n_words": "__m.w.n_words", "word_chars": "__m.w.word_chars", "n_symbols": "__m.n_symbols", "n_repeat_words": "__m.w.n_repeat_words",
        "n_stop": "__m.w.n_stop", "n_plain": "__m.w.n_plain", "n_capitals": "__m.n_capitals", "n_shouts": "__m.n_shouts", "n_lines": "__m.l.n_lines",
    }
    counts = [F.col(v).alias(k) for k, v in m.items()]
    rows = rows.withColumn("__n", F.struct(*counts, (F.col("__m.l.n_lines") - F.col("__m.l.different")).alias("n_dup_lines"))).drop("__m")
    return rows.withColumn("__votes", F.concat(*[r.vote().cast("string") for r in RULES]))


def judged(rows: DataFrame, cut: float = 0.5) -> DataFrame:
    """Rows with counts and votes, with ``__posterior``, ``__base_failed`` and ``__kept`` added.

    The vote patterns are counted in a pass of their own, so the rows should be stored.
    """
    patterns = {r["__votes"]: r["n"] for r in rows.groupBy("__votes").agg(F.count("*").alias("n")).collect()}
    posterior = 1 / (1 + F.exp(-estimate(patterns, len(RULES)).log_odds(F.col("__votes"))))
    failed = (F.col("__n.n_words") < 20) | (100 * F.col("__n.n_repeat_words") > 30 * F.col("__n.n_words"))
    rows = rows.withColumn("__posterior", posterior).withColumn("__base_failed", failed)
    return rows.withColumn("__kept", ~F.col("__base_failed") & (F.col("__posterior") >= cut))


def quality_rules(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, counts, base_failed, votes, posterior, kept) for every row.

    A null text has no words and fails; an empty table gives an empty result; repeated rows are judged alike and counted each;
    other columns are not read. ``base_failed`` texts (under 20 words, or over 30 % of words in repeated windows) are never kept.
    """
    rows = with_measures(docs.select(F.col(id_column).alias("__id"), F.col(text_column).alias("__text")), "__text").select("__id", "__n", "__votes")
    counts = [F.col(f"__n.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    verdict = [F.col(f"__{c}").alias(c) for c in ("base_failed", "kept", "posterior", "votes")]
    return judged(cut_lineage(rows)).select(F.col("__id").alias(id_column), *counts, *verdict)


def keep_good(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is kept, with their columns unchanged, whatever their names.

    A null text has no words and goes; repeated rows are judged alike; an empty table stays empty.
    """
    rows, names = numbered(docs)
    return judged(cut_lineage(with_measures(rows, names[text_column]))).where("__kept").select(*names.values()).toDF(*docs.columns)
