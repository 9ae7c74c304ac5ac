import os
import random

import pytest

SMALL = "/root/testdata/sf0.001"
TABLE = "doc_id long, text string, lang string, source string, n_chars long"
# columns that the operators use for results or inside
CLASHING = ["score", "id", "component_id", "kept", "labels", "fp", "word", "key", "n", "spans", "held_out", "ids", "start", "votes", "lang_pred", "kind"]


def words(n: int, seed: int = 0, of: str = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho") -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(of.split()) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


ODD = [
    (1, "The quick brown fox of the house and the dog " + words(60, 1), "en", "a"),
    (2, None, "en", None),
    (3, "", None, "a"),
    (4, " \n\t  \x0b", "en", "b"),
    (5, "\n".join(words(40, s) for s in range(1500)), "en", "hot"),
    (6, "Una casa de la ciudad y los perros que corren por el campo " + words(30, 2), "es", "hot"),
    (6, "Una casa de la ciudad y los perros que corren por el campo " + words(30, 2), "es", "hot"),
    (7, "x", "en", "hot"),
    (8, "漢字かな交じり文 😀 ß É 1234567890 ﬁ \x1c \x85 ▁ <|endoftext|> </s>", None, None),
    (9, words(50, 3), None, "a"),
    (10, words(50, 3), "en", "a"),
    (None, "A row without an id, of the house and the dog. " + words(30, 4), "en", "a"),
    (11, "#### $$$$ 12 !!", "en", "a"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with nulls, empty and long texts, repeated rows, and columns whose names clash with those of results."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(*r, len(r[1] or "")) for r in ODD], TABLE)
    return rows.select("*", *[F.lit("clash").alias(c) for c in CLASHING]).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def small(spark):
    if not os.path.isdir(SMALL):
        pytest.skip("test tables are not here")
    return lambda table: spark.read.parquet(f"{SMALL}/{table}.parquet")
