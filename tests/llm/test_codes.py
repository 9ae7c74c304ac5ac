"""Codes by tries of distinct parts against brute force."""

import hashlib

import numpy as np
import pytest

from windvane.llm import codes as C


def plain(vectors, parts, entries, rounds):
    """Codes, errors and codebooks of {id: whole numbers}, one part and vector at a time."""
    ids = sorted(vectors)
    size = len(vectors[ids[0]]) // parts
    books, out = [], {i: [] for i in ids}
    for p in range(parts):
        cells = {i: vectors[i][p * size : (p + 1) * size] for i in ids}
        book = [cells[i] for i in ids[:entries]]

        def near(cell):
            return min((sum((a - b) ** 2 for a, b in zip(cell, e, strict=True)), k) for k, e in enumerate(book))

        for _ in range(rounds):
            met = [[] for _ in book]
            for i in ids:
                met[near(cells[i])[1]].append(cells[i])
            book = [[sum(x) // len(m) for x in zip(*m, strict=True)] if m else e for e, m in zip(book, met, strict=True)]
        for i in ids:
            out[i].append(near(cells[i]))
        books.append(book)
    return {i: ([k for _, k in o], sum(d for d, _ in o)) for i, o in out.items()}, books


@pytest.mark.parametrize("block", [1, 3, 40, 5000])
@pytest.mark.parametrize("width,values", [(1, 50), (3, 4), (4, 30)])
def test_trie(block, width, values):
    """Blocks smaller than a node make the traversal go down, larger ones take runs of siblings."""
    rng = np.random.default_rng(block + width)
    parts = np.unique(rng.integers(-values, values, (900, width)), axis=0)
    book = rng.integers(-values, values, (17, width))
    book[5] = book[3]  # a tie
    entry, far = C.trie_nearest(parts, book, block)
    every = ((parts[:, None, :] - book[None]) ** 2).sum(axis=2)
    assert (entry == every.argmin(axis=1)).all() and (far == every.min(axis=1)).all()
    assert not len(C.trie_nearest(parts[:0], book, block)[0])


def test_against_brute_force(spark, monkeypatch):
    """Many copies of one vector, several tasks, unused entries and negative numbers."""
    monkeypatch.setattr(C, "TASK_PARTS", 150)
    rng = np.random.default_rng(2)
    points = rng.normal(0, 0.1, (150, 12)).astype(np.float32)
    points[40:90] = points[3]
    points[100:] = np.round(points[100:], 1)
    rows = [(1000 - i, p.tolist(), int(i % 3)) for i, p in enumerate(points)]
    coded, books = C.vector_codes(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4), parts=4, entries=7, rounds=2)
    want, plain_books = plain({i: [int(np.floor(256 * float(x))) for x in v] for i, v, _ in rows}, 4, 7, 2)
    assert {r["vec_id"]: (r["codes"], r["error"]) for r in coded.collect()} == want
    assert books.tolist() == plain_books
    text = ",".join(str(x) for part in plain_books for e in part for x in e)
    assert C.books_digest(books) == hashlib.sha256(text.encode()).hexdigest()


def test_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [0.1, 0.2, 0.3], 0), (2, [0.1, 0.2, 0.3], None), (2, [0.5, 0.2, 0.3], None), (3, None, 1), (4, [], 1), (5, [0.1, None, 0.2], 1),
        (6, [inf, 0.0, 0.0], 1), (7, [nan, 0.0, 0.0], 1), (None, [9.0, 9.0, 9.0], 2), (8, [1.0, 2.0], 1), (9, [1e300, -1e300, 0.0], 1),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    clash = table.selectExpr("*", "'x' AS codes", "'y' AS error", "1 AS place", "2 AS part", "3 AS id", "4 AS vec")
    coded, books = C.vector_codes(clash, parts=2, entries=2, rounds=1)
    got = sorted(((r["vec_id"], r["label"], len(r["codes"])) for r in coded.collect()), key=str)
    # three numbers in two parts are filled up with a zero; vectors of another length go; rows without an id and huge numbers stay
    assert got == sorted([(1, 0, 2), (2, None, 2), (2, None, 2), (None, 2, 2), (9, 1, 2)], key=str)
    assert books.shape == (2, 2, 2)
    empty, books = C.vector_codes(table.limit(0))
    assert empty.count() == 0 and empty.columns == ["vec_id", "label", "codes", "error"] and not books.size
    one, books = C.vector_codes(table.where("vec_id = 1"), parts=3, entries=4)
    assert [(r["codes"], r["error"]) for r in one.collect()] == [([0, 0, 0], 0)] and books.shape == (3, 1, 1)
