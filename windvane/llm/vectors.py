"""Near-duplicate vectors by a dual traversal of cover trees.

Vectors with one label are linked when their cosine reaches a threshold. On unit vectors that is a chord
length, a metric, so balls bound what lies inside them. Equal vectors are one point with a weight.

The top of the tree is made over the cluster: pivots (a net picked from a small sample of each large label)
take the points nearest to them, and a cell with more than ``BLOCK`` points is dealt into several blocks. Each
block builds its own cover tree: nested levels of centres with halving radii, every node with the largest
distance to a point below it. Two blocks meet only if the distance of their roots does not exceed both covering
radii and the threshold together, and inside a block pair node pairs are dropped by the same bound. A block
pair returns how many links each point has and a spanning forest of them, never the links.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windvane.llm.common import components, forest, tidy
from windvane.session import cut_lineage

BLOCK = 1024  # points of a block; two blocks are all a task holds
LEAF = 16  # points below which a node is not cut further
MAX_PIVOTS = 4096  # over all labels; cells beyond BLOCK points are dealt into more blocks
SPREAD = 64  # keys on which the blocks of one label meet
_SLACK = 1e-7  # of a chord: for almost equal vectors its rounding error is the root of that of the product


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so that small and large numbers keep their digits."""
    vectors = vectors.astype(np.float64)
    vectors /= np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _chord(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (points @ centre)))


@dataclass
class CoverTree:
    """Points in tree order; node n covers points start[n]..end[n], its centre is the first of them.

    ``radius`` is the covering radius; the children of n are the nodes child[n]..child[n] + children[n].
    """

    order: np.ndarray
    start: np.ndarray
    end: np.ndarray
    radius: np.ndarray
    child: np.ndarray
    children: np.ndarray


def cover_tree(points: np.ndarray, leaf: int = LEAF) -> CoverTree:
    """Cover tree of unit vectors, level by level: the radius halves until it cuts a node."""
    order = np.arange(len(points))
    start, end, radius, child, children = [0], [len(points)], [0.0], [-1], [0]
    away = [_chord(points, points[0])]  # distance of a node's points to its centre
    ball = [2.0]
    node = 0
    while node < len(start):
        s, e, far = start[node], end[node], away[node]
        radius[node] = float(far.max())
        if e - s > leaf and radius[node] > _SLACK:
            r = ball[node]
            while r >= radius[node]:
                r /= 2
            members, at = order[s:e].copy(), s
            child[node] = len(start)
            while len(members):
                if at > s:  # the next point that no centre covers becomes one; the first centre is the node's own
                    far = _chord(points[members], points[members[0]])
                near = far <= r
                near[0] = True
                n = int(near.sum())
                order[at : at + n] = members[near]
                start.append(at)
                end.append(at + n)
                radius.append(0.0)
                child.append(-1)
                children.append(0)
                away.append(far[near])
                ball.append(r)
                children[node] += 1
                members, at = members[~near], at + n
        away[node] = None
        node += 1
    return CoverTree(order, *(np.array(x) for x in (start, end, radius, child, children)))


def dual_links(
    a: np.ndarray, tree_a: CoverTree, b: np.ndarray, tree_b: CoverTree, cosine: float, same: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of position pairs (i in a, j in b, both in tree order; i < j if ``same``) with the cosine or more."""
    reach = float(np.sqrt(max(0.0, 2.0 - 2.0 * cosine))) + _SLACK

    def below(tree: CoverTree, node: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Children of a node, or the points of a leaf as nodes -1: positions of centres, radii, nodes."""
        if tree.children[node]:
            kids = np.arange(tree.child[node], tree.child[node] + tree.children[node])
            return tree.start[kids], tree.radius[kids], np.where(tree.end[kids] - tree.start[kids] > 1, kids, -1)
        at = np.arange(tree.start[node], tree.end[node])
        return at, np.zeros(len(at)), np.full(len(at), -1)

    todo = [(0, 0)]
    while todo:
        x, y = todo.pop()
        own = same and x == y
        at_x, far_x, sub_x = below(tree_a, x)
        at_y, far_y, sub_y = (at_x, far_x, sub_x) if own else below(tree_b, y)
        dots = a[at_x] @ b[at_y].T
        distance = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * dots))
        near = distance <= far_x[:, None] + far_y[None, :] + reach
        if own:
            near = np.triu(near)
        points = (sub_x < 0)[:, None] & (sub_y < 0)[None, :]
        i, j = np.nonzero(near & points & (dots >= cosine))
        i, j = at_x[i], at_y[j]
        if own:
            i, j = i[i != j], j[i != j]
        if len(i):
            yield np.minimum(i, j) if same else i, np.maximum(i, j) if same else j
        for p, q in zip(*np.nonzero(near & ~points), strict=True):
            # a point against a node: the leaf's node is visited again with the point's own
            if sub_x[p] >= 0 and sub_y[q] >= 0:
                todo.append((int(sub_x[p]), int(sub_y[q])))
            else:
                yield from _point_against(a, b, at_x[p], at_y[q], sub_x[p], sub_y[q], tree_a, tree_b, reach, cosine, same)


def _point_against(a, b, i, j, node_x, node_y, tree_a, tree_b, reach, cosine, same):
    """Links of one point with all points of one node, down the node's subtree."""
    if node_y < 0:
        found = _descend(a, tree_a, int(node_x), b[j], reach, cosine)
        pair = (found, np.full(len(found), j))
    else:
        found = _descend(b, tree_b, int(node_y), a[i], reach, cosine)
        pair = (np.full(len(found), i), found)
    if len(found):
        yield (np.minimum(*pair), np.maximum(*pair)) if same else pair


def _descend(points: np.ndarray, tree: CoverTree, node: int, point: np.ndarray, reach: float, cosine: float) -> np.ndarray:
    hits, todo = [], [node]
    while todo:
        n = todo.pop()
        if not tree.children[n]:
            at = np.arange(tree.start[n], tree.end[n])
            hits.append(at[points[at] @ point >= cosine])
            continue
        kids = np.arange(tree.child[n], tree.child[n] + tree.children[n])
        todo += kids[_chord(points[tree.start[kids]], point) <= tree.radius[kids] + reach].tolist()
    return np.concatenate(hits) if hits else np.zeros(0, np.int64)


def _pivots(sample: pd.DataFrame, wanted: dict) -> dict:
    """A net for each large label: the point farthest from those picked so far, again and again."""
    nets = {}
    for key, rows in sample.groupby(["label", "dim"]):
        if key not in wanted:
            continue
        points = unit(np.stack(rows["vec"].to_numpy()))
        chosen, far = [0], _chord(points, points[0])
        while len(chosen) < wanted[key] and far.max() > _SLACK:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, _chord(points, points[chosen[-1]]))
        nets[key] = points[chosen]
    return nets


def _sample(points: DataFrame, crowded: DataFrame, share: float) -> DataFrame:
    """About that share of the vectors of the crowded labels, and none of other labels."""
    drawn = points.where(F.pmod(F.xxhash64("id"), F.lit(1_000_003)) < share * 1_000_003)
    return drawn.join(crowded, ["label", "dim"], "left_semi").select("label", "dim", "vec")


def _tree_columns(tree: CoverTree) -> dict:
    return {n: getattr(tree, n).tobytes() for n in ("start", "end", "radius", "child", "children")}


def _block(row, dim: int) -> tuple[np.ndarray, CoverTree, np.ndarray, np.ndarray]:
    points = unit(np.frombuffer(row.vecs, np.float64).reshape(-1, dim))
    kinds = {"start": np.int64, "end": np.int64, "radius": np.float64, "child": np.int64, "children": np.int64}
    tree = CoverTree(np.arange(len(points)), *(np.frombuffer(getattr(row, n), k) for n, k in kinds.items()))
    return points, tree, np.frombuffer(row.ids, np.int64), np.frombuffer(row.weights, np.int64)


def vector_near_dups(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", cosine: float = 0.93
) -> DataFrame:
    """(id, n_links, component_id, kept) for every vector.

    Only vectors of equal labels and equal length are compared. A vector without a label, or that is null, empty, zero or
    holds a null or a non-finite number, has no links and is a component of its own. Rows that repeat an id are
    one vector (the smallest by label and numbers); rows without an id take no part and come back once each, with no links,
    no component and kept false. An empty table gives an empty result; other columns are not read.
    """
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(label_column).alias("label"),
        F.col(vector_column).cast("array<double>").alias("vec"),
    )
    named = rows.where("id is not null")
    if named.groupBy("id").count().where("count > 1").limit(1).count():
        named = named.groupBy("id").agg(F.min(F.struct("label", "vec")).alias("r")).select("id", "r.label", "r.vec")
    fit = (
        F.col("label").isNotNull()
        & F.col("vec").isNotNull()
        & ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("vec", lambda x: x != 0)
    )
    points = cut_lineage(
        named.where(fit).groupBy("label", "vec").agg(F.min("id").alias("id"), F.count("*").alias("weight"))
        .withColumn("dim", F.size("vec"))
    )

    crowded = cut_lineage(points.groupBy("label", "dim").count().where(F.col("count") > BLOCK))
    large = crowded.toPandas()  # at most points / BLOCK rows
    scale = min(1.0, MAX_PIVOTS / max(1.0, float(np.ceil(large["count"] / BLOCK).sum())))
    wanted = {(label, dim): max(1, int(-(-n // BLOCK) * scale)) for label, dim, n in large.itertuples(index=False)}
    nets = {}
    if wanted:
        share = 8.0 * scale / BLOCK
        nets = _pivots(_sample(points, crowded, share).toPandas(), wanted)  # about 8 * MAX_PIVOTS vectors at most

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.zeros(batch.num_rows, np.int32)
            keys = list(zip(batch.column("label").to_pylist(), batch.column("dim").to_pylist(), strict=True))
            for key in set(keys) & set(nets):
                at = np.array([k == key for k in keys])
                rows = batch.column("vec").filter(pa.array(at))
                numbers = unit(rows.flatten().to_numpy(zero_copy_only=False).reshape(-1, key[1]))
                cell[at] = (numbers @ nets[key].T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "cell"])

    kind = points.schema["label"].dataType.simpleString()
    points = points.select("label", "dim", "id", "weight", "vec")
    celled = points.mapInArrow(tidy(assign), f"label {kind}, dim int, id long, weight long, vec array<double>, cell int")
    sizes = celled.groupBy("label", "dim", "cell").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    dealt = celled.join(sizes, ["label", "dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))

    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        numbers = np.stack(group["vec"].to_numpy())
        points = unit(numbers)
        tree = cover_tree(points)
        ids, weights = (group[c].to_numpy(np.int64)[tree.order] for c in ("id", "weight"))
        return pd.DataFrame(
            [{"label": key[0], "dim": key[1], "block": int(ids[0]), "centre": points[tree.order[0]], "reach": float(tree.radius[0]),
              "ids": ids.tobytes(), "weights": weights.tobytes(), "vecs": numbers[tree.order].tobytes(), **_tree_columns(tree)}]
        )

    held = "ids binary, weights binary, vecs binary, start binary, end binary, radius binary, child binary, children binary"
    blocks = cut_lineage(
        dealt.select("label", "dim", "cell", "part", "id", "weight", "vec")
        .groupBy("label", "dim", "cell", "part")
        .applyInPandas(build, f"label {kind}, dim int, block long, centre array<double>, reach double, {held}")
    )
    # blocks are named by the id of their first point, which no other block holds
    # all blocks of a label meet; one side is dealt out and the other sent to every part, so that a hot label is many keys
    one = blocks.select("label", "dim", F.pmod(F.xxhash64("block"), F.lit(SPREAD).cast("long")).alias("salt"), F.col("block").alias("a"), F.col("centre").alias("ca"), F.col("reach").alias("ra"))
    two = blocks.select("label", "dim", F.explode(F.expr(f"sequence(0L, {SPREAD - 1}L)")).alias("salt"), F.col("block").alias("b"), F.col("centre").alias("cb"), F.col("reach").alias("rb"))
    dot = F.aggregate(F.zip_with("ca", "cb", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    threshold = float(np.sqrt(max(0.0, 2.0 - 2.0 * cosine)))
    close = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * dot)) <= F.col("ra") + F.col("rb") + threshold + 2 * _SLACK
    meet = one.join(two, ["label", "dim", "salt"]).where("a <= b").where(close).select("a", "b")
    visits = meet.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("block"))

    def join(group: pd.DataFrame) -> pd.DataFrame:
        rows = list(group.sort_values("block").itertuples())
        dim = int(rows[0].dim)
        a, tree_a, ids, weights = _block(rows[0], dim)
        same = len(rows) == 1
        b, tree_b, shift = a, tree_a, 0
        if not same:
            b, tree_b, more, heavy = _block(rows[1], dim)
            ids, weights, shift = np.concatenate([ids, more]), np.concatenate([weights, heavy]), len(a)
        links = np.zeros(len(ids), np.int64)

        def counted():
            for i, j in dual_links(a, tree_a, b, tree_b, cosine, same):
                j = j + shift
                np.add.at(links, i, weights[j])
                np.add.at(links, j, weights[i])
                yield i, j

        label = forest(len(ids), counted())
        at = np.flatnonzero(links)
        return pd.DataFrame({"id": ids[at], "links": links[at], "root": ids[label[at]]})

    found = cut_lineage(
        visits.join(blocks.drop("label", "centre", "reach"), "block").groupBy("a", "b").applyInPandas(join, "id long, links long, root long")
    )
    tree = components(found.select(F.col("id").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    linked = (
        points.select("label", "vec", "id", "weight").join(links, "id", "left")
        .join(tree, F.col("id") == F.col("node"), "left")
        .select("label", "vec", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "id").alias("component_id"))
    )
    alone = named.where(~fit).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    nameless = rows.where("id is null").select("id", F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id"))
    every = named.where(fit).join(linked, ["label", "vec"]).select("id", "n_links", "component_id").unionByName(alone).unionByName(nameless)
    return every.select(
        F.col("id").alias(id_column), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")
    )
