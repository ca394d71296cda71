"""Embedding near-dedup: cover trees, dual traversal, exact threshold pairs."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolescope.llm.base import components, local_roots, materialize

COSINE = 0.98
# Vectors in a block, and the most cells that a label is cut into by distance.
LEAF, MAX_CELLS = 1024, 256
SLACK = 1e-9
# Kinds of rows that verification returns: links of a vector, a spanning edge.
LINK, EDGE = 0, 1


def unit(vectors) -> np.ndarray:
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _distance(dots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * dots, 0.0))


def _net(x: np.ndarray, radius: float, batch: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Centres more than ``radius`` apart that cover all points, and each point's centre."""
    least = 1.0 - radius * radius / 2.0
    centres: list[int] = []
    owner = np.full(len(x), -1)
    for low in range(0, len(x), batch):
        rest = np.arange(low, min(low + batch, len(x)))
        if centres:
            dots = x[rest] @ x[centres].T
            best = dots.argmax(axis=1)
            near = dots[np.arange(len(rest)), best] >= least
            owner[rest[near]] = best[near]
            rest = rest[~near]
        dots = x[rest] @ x[rest].T >= least
        free = np.ones(len(rest), dtype=bool)
        for i in range(len(rest)):
            if free[i]:
                mine = dots[i] & free
                mine[i] = True
                owner[rest[mine]] = len(centres)
                free &= ~mine
                centres.append(int(rest[i]))
    return np.array(centres), owner


class CoverTree:
    """Nested nets with radii that double from the leaves to the root (halve going down).

    ``levels[0]`` holds the points; level ``l`` a net of level ``l - 1``. A node knows its centre,
    the largest distance to any point below it, and its children.
    """

    def __init__(self, x: np.ndarray, finest: float):
        self.x = x
        self.centres = [np.arange(len(x))]
        self.cover = [np.zeros(len(x))]
        self.children: list[tuple[np.ndarray, np.ndarray]] = []
        root_of = np.arange(len(x))
        radius = finest
        while len(self.centres[-1]) > 1 and radius < 2.0:
            below = self.centres[-1]
            centres, owner = _net(x[below], radius)
            radius *= 2
            if len(centres) == len(below) and radius < 2.0:
                continue  # nothing merges at this radius: the level would repeat the one below
            root_of = owner[root_of]
            top = below[centres]
            cover = np.zeros(len(top))
            np.maximum.at(cover, root_of, _distance(np.einsum("ij,ij->i", x, x[top[root_of]])))
            order = np.argsort(owner, kind="stable")
            self.children.append((order, np.searchsorted(owner[order], np.arange(len(top) + 1))))
            self.centres.append(top)
            self.cover.append(cover + SLACK)


def _expand(nodes: np.ndarray, tree: CoverTree, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Children of each node (one level down) and the position of their parent in ``nodes``."""
    order, starts = tree.children[level - 1]
    counts = starts[nodes + 1] - starts[nodes]
    at = np.repeat(np.arange(len(nodes)), counts)
    inner = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
    return order[starts[nodes][at] + inner], at


def near_pairs(a: CoverTree, b: CoverTree, limit: float, step: int = 1 << 18,
               ) -> tuple[np.ndarray, np.ndarray]:
    """Point pairs that node pairs within reach lead to, by traversing both trees together.

    A pair of nodes is dropped when its centres are farther apart than both covering radii and the
    limit allow. Node pairs are followed in batches of bounded size, depth first.
    """
    la, lb = len(a.centres) - 1, len(b.centres) - 1
    na, nb = len(a.centres[la]), len(b.centres[lb])
    rows = max(1, step // max(nb, 1))
    todo = [(la, lb, np.repeat(np.arange(s, min(s + rows, na)), nb),
             np.tile(np.arange(nb), min(s + rows, na) - s)) for s in range(0, na, rows)]
    out_a, out_b = [], []
    while todo:
        la, lb, i, j = todo.pop()
        dots = np.concatenate([np.einsum(
            "ij,ij->i", a.x[a.centres[la][i[s:s + 4096]]], b.x[b.centres[lb][j[s:s + 4096]]])
            for s in range(0, len(i), 4096)]) if len(i) else np.zeros(0)
        near = _distance(dots) <= a.cover[la][i] + b.cover[lb][j] + limit + SLACK
        i, j = i[near], j[near]
        if not len(i):
            continue
        if not la and not lb:
            out_a.append(i)
            out_b.append(j)
            continue
        if la >= lb:
            down, at = _expand(i, a, la)
            la, i, j = la - 1, down, j[at]
        else:
            down, at = _expand(j, b, lb)
            lb, i, j = lb - 1, i[at], down
        todo += [(la, lb, i[s:s + step], j[s:s + step]) for s in range(0, len(i), step)]
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate(out_a or [none]), np.concatenate(out_b or [none])


def _verify(group: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links between two blocks or within one: ``kind, a, b, n`` (counts and spanning edges)."""
    group = group.drop_duplicates("key").sort_values("key").reset_index(drop=True)
    x = unit(group["vec"])
    left = group["block"].to_numpy() == group["i"].iloc[0]
    limit = math.sqrt(max(2.0 - 2.0 * cosine, 0.0))
    first = np.flatnonzero(left)
    tree = CoverTree(x[first], limit / 2)
    if left.all():
        a, b = near_pairs(tree, tree, limit)
        a, b = first[a[a < b]], first[b[a < b]]
    else:
        second = np.flatnonzero(~left)
        a, b = near_pairs(tree, CoverTree(x[second], limit / 2), limit)
        a, b = first[a], second[b]
    if len(a):
        linked = np.concatenate([np.einsum("ij,ij->i", x[a[s:s + 8192]], x[b[s:s + 8192]])
                                 for s in range(0, len(a), 8192)]) >= cosine
        a, b = a[linked], b[linked]
    n, copies, keys = len(group), group["copies"].to_numpy(), group["key"].to_numpy()
    counts = np.bincount(a, weights=copies[b], minlength=n) + \
        np.bincount(b, weights=copies[a], minlength=n)
    some = np.flatnonzero(counts)
    root = local_roots(n, a, b)
    tied = np.flatnonzero(root != np.arange(n))
    return pd.concat([
        pd.DataFrame({"kind": LINK, "a": keys[some], "b": 0,
                      "n": counts[some].astype(np.int64)}),
        pd.DataFrame({"kind": EDGE, "a": keys[tied], "b": keys[root[tied]], "n": 0})])


def vector_links(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id",
                 vec_col: str = "embedding", label_col: str = "label", *, leaf: int = LEAF,
                 ) -> DataFrame:
    """``id, n_links, component_id, kept`` for every row.

    Two vectors are linked when their labels (and lengths) are equal and their cosine, in double
    precision, is at least ``cosine``. ``component_id`` is the smallest id that links lead to.

    Equal vectors fold into one first. The upper level of the cover tree is distributed: each label
    of more than ``leaf`` vectors gets pivots (the least hash in each of up to 256 hash buckets, a
    bounded sample that only decides where work is done), each vector joins its nearest pivot's
    cell, and cells are cut into blocks of about ``leaf`` vectors. Pairs of blocks are dropped when
    pivot distance exceeds both covering radii and the limit; each pair left is one task, which
    builds the lower levels (nets with halving radii) and traverses both trees together. Tasks
    return counts and spanning edges, never all pairs, and no label meets in one task.

    A NULL label, and vectors that are NULL, empty, zero or hold NULL or non-finite components,
    link with nothing and are kept. Repeated rows are linked to each other; a NULL id is counted
    as a link but is no ``component_id`` (``kept`` is then false when others are linked to it). An
    empty table gives no rows; other columns are ignored.
    """
    finite = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & finite
                        & F.exists("vec", lambda v: v != 0.0), F.lit(False))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                          F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.withColumn("key", F.when(usable, F.xxhash64("label", "vec")))
    classes = materialize(
        rows.where(F.col("key").isNotNull()).groupBy("key").agg(
            F.first("label").alias("label"), F.first("vec").alias("vec"),
            F.count(F.lit(1)).alias("copies"), F.min("id").alias("rep"))
        .withColumn("part", F.concat_ws(":", F.size("vec").cast("string"),
                                        F.col("label").cast("string"))).drop("label"),
        "vector-classes")
    sizes = classes.groupBy("part").agg(
        F.least(F.lit(MAX_CELLS), F.ceil(F.count(F.lit(1)) / leaf)).cast("int").alias("cells"))
    spread = classes.join(sizes, "part").withColumn(
        "salt", F.pmod(F.xxhash64("key", F.lit(1)), "cells").cast("int"))
    pivots = materialize(
        spread.groupBy("part", "cells", F.pmod("key", "cells").cast("int").alias("cell"))
        .agg(F.min_by("vec", F.xxhash64("key")).alias("pivot")), "vector-pivots")
    copies_of = pivots.withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))

    def assign(own: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
        if own.empty:
            return pd.DataFrame({"key": [], "part": [], "cell": [], "distance": []})
        away = _distance(unit(own["vec"]) @ unit(centres["pivot"]).T)
        best = away.argmin(axis=1)
        return pd.DataFrame({"key": own["key"], "part": own["part"].astype(object),
                             "cell": centres["cell"].to_numpy()[best],
                             "distance": away[np.arange(len(own)), best]})

    placed = materialize(
        spread.select("part", "salt", "key", "vec").groupBy("part", "salt")
        .cogroup(copies_of.select("part", "salt", "cell", "pivot").groupBy("part", "salt"))
        .applyInPandas(assign, "key bigint, part string, cell int, distance double"),
        "vector-cells")
    cells = placed.groupBy("part", "cell").agg(
        F.ceil(F.count(F.lit(1)) / leaf).cast("int").alias("subs"),
        F.max("distance").alias("radius")).join(pivots.drop("cells"), ["part", "cell"])

    def name(cell, sub):
        return F.concat_ws("/", F.col(cell).cast("string"), F.col(sub).cast("string"), "part")

    blocks = cells.withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)))
    blocks = materialize(blocks.select("part", "radius", "pivot", name("cell", "sub")
                                       .alias("block")), "vector-blocks")
    other = blocks.select("part", F.col("radius").alias("r2"), F.col("pivot").alias("p2"),
                          F.col("block").alias("j"))

    def length(v):
        return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))

    dot = F.aggregate(F.zip_with("pivot", "p2", lambda x, y: x * y), F.lit(0.0),
                      lambda s, x: s + x) / (length("pivot") * length("p2"))
    apart = F.sqrt(F.greatest(2.0 - 2.0 * dot, F.lit(0.0)))
    limit = math.sqrt(max(2.0 - 2.0 * cosine, 0.0))
    pairs = blocks.withColumnRenamed("block", "i").join(other, "part").where(
        (F.col("i") < F.col("j"))
        & (apart <= F.col("radius") + F.col("r2") + limit + 1e-6)).select("i", "j")
    pairs = pairs.unionByName(blocks.select(F.col("block").alias("i"), F.col("block").alias("j")))
    sides = pairs.select("i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    homes = (placed.join(cells.select("part", "cell", "subs"), ["part", "cell"])
             .withColumn("sub", F.pmod(F.xxhash64("key", F.lit(2)), "subs").cast("int"))
             .select("key", name("cell", "sub").alias("block")))
    dealt = sides.join(homes, "block").join(classes.select("key", "copies", "vec"), "key")
    links = materialize(dealt.groupBy("i", "j").applyInPandas(
        lambda g: _verify(g, cosine), "kind int, a bigint, b bigint, n bigint"),
        "vector-links")
    per_class = links.where(F.col("kind") == LINK).groupBy(F.col("a").alias("key")).agg(
        F.sum("n").alias("others"))
    tree = components(links.where(F.col("kind") == EDGE).select("a", "b"))
    rooted = classes.select("key", "copies", "rep").join(
        tree, classes["key"] == tree["node"], "left").withColumn(
        "root", F.coalesce("root", "key"))
    lowest = rooted.groupBy("root").agg(F.min("rep").alias("low"))
    known = (rooted.join(lowest, "root").join(per_class, "key", "left")
             .select("key", "copies", "low", "others"))
    component = F.when(F.col("copies").isNotNull(), F.col("low")).otherwise(F.col("id"))
    return rows.select("id", "key").join(known, "key", "left").select(
        F.col("id").alias(id_col),
        F.coalesce(F.col("copies") - 1 + F.coalesce("others", F.lit(0)), F.lit(0))
        .cast("bigint").alias("n_links"),
        component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
