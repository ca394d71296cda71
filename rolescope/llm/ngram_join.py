"""N-gram Jaccard join: MinHash LSH forest, then exact verification."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rolescope.llm.base import (components, fresh, hash_words, local_roots, materialize, mix, rolling,
                                text_slices)

_U = np.uint64
# Kinds of rows that verification returns.
LINK, EDGE = 0, 1


@dataclass(frozen=True)
class ForestPlan:
    """Shape of the LSH forest.

    ``trees`` prefix tries over signatures of ``depth`` minima each. Matching starts at full depth
    and shortens the prefix to the depth at which ``1 - (1 - similarity ** depth) ** trees``
    reaches ``recall``, that is, at which even a pair of exactly the threshold's similarity is
    found that often, whatever else the corpus holds.
    """

    words: int = 5
    similarity: float = 0.8
    trees: int = 20
    depth: int = 6
    recall: float = 0.9999
    block: int = 128

    @property
    def last_depth(self) -> int:
        for k in range(self.depth, 1, -1):
            if self.found(self.similarity, k) >= self.recall:
                return k
        return 1

    def found(self, similarity: float, depth: int) -> float:
        """Chance that a pair of this similarity shares a prefix of ``depth`` in some tree."""
        return 1.0 - (1.0 - similarity ** depth) ** self.trees


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of runs of ``n`` words; a shorter text is one run of all its words."""
    if 0 < len(words) < n:
        n = len(words)
    return np.unique(rolling(words, n)) if len(words) else words


def _tree_nodes(sets: list[np.ndarray], plan: ForestPlan) -> np.ndarray:
    """Node keys of every tree at depths ``last_depth .. depth``: (texts, depths, trees)."""
    every = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    factors = mix(np.arange(1, plan.trees * plan.depth + 1, dtype=_U)) | _U(1)
    keys = np.repeat(mix(np.arange(1, plan.trees + 1, dtype=_U))[None, :], len(sets), axis=0)
    levels = []
    for level in range(plan.depth):
        for tree in range(plan.trees):
            low = np.minimum.reduceat(every * factors[level * plan.trees + tree], starts)
            keys[:, tree] = mix(keys[:, tree] * _U(31) + low)
        if level + 1 >= plan.last_depth:
            levels.append(keys.copy())
    return np.stack(levels, axis=1)


def _signatures(docs: DataFrame, plan: ForestPlan) -> DataFrame:
    """``id, key, n, nodes`` per row: a hash of the shingle set, its size, its trie nodes."""
    id_type = docs.schema["id"].dataType.simpleString()

    def sign(batches):
        for batch in batches:
            for first, last, data, bounds in text_slices(batch.column(1)):
                words, at = hash_words(data, bounds, fold=True)
                sets = [shingles(words[at[i]:at[i + 1]], plan.words) for i in range(last - first)]
                n = np.array([len(s) for s in sets], dtype=np.int64)
                full = np.flatnonzero(n)
                key = np.zeros(len(n), dtype=_U)
                nodes = [b""] * len(n)
                if len(full):
                    held = [sets[i] for i in full]
                    key[full] = [mix(np.sum(mix(s ^ _U(n[i])))[None])[0]
                                 for i, s in zip(full, held)]
                    for i, row in zip(full, _tree_nodes(held, plan)):
                        nodes[i] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(key.view(np.int64)),
                     pa.array(n), pa.array(nodes, pa.binary())], ["id", "key", "n", "nodes"])

    return docs.mapInArrow(sign, f"id {id_type}, key bigint, n bigint, nodes binary")


def _nodes_at(reps: DataFrame, plan: ForestPlan, depth: int) -> DataFrame:
    """``key, node``: every trie node of each distinct shingle set at one depth."""
    first = (depth - plan.last_depth) * plan.trees

    def unpack(batches):
        for batch in batches:
            rows = [np.frombuffer(b, dtype=np.int64)[first:first + plan.trees]
                    for b in batch.column(1).to_pylist()]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(batch.column(0).to_numpy(), plan.trees)),
                     pa.array(np.concatenate(rows))], ["key", "node"])

    return reps.select("key", "nodes").mapInArrow(unpack, "key bigint, node bigint")


def _shared(reps: DataFrame, plan: ForestPlan, depth: int) -> DataFrame:
    """``key, node, low``: nodes that hold two or more sets, with the smallest key there."""
    members = _nodes_at(reps, plan, depth)
    held = members.groupBy("node").agg(F.count(F.lit(1)).alias("c"), F.min("key").alias("low"))
    return members.join(held.where("c > 1").drop("c"), "node")


def _blocks(shared: DataFrame, plan: ForestPlan) -> DataFrame:
    """``key, block``: sets in order of the tries they share, cut into runs of bounded length.

    Sorting by the smallest set met within two shared nodes brings near copies together, so that
    most pairs fall into one block. A large group is spread over many blocks.
    """
    first = shared.groupBy("key").agg(F.min("low").alias("label"))
    wider = shared.join(first, "key").groupBy("node").agg(F.min("label").alias("label"))
    label = shared.join(wider, "node").groupBy("key").agg(F.min("label").alias("label"))

    def number(batches):
        from pyspark import TaskContext
        at, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            place = np.arange(at, at + batch.num_rows)
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(place), part)), pa.array(place)],
                ["key", "part", "at"])

    ordered = label.repartitionByRange("label", "key").sortWithinPartitions("label", "key")
    placed = materialize(ordered.select("key").mapInArrow(
        number, "key bigint, part bigint, at bigint"), "ngram-order")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    offsets = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return materialize(placed.join(offsets, "part").select(
        "key", F.floor((F.col("offset") + F.col("at")) / plan.block).cast("bigint")
        .alias("block")), "ngram-blocks")


def _exact(sets: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Jaccard similarity of the listed pairs of sorted sets."""
    sizes = np.array([len(s) for s in sets])
    if len(pairs) < 24:
        common = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                           for a, b in pairs])
    else:
        used = np.unique(pairs)
        place = np.full(len(sets), -1)
        place[used] = np.arange(len(used))
        owner = np.repeat(np.arange(len(used)), sizes[used])
        values, column = np.unique(np.concatenate([sets[i] for i in used]), return_inverse=True)
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        gram = np.zeros((len(used), len(used)), dtype=np.float32)
        step = 1 << 14  # columns of the incidence matrix held at a time
        for low in range(0, len(values), step):
            a, b = np.searchsorted(column, (low, low + step))
            part = np.zeros((len(used), min(step, len(values) - low)), dtype=np.float32)
            part[owner[a:b], column[a:b] - low] = 1
            gram += part @ part.T  # counts below 2 ** 24 are exact
        common = gram[place[pairs[:, 0]], place[pairs[:, 1]]].astype(np.int64)
    return common / (sizes[pairs[:, 0]] + sizes[pairs[:, 1]] - common)


def _verify(group: pd.DataFrame, plan: ForestPlan, depth: int) -> pd.DataFrame:
    """Links between the sets of two blocks (or within one) that first match at ``depth``.

    Rows ``kind, a, b, n``: LINK counts documents linked to set ``a`` through other sets, EDGE is a
    spanning edge. No list of all linked pairs leaves the task.
    """
    group = group.drop_duplicates("key").sort_values("key").reset_index(drop=True)
    left, right = group["i"].iloc[0], group["j"].iloc[0]
    levels = plan.depth - plan.last_depth + 1
    nodes = np.stack([np.frombuffer(b, dtype=np.int64).reshape(levels, plan.trees)
                      for b in group["nodes"]])
    level = depth - plan.last_depth
    n, block = len(group), group["block"].to_numpy()
    sizes = group["n"].to_numpy()
    rows, cols = [], []
    for a in range(n - 1):
        b = np.arange(a + 1, n)
        if left != right:
            b = b[block[b] != block[a]]
        small, large = np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b])
        b = b[small >= plan.similarity * large - 1e-9]
        b = b[(nodes[b, level] == nodes[a, level]).any(axis=1)]
        if depth < plan.depth:  # longer matches were examined in an earlier round
            b = b[~(nodes[b, level + 1] == nodes[a, level + 1]).any(axis=1)]
        rows.append(np.full(len(b), a))
        cols.append(b)
    empty = pd.DataFrame({"kind": [], "a": [], "b": [], "n": []})
    pairs = np.stack([np.concatenate(rows), np.concatenate(cols)], axis=1) if rows else []
    if not len(pairs):
        return empty
    similarity = _exact([np.frombuffer(b, dtype=_U) for b in group["shingles"]], pairs)
    linked = similarity >= plan.similarity - 1e-12
    pairs = pairs[linked]
    if not len(pairs):
        return empty
    copies, keys = group["copies"].to_numpy(), group["key"].to_numpy()
    counts = np.bincount(pairs[:, 0], weights=copies[pairs[:, 1]], minlength=n) + \
        np.bincount(pairs[:, 1], weights=copies[pairs[:, 0]], minlength=n)
    root = local_roots(n, pairs[:, 0], pairs[:, 1])
    tied = np.flatnonzero(root != np.arange(n))
    some = np.flatnonzero(counts)
    return pd.concat([
        pd.DataFrame({"kind": LINK, "a": keys[some], "b": 0, "n": counts[some].astype(np.int64)}),
        pd.DataFrame({"kind": EDGE, "a": keys[tied], "b": keys[root[tied]], "n": 0})])


_OUT = "kind int, a bigint, b bigint, n bigint"


def _round(reps: DataFrame, shared: DataFrame, plan: ForestPlan, depth: int) -> DataFrame:
    """All verified links whose longest common prefix in any tree is ``depth``."""
    blocks = _blocks(shared, plan)
    at = shared.join(blocks, "key").select("node", "key", "block")
    wide = at.groupBy("node").agg(F.min("block").alias("b0"), F.max("block").alias("b1")) \
        .where("b0 < b1").select("node")
    at = at.join(wide, "node")
    held = at.select("node", "block").distinct()
    across = held.select("node", F.col("block").alias("i")).join(
        held.select("node", F.col("block").alias("j")), "node").where("i < j") \
        .select("i", "j").distinct()
    # a set in a node of several blocks goes to all pairs of its block, any set to its own block
    sides = across.select("i", "j", F.explode(F.array("i", "j")).alias("block"))
    todo = (sides.join(at.select("key", "block").distinct(), "block")
            .select("i", "j", "key", "block")
            .unionByName(blocks.select(F.col("block").alias("i"), F.col("block").alias("j"),
                                       "key", "block")))
    dealt = todo.join(reps, "key")
    return dealt.groupBy("i", "j").applyInPandas(lambda g: _verify(g, plan, depth), _OUT)


def _with_sets(docs: DataFrame, reps: DataFrame, plan: ForestPlan) -> DataFrame:
    """Attach the sorted shingle hashes to the given sets, from one document of each."""
    texts = docs.join(reps, docs["id"].eqNullSafe(reps["rep"])).select(
        "key", "copies", "n", "nodes", "text")

    def cut(batches):
        for batch in batches:
            column = batch.column(4)
            for first, last, data, bounds in text_slices(column):
                words, at = hash_words(data, bounds, fold=True)
                sets = [shingles(words[at[i]:at[i + 1]], plan.words) for i in range(last - first)]
                keys = np.array([mix(np.sum(mix(s ^ _U(len(s))))[None])[0] if len(s) else 0
                                 for s in sets], dtype=_U).view(np.int64)
                part = batch.slice(first, last - first)
                # a repeated id may carry other texts: keep the one that has this set
                good = pa.array(keys == part.column(0).to_numpy())
                out = pa.RecordBatch.from_arrays(
                    [*part.columns[:4], pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["key", "copies", "n", "nodes", "shingles"])
                yield out.filter(good)

    return texts.mapInArrow(cut, "key bigint, copies bigint, n bigint, nodes binary, "
                                 "shingles binary").dropDuplicates(["key"])


def ngram_links(docs: DataFrame, plan: ForestPlan = ForestPlan(), id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``id, class_id, n_links, set_size, group_id`` for every row.

    Two documents are linked when the Jaccard similarity of their sets of five-word shingles
    (A-Z lower-cased, white space ignored) is at least 0.8. ``class_id`` is the smallest id among
    documents with the same shingle set, ``n_links`` counts all other documents linked, and
    ``group_id`` is the smallest id that links lead to.

    Documents with the same set (a 64-bit hash of the whole set) fold into one before anything is
    joined. Trie nodes are keyed by tree and prefix; only nodes with two or more sets go on. Sets
    are laid out in trie order in blocks of bounded length, and pairs of blocks that share a node
    are verified in one task each on the complete shingle hashes: a pair belongs to exactly one
    pair of blocks, and what leaves a task is a count per set and a spanning forest, so a large
    group yields no list of all its pairs and never meets in one task. Prefixes are shortened by
    one, and only newly matching pairs verified, down to ``plan.last_depth`` in every corpus: the
    many links of a large group say nothing about pairs near the threshold.

    A text of one to four words is one shingle; an empty or NULL text has none and links to
    nothing. Repeated rows and ids count as documents of their own. A NULL id is no ``class_id``.
    An empty table gives no rows; other columns are ignored.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    signed = materialize(_signatures(source, plan), "ngram-signatures")
    real = signed.where("n > 0")
    classes = materialize(
        real.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("rep")),
        "ngram-classes")
    reps = materialize(
        real.join(classes.select("key", "copies", "rep"), "key")
        .where(F.col("id").eqNullSafe(F.col("rep"))).select("key", "copies", "rep", "n", "nodes")
        .dropDuplicates(["key"]), "ngram-sets")
    widest = materialize(_shared(reps, plan, plan.last_depth), "ngram-nodes")
    near = materialize(_with_sets(
        source, reps.join(widest.select("key").distinct(), "key", "left_semi"), plan),
        "ngram-candidates")
    rounds = []
    for depth in range(plan.depth, plan.last_depth - 1, -1):
        shared = widest if depth == plan.last_depth else _shared(near, plan, depth)
        rounds.append(materialize(_round(near, shared, plan, depth), f"ngram-links-{depth}"))
    links = rounds[0]
    for part in rounds[1:]:
        links = links.unionByName(part)
    per_set = links.where(F.col("kind") == LINK).groupBy(F.col("a").alias("key")).agg(
        F.sum("n").alias("others"))
    tree = components(links.where(F.col("kind") == EDGE).select("a", "b"))
    rooted = classes.join(tree, classes["key"] == tree["node"], "left").select(
        "key", "copies", "rep", F.coalesce("root", "key").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("rep").alias("low"))
    known = (rooted.join(lowest, "root").join(per_set, "key", "left")
             .select("key", "copies", "rep", "low", "others"))
    one = F.col("n") > 0
    return signed.select("id", "key", "n").join(known, "key", "left").select(
        F.col("id").alias(id_col), F.when(one, F.col("rep")).otherwise(F.col("id")).alias("class_id"),
        F.when(one, F.col("copies") - 1 + F.coalesce("others", F.lit(0))).otherwise(0)
        .cast("bigint").alias("n_links"),
        F.col("n").alias("set_size"),
        F.when(one, F.col("low")).otherwise(F.col("id")).alias("group_id"))


def drop_near(docs: DataFrame, plan: ForestPlan = ForestPlan(), id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """One document of each group of linked ones: the smallest id. Keeps all columns.

    A row is known by its id and a 64-bit hash of its text: rows that share an id are linked by
    what each of them says, and the same text under the same id stays once. NULL ids come after all
    others, so such a row is kept only if its text is linked to no row that has an id, and of linked
    rows without id one is kept. Texts without a word are linked to nothing and stay. An empty table
    gives no rows.
    """
    row = F.struct(F.col(id_col).isNull().alias("missing"), F.col(id_col).alias("id"),
                   F.xxhash64(text_col).alias("digest"))
    linked = ngram_links(docs.select(row.alias("id"), F.col(text_col).alias("text")), plan, "id")
    stay = linked.where(F.col("id").eqNullSafe(F.col("group_id"))).select(
        F.col("id.id").alias("stay_id"), F.col("id.digest").alias("stay_digest")).distinct()
    digest = fresh(docs, "digest")
    own = docs.withColumn(digest, F.xxhash64(text_col))
    return own.join(stay, own[id_col].eqNullSafe(stay["stay_id"])
                    & (own[digest] == stay["stay_digest"]), "left_semi") \
        .dropDuplicates([id_col, digest]).drop(digest)
