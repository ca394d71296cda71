from __future__ import annotations

import math

import numpy as np
import pytest

from rolescope.llm.queries import QUERIES
from rolescope.llm.vector_links import CoverTree, near_pairs, unit, vector_links

SCHEMA = "vec_id bigint, embedding array<float>, label int, key string"


def brute(rows, cosine=0.98):
    def usable(v, label):
        return label is not None and v is not None and len(v) and all(
            x is not None and math.isfinite(x) for x in v) and any(v)

    good = [i for i, (_, v, label) in enumerate(rows) if usable(v, label)]
    root = list(range(len(rows)))
    links = [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, i in enumerate(good):
        for j in good[a + 1:]:
            x, y = (np.float32(rows[k][1]).astype(float) for k in (i, j))
            if rows[i][2] == rows[j][2] and len(x) == len(y) and \
                    x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    out = []
    for i, (vec, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in good if i in good and find(j) == find(i)
               and rows[j][0] is not None]
        low = (min(ids) if ids else None) if i in good else vec
        out.append((vec, links[i], low, vec == low))
    return sorted(out, key=repr)


def sample(n=260, dims=12, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, dims))
    rows = []
    for i in range(n):
        spread = rng.choice([0.01, 0.1, 0.3])
        v = centres[rng.integers(20)] + rng.normal(size=dims) * spread
        rows.append((i, np.float32(v).tolist(), int(rng.integers(2))))
    rows += [(900, rows[0][1], rows[0][2]), (901, rows[0][1], rows[0][2]), (5, rows[5][1], 0),
             (902, None, 1), (903, [0.0] * dims, 1), (904, [1.0] * (dims - 1) + [None], 1),
             (905, [float("nan")] * dims, 1), (906, [float("inf")] * dims, 1), (907, [], 1),
             (908, rows[0][1], None), (909, [1.0, 2.0], 1), (910, [2.0, 4.0], 1),
             (None, rows[3][1], rows[3][2]), (None, [9.0, -1.0], 0),
             (911, [1e30, 1e30], 5), (912, [1e-30, 1e-30], 5)]
    return rows


@pytest.mark.parametrize("leaf", [1024, 40, 7])
def test_links_match_brute_force(spark, leaf):
    rows = sample()
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)
    assert sorted(map(tuple, vector_links(df, leaf=leaf).collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("limit", [0.05, 0.2, 0.9])
def test_dual_traversal_finds_every_pair(limit):
    rng = np.random.default_rng(4)
    x = unit(np.repeat(rng.normal(size=(40, 5)), 8, axis=0) + rng.normal(size=(320, 5)) * 0.1)
    a, b = CoverTree(x[:200], limit / 2), CoverTree(x[150:], limit / 2)
    i, j = near_pairs(a, b, limit, step=500)
    away = np.sqrt(np.maximum(2 - 2 * x[:200] @ x[150:].T, 0))
    want = set(zip(*np.nonzero(away <= limit - 1e-9)))
    pairs = list(zip(i.tolist(), j.tolist()))
    assert len(pairs) == len(set(pairs)) and want <= set(pairs)


def test_cover_tree_is_nested():
    x = unit(np.random.default_rng(5).normal(size=(300, 3)))
    tree = CoverTree(x, 0.05)
    for below, above in zip(tree.centres, tree.centres[1:]):
        assert set(above) <= set(below) and len(above) < len(below)


def test_empty_and_query(spark, sf_dir):
    assert vector_links(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(r["vec_id"], r["embedding"], r["label"])
            for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = QUERIES["op5_embedding_near_dedup"](spark, sf_dir).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
