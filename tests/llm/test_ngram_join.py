from __future__ import annotations

import random
from itertools import combinations

import pytest

from rolescope.llm.base import components
from rolescope.llm.ngram_join import ForestPlan, drop_near, ngram_links
from rolescope.llm.queries import QUERIES

from .conftest import frame, text


def shingle_set(t, n=5):
    words = (t or "").encode().lower().split()
    if 0 < len(words) < n:
        n = len(words)
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if words else \
        frozenset()


def brute(corpus, threshold=0.8):
    sets = [shingle_set(t) for _, t, _ in corpus]
    links = [0] * len(sets)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(sets)), 2):
        if sets[a] and sets[b]:
            both = len(sets[a] & sets[b])
            if both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)

    def smallest(members, own):
        ids = [corpus[m][0] for m in members if corpus[m][0] is not None]
        return min(ids) if ids else own

    out = []
    for i, (doc, _, _) in enumerate(corpus):
        if not sets[i]:
            out.append((doc, doc, 0, 0, doc))
            continue
        same = [j for j in range(len(sets)) if sets[j] == sets[i]]
        group = [j for j in range(len(sets)) if sets[j] and find(j) == find(i)]
        out.append((doc, smallest(same, None), links[i], len(sets[i]), smallest(group, None)))
    return sorted(out, key=repr)


# so many trees that no pair at the threshold is missed but with a chance of one in 10 ** 9
SURE = ForestPlan(trees=60, depth=4, recall=1 - 1e-9)


@pytest.mark.parametrize("plan", [SURE, ForestPlan(block=4), ForestPlan()])
def test_links_match_brute_force(docs, corpus, plan):
    assert sorted(map(tuple, ngram_links(docs, plan).collect()), key=repr) == brute(corpus)


def test_prefixes_shorten_until_recall(spark):
    """Pairs near the threshold are found although few share a full-depth prefix."""
    rng = random.Random(3)
    rows = []
    for i in range(40):
        words = text(rng, 100).split()
        other = list(words)
        other[50] = other[30] = "zz"
        rows += [(2 * i, " ".join(words), "a"), (2 * i + 1, " ".join(other), "a")]
    got = ngram_links(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
    assert all(r["n_links"] == 1 for r in got)


def test_large_group_of_near_copies(spark):
    rng = random.Random(5)
    base = text(rng, 150).split()
    rows = []
    for i in range(300):
        words = list(base)
        words[rng.randrange(150)] = f"v{i}"
        rows.append((i, " ".join(words), "a"))
    plan = ForestPlan(trees=60, depth=4, recall=1 - 1e-9, block=32)
    got = ngram_links(frame(spark, rows), plan).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_drop_near_and_empty(docs, corpus, empty_docs):
    assert ngram_links(empty_docs).count() == 0
    kept = drop_near(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect() if r["doc_id"] is not None} == {
        r[0] for r in brute(corpus) if r[0] is not None and r[0] == r[4]}


def test_query(spark, sf_dir):
    rows = [(r["doc_id"], r["text"], None)
            for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = QUERIES["op1_ngram_jaccard_join"](spark, sf_dir).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 100)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(100)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_a_large_group_does_not_end_the_search_for_others(spark):
    """Few trees, so that full depth misses many pairs near the threshold and the last few."""
    rng = random.Random(8)
    rows = []
    for i in range(60):
        words = text(rng, 100).split()
        other = list(words)
        other[50] = other[30] = "zz"
        rows += [(2 * i, " ".join(words), "a"), (2 * i + 1, " ".join(other), "a")]
    base = text(rng, 300).split()
    hot = [(1000 + i, " ".join([*base, f"v{i}"]), "a") for i in range(150)]
    plan = ForestPlan(trees=8, depth=6, recall=0.99)
    assert plan.found(0.8, 6) < 0.92 and plan.last_depth < 6

    def pairs(some):
        return sorted(tuple(r) for r in ngram_links(frame(spark, some), plan).collect()
                      if r["doc_id"] < 1000)

    alone = pairs(rows)
    assert sum(r[2] for r in alone) >= 2 * 57
    assert pairs(rows + hot) == alone
