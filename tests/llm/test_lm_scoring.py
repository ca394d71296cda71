from __future__ import annotations

import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rolescope.llm.lm_scoring import (LmPlan, _count_words, _descend, _features, _pack, _run_sums,
                                      _softmax, _unpack, lm_scores)
from rolescope.llm.queries import QUERIES
from rolescope.llm.word_tree import LAYERS, PARTS, UNIT, Paths, Tree, part_of, weights

from .conftest import frame


def brute(rows):
    def tokens(t):
        return [*(t or "").encode().lower().split(), None]

    def held(i):
        return zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2

    counts = Counter(w for i, t, _ in rows if not held(i) for w in tokens(t))
    total, words = sum(counts.values()), len(counts)
    return sorted(((i, held(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total,
                    sum(math.log10((counts[w] + 1) / (total + words + 1)) for w in tokens(t)))
                   for i, t, _ in rows), key=repr)


def check(got, rows):
    want = brute(rows)
    got = sorted(map(tuple, got), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want])
    assert all(math.isfinite(g[6]) and g[6] <= 0 for g in got)


@pytest.mark.parametrize("chunk", [16 << 20, 2000])
def test_counts_match_brute_force(docs, corpus, chunk):
    got = lm_scores(docs, LmPlan(chunk_bytes=chunk)).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    check(got.collect(), corpus)


def test_probabilities_sum_to_one(spark):
    """One-word documents in every outcome: known words, and one unseen, with equal context."""
    rng = random.Random(1)
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choices(words, weights=range(1, 41), k=12)), None)
            for i in range(400)]
    known = {w for i, t, _ in rows if zlib.crc32(str(i).encode()) % 7 != 2 for w in t.split()}
    probes = [i for i in range(1000, 9000) if zlib.crc32(str(i).encode()) % 7 == 2]
    asked = [*sorted(known), "unseen"]
    rows += [(i, w, None) for i, w in zip(probes, asked)]
    rows.append((probes[len(asked)], "", None))
    out = {r["doc_id"]: r["score"] for r in lm_scores(frame(spark, rows)).collect()}
    # P(word, end) = P(word) P(end | word): leave out the second factor by bounding it by one
    total = sum(10 ** out[i] for i, _ in zip(probes, asked)) + 10 ** out[probes[len(asked)]]
    assert total <= 1.0 + 1e-6


def test_held_out_texts_gain_over_the_base(spark):
    """Words of two vocabularies that never mix: context tells which one is spoken."""
    rng = random.Random(2)
    ends = [("kla", "lmo", "mni", "nra", "zwe"), ("rsu", "tze", "vpo", "bdi", "hjo")]
    vocab = [[f"w{i}{e[i % 5]}" for i in range(60)] for e in ends]
    rows = [(i, " ".join(rng.choices(vocab[i % 2], k=60)), None) for i in range(800)]
    plan = LmPlan(batch=128, rounds=6)
    got = [r for r in lm_scores(frame(spark, rows), plan).collect() if r["held_out"]]
    assert len(got) > 50
    gain = sum(r["score"] - r["base_score"] for r in got) / sum(r["n_tokens"] for r in got)
    assert gain > 0.05


def test_empty_pack_and_query(spark, sf_dir, empty_docs):
    assert lm_scores(empty_docs).count() == 0
    ids = np.array([0, 1, 255, 256, 70_000, 2 ** 31])
    assert _unpack(_pack(ids)).tolist() == ids.tolist()
    rows = [(r["doc_id"], r["text"], None)
            for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = QUERIES["op7_lm_scoring"](spark, sf_dir).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    check(got.collect(), rows)
    held = [r for r in got.collect() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_held_out_texts_gain_by_two_endings(spark):
    """Two vocabularies that never mix, each of one ending: the classes must tell these apart."""
    rng = random.Random(2)
    vocab = [[f"w{i}xx{c}" for i in range(60)] for c in "ab"]
    rows = [(i, " ".join(rng.choices(vocab[i % 2], k=60)), None) for i in range(800)]
    plan = LmPlan(batch=128, rounds=6)
    got = [r for r in lm_scores(frame(spark, rows), plan).collect() if r["held_out"]]
    assert len(got) > 50
    gain = sum(r["score"] - r["base_score"] for r in got) / sum(r["n_tokens"] for r in got)
    assert gain > 0.15


def test_context_is_the_third_word_back_too():
    """Only the third word before differs."""
    lens, code = np.array([4]), np.arange(10, 16).astype(np.uint64)
    kind = np.ones(6, dtype=np.int64)
    a, b = (_features(np.array([first, 2, 3, 4]), lens, code, kind, LmPlan())[3]
            for first in (0, 1))
    assert (a != b).sum() == 1


def test_rare_words_are_context(spark):
    """Words of under one in 4,096 tokens, all of one ending, each followed by its own target."""
    rng = random.Random(4)
    rows = []
    for i in range(700):
        pairs = [rng.randrange(3000) for _ in range(130)]
        rows.append((i, " ".join(f"c{p}xyz {('alpha', 'omega')[p % 2]}" for p in pairs), None))
    got = [r for r in lm_scores(frame(spark, rows), LmPlan(batch=512, rounds=4)).collect()
           if r["held_out"]]
    gain = sum(r["score"] - r["base_score"] for r in got) / sum(r["n_tokens"] for r in got)
    assert gain > 0.33


def test_buckets_grow_with_the_vocabulary():
    plan = LmPlan()
    assert [plan.grown(n).buckets for n in (0, 1000, 100_000, 10 ** 9)] == [
        1 << 13, 1 << 13, 1 << 15, plan.most_buckets]


def plain_step(w, square, features, target, rate):
    """The AdaGrad step, a gradient for each feature of each token added one by one."""
    z = w[0].astype(float) + sum(w[features[:, k]].astype(float) for k in range(features.shape[1]))
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(len(target)), target] -= 1
    g = np.zeros(w.shape)
    np.add.at(g, features, p[:, None] / len(target))
    g[0] += p.sum(axis=0) / len(target)
    square += g * g
    w -= rate * g / np.sqrt(square)


@pytest.mark.parametrize("buckets", [40, 1 << 16, 1 << 17])
def test_a_step_matches_the_plain_one(buckets):
    """Few buckets: runs of hundreds of rows; many: 16 bits are full, or too few."""
    rng = np.random.default_rng(7)
    dtype = np.min_scalar_type(buckets - 1)
    w = rng.normal(size=(buckets, 32)).astype(np.float32)
    square = np.full_like(w, 1e-4)
    want, want_square = w.astype(float), square.astype(float)
    for n in (1, 700, 1000):
        features = (buckets - 1 - rng.geometric(0.2 if buckets < 100 else 0.001, (n, 5))
                    % (buckets - 1)).astype(dtype)
        target = rng.integers(0, 32, n)
        plain_step(want, want_square, features, target, 0.2)
        _descend(w, square, features, target, 0.2)
        assert w == pytest.approx(want, abs=1e-4)
        assert square == pytest.approx(want_square, rel=1e-3, abs=1e-7)


def test_weights_of_any_size_give_probabilities():
    for size in (1.0, 50.0, 1e4):
        w = np.linspace(-size, size, 40 * 32, dtype=np.float32).reshape(40, 32)
        p = _softmax(w, w[0], np.arange(10, 40).reshape(6, 5))
        assert np.isfinite(p).all() and p.sum(axis=1) == pytest.approx(np.ones(6), abs=1e-5)
        assert (p.argmax(axis=1) == 31).all()


def test_sums_of_runs_are_not_taken_run_by_run():
    """As many runs as a batch has, most of one row: reduceat took most of a step's time."""
    rng = np.random.default_rng(3)
    p = rng.normal(size=(4096, 32)).astype(np.float32)
    flat = np.sort(np.concatenate([rng.zipf(1.3, 10240) % 65536, rng.integers(0, 65536, 10240)]))
    starts = np.flatnonzero(np.diff(flat, prepend=-1))
    rows = rng.integers(0, 4096, len(flat))

    def seconds(f):
        best = math.inf
        for _ in range(7):
            start = time.process_time()
            f()
            best = min(best, time.process_time() - start)
        return best

    assert _run_sums(p, rows, starts) == pytest.approx(
        np.add.reduceat(p[rows], starts, axis=0), abs=1e-2)
    assert 1.5 * seconds(lambda: _run_sums(p, rows, starts)) < seconds(
        lambda: np.add.reduceat(p[rows], starts, axis=0))


def vocabulary(seed=5, classes=4):
    """Counts, classes, hashes and ranks of words, and their tree, as the operator makes them."""
    rng = np.random.default_rng(seed)
    count = np.concatenate([rng.zipf(1.6, 900) % 5000, np.ones(50, np.int64), [0, 0]])
    code = rng.choice(1 << 32, len(count), replace=False).astype(np.uint64)
    cls = np.where(count >= 2, rng.integers(1, classes, len(count)), 0)
    rows = []
    for part in np.unique(part_of(code)):
        own = np.flatnonzero(part_of(code) == part)
        table = pa.table({"tok": code[own].view(np.int64), "place": own,
                          "seen": count[own] * 256 + np.maximum(cls[own], 1)})
        rows += _count_words(table, classes).to_pylist()
    rank = np.zeros(len(count), dtype=np.int64)
    sizes, mass = np.zeros((classes * LAYERS, PARTS), np.int64), np.zeros(classes * LAYERS)
    for r in rows:
        if r["chunk"] < 0:
            sizes[r["place"], -1 - r["chunk"]] = r["rank"]
            mass[r["place"]] += r["c"]
        else:
            assert r["c"] == count[r["place"]] and r["first"]
            rank[r["place"]] = r["rank"]
    return count, cls, Paths(Tree(sizes, mass, classes), count, cls, code, rank)


def test_shares_of_a_class_sum_to_one_in_every_context():
    count, cls, paths = vocabulary()
    rng = np.random.default_rng(6)
    tables = [np.append(rng.normal(size=1 << 10), 0).astype(np.float32) for _ in range(2)]
    contexts = [np.array([5, 7, 9], dtype=np.uint32), np.array([0, 11, 13], dtype=np.uint32)]
    words = np.flatnonzero(count > 0)
    plain = 10 ** paths.log_share(words, np.zeros(len(words), np.int64), contexts, [])
    for k in range(4):
        own = words[cls[words] == k]
        for c in range(3):
            before = np.full(len(own), c)
            share = 10 ** paths.log_share(own, before, contexts, tables)
            assert share.sum() == pytest.approx(1, abs=1e-4)
            assert abs(share - plain[cls[words] == k]).max() > 1e-3  # the context is heard
    # without weights the tree gives the words' shares, to within the breadth of a layer
    total = np.bincount(cls[words], weights=count[words])
    ratio = plain / (count[words] / total[cls[words]])
    assert 0.6 < ratio.min() and ratio.max() < 1.6
    assert (paths.length[count == 0] == 0).all()


def test_words_of_one_class_are_told_apart_by_context(spark):
    """One ending, so one class: which of its words comes depends on the word before."""
    rng = random.Random(8)
    rows = [(i, " ".join(f"q{p}a w{p}xyz" for p in rng.choices(range(8), k=40)), None)
            for i in range(400)]
    got = [r for r in lm_scores(frame(spark, rows)).collect() if r["held_out"]]
    gain = sum(r["score"] - r["base_score"] for r in got) / sum(r["n_tokens"] for r in got)
    known = [r for r in lm_scores(frame(spark, rows), LmPlan(ridge=1e12)).collect() if r["held_out"]]
    static = sum(r["score"] - r["base_score"] for r in known) / sum(r["n_tokens"] for r in known)
    assert gain > static + 0.2


@pytest.mark.parametrize("by_ending", [True, False])
def test_gradients_inside_classes_match_the_plain_ones(by_ending):
    count, cls, paths = vocabulary()
    rng = np.random.default_rng(9)
    words = rng.choice(np.flatnonzero(count > 0), 400)
    before, n = rng.integers(0, 3, 400), rng.integers(1, 9, 400)
    contexts = [np.array([5, 7, 9], dtype=np.uint32), np.array([0, 11, 13], dtype=np.uint32)]
    tables = [] if by_ending else [np.append(rng.normal(size=1 << 10), 0).astype(np.float32)]
    sums = np.zeros((1 << 10) + 1, dtype=np.int64)
    paths.learn(words, n, before, contexts, tables, sums)
    push, curve = np.zeros(len(sums)), np.zeros(len(sums))
    for w, b, c in zip(words, before, n):
        for i in range(paths.first[w], paths.first[w] + paths.length[w]):
            at, one = np.array([i]), np.array([1])
            z = float(paths.odds[i])
            if tables:
                z += paths.sign[i] * tables[0][paths.cells(at, one, contexts[0][[b]], 1 << 10)[0]]
            p = 1 / (1 + math.exp(-z))
            cell = paths.cells(at, one, contexts[len(tables)][[b]], 1 << 10)[0]
            push[cell] += c * paths.sign[i] * (1 - p)
            curve[cell] += c * p * (1 - p)
    assert (sums >> 32) / UNIT == pytest.approx(push, abs=0.2)
    assert (sums & 0xFFFFFFFF) / UNIT == pytest.approx(curve, abs=0.2)
    assert weights(push, curve, 1.0)[-1] == 0 and abs(weights(push, curve, 1.0)).max() <= 2
