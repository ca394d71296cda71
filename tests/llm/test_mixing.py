from __future__ import annotations

import re

import pytest

from rolescope.llm import mixing
from rolescope.llm.mixing import Curriculum, mix, mix_plan, mixed_documents, training_order


def targets(sizes, weights, cap=3):
    """Water filling by rounds: share, stop what overflows, share the rest again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    names += [None] if None in sizes else []
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, left, rest = {}, set(names), float(sum(sizes.values()))
    while left:
        unit = rest / sum(weight[s] for s in left)
        over = [s for s in left if weight[s] * unit > cap * sizes[s]]
        if not over:
            return out | {s: weight[s] * unit for s in left}
        for s in over:
            out[s] = float(cap * sizes[s])
            rest -= out[s]
            left.remove(s)
    return out


def test_targets_and_taken(docs, corpus):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in corpus]
    per = {}
    for (_, _, s), n in zip(corpus, size):
        per[s] = per.get(s, 0) + n
    want = targets(per, (1, 2, 3))
    rows = mix_plan(docs).collect()
    assert sorted([(r["doc_id"], r["size"], r["source_size"]) for r in rows], key=repr) == sorted(
        [(i, n, per[s]) for (i, _, s), n in zip(corpus, size)], key=repr)
    taken = {}
    for r in rows:
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    largest = max(size)
    for s, t in taken.items():
        assert abs(t - want[s]) <= largest / 2 + 1
    assert sorted(map(repr, rows)) == sorted(map(repr, mix_plan(docs).collect()))


def test_mix_repeats_and_orders(docs):
    plan = {r["doc_id"]: r["copies"] for r in mix_plan(docs).collect() if r["doc_id"] is not None}
    rows = mix(docs).collect()
    positions = [r["position"] for r in rows]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] <= 1
    seen = {}
    for r in rows:
        if r["doc_id"] is not None:
            seen[r["doc_id"]] = seen.get(r["doc_id"], 0) + 1
    assert {k: v for k, v in seen.items() if k != 3} == {
        k: v for k, v in plan.items() if v and k != 3}


def test_schedule_shapes_positions(spark):
    df = spark.createDataFrame([(2 * i + (s == "b"), "w " * 10, s) for i in range(400)
                                for s in ("a", "b")],
                               "doc_id int, text string, source string")
    plan = Curriculum(weights=(1,), schedules={
        "a": ((0.0, 0.0), (1.0, 2.0)), "b": ((0.0, 2.0), (1.0, 0.0))})
    rows = mix(df, plan).collect()
    late = [r["position"] for r in rows if r["source"] == "a"]
    early = [r["position"] for r in rows if r["source"] == "b"]
    assert sum(p < 0.5 for p in late) == pytest.approx(100, abs=3)  # integral of 2t up to 1/2
    assert sum(p < 0.5 for p in early) == pytest.approx(300, abs=3)


def test_empty(empty_docs):
    assert mix_plan(empty_docs).count() == 0 and mix(empty_docs).count() == 0


def test_the_sequence_is_built_and_counted(docs):
    """All copies stand in one sequence in training order; the rows come from counting it."""
    planned = mix_plan(docs)
    places = [r["position"] for r in training_order(planned).collect()]
    assert places == sorted(places) and 0 <= places[0] and places[-1] <= 1
    assert len(places) == sum(r["copies"] for r in planned.collect())
    columns = ["doc_id", "size", "source", "copies", "taken", "first_position"]
    want = [tuple(r[c] for c in columns) for r in planned.collect()]
    got = [tuple(r[c] for c in columns) for r in mixed_documents(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_the_query_counts_the_sequence(spark, sf_dir, monkeypatch):
    from rolescope.llm.queries import QUERIES
    order = mixing.training_order
    monkeypatch.setattr(mixing, "training_order",
                        lambda *args: order(*args).where("copy = 0"))
    rows = QUERIES["op9_source_mixing"](spark, sf_dir).collect()
    assert {r["copies"] for r in rows} <= {0, 1}


def test_empty_sequence(empty_docs):
    assert mixed_documents(empty_docs).count() == 0
