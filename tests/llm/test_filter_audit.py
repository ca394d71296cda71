from __future__ import annotations

import random
import re
from collections import defaultdict
from itertools import permutations

import numpy as np
import pytest

from rolescope.llm.filter_audit import filter_audit, walk

SCHEMA = "doc_id bigint, text string, lang string, part string, mask int, id string, first string"
LABELS = "doc_id bigint, quality int, toxic int, good string"


def texts(rng):
    out = [None, "", "   ", "one", "A B C", "x#y " * 210, "same same " * 150, "ÀÉ漢字 " * 220]
    for _ in range(40):
        words = [rng.choice("abcdefghij") + str(rng.randrange(rng.choice([5, 5000])))
                 for _ in range(rng.choice([5, 199, 200, 201, 400]))]
        if rng.random() < 0.3:
            words = [w.upper() for w in words]
        if rng.random() < 0.3:
            words[0] += rng.choice("#$%&*|")
        out.append(rng.choice([" ", "\n", "\t", "  \x0b"]).join(words))
    return out


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(5)
    pool = texts(rng)
    rows = [(i, rng.choice(pool), rng.choice(["en", "de", None, ""])) for i in range(150)]
    rows += [(3, *rows[3][1:]), (3, "again", "en"), (None, rows[9][1], "en"), (None, "nameless", None),
             (None, "nameless", None), (1000, "late", "de"), (999, "late", "en"),
             (2000, "w " * 20000, "de")]
    marks = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 150, 2)]
    marks += [(4, 1, 0), (4, 0, 1), (None, 1, 1), (77777, 1, 1)]
    docs = spark.createDataFrame([(*r, "p", 1, "x", "y") for r in rows], SCHEMA).repartition(3)
    return rows, marks, docs, spark.createDataFrame([(*m, "z") for m in marks], LABELS)


def brute(rows, marks):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    good, toxic = ({i for i, *m in marks if m[k] == 1 and i is not None} for k in (0, 1))
    parts = defaultdict(list)
    for i, t, lang in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        parts[lang or ""].append((i, {
            f for f, bad in {
                "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                "D": bool(re.search("[#$%&*|]", t)),
                "E": i is not None and i > first[t]}.items() if bad}))
    out = []
    for part, docs in parts.items():
        mine, shapley = [], defaultdict(int)
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                mine.append([part, "".join(order), step, len(left), len(gone),
                             sum(f in d[1] for d in docs) - len(gone),
                             sum(d[1] == {f} for d in docs), sum(d[0] in good for d in gone),
                             sum(d[0] in toxic for d in gone), f])
        out += [tuple(r[:-1]) + (shapley[r[-1]],) for r in mine]
    return sorted(out)


def test_equals_brute_force(table):
    rows, marks, docs, labels = table
    got = filter_audit(docs, labels)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant",
                           "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, got.collect())) == brute(rows, marks)


def test_steps_add_up_in_every_order(table):
    rows, marks, docs, labels = table
    got = filter_audit(docs, labels).toPandas()
    sizes = {p: sum((r[2] or "") == p for r in rows) for p in ("en", "de", "")}
    for (part, _), g in got.groupby(["part", "filter_order"]):
        assert g["removed"].sum() + g["kept"].min() == sizes[part]
    last = got[got["step"] == 5].groupby("part")["kept"].nunique()
    assert (last == 1).all()  # what survives all filters does not depend on the order


def test_no_labels_and_no_documents(table, spark):
    _, _, docs, labels = table
    none = filter_audit(docs, labels.limit(0)).toPandas()
    assert len(none) == 3 * 600 and not none["good_lost"].any() and not none["toxic_lost"].any()
    assert filter_audit(docs.limit(0), labels).count() == 0


def test_own_filters(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "bb"), (3, "bb"), (4, "ccc")],
                                 "key bigint, body string").selectExpr("*", "'x' AS lang")
    labels = spark.createDataFrame([(4, 1, 0)], "key bigint, quality int, toxic int")
    got = filter_audit(docs, labels, {"S": lambda t: t == "a"}, id_col="key", text_col="body")
    assert sorted((r["filter_order"], r["step"], r["kept"], r["removed"]) for r in got.collect()) \
        == [("ES", 1, 3, 1), ("ES", 2, 2, 1), ("SE", 1, 3, 1), ("SE", 2, 2, 1)]


@pytest.mark.parametrize("filters", [1, 3, 5])
def test_walk_stores_every_subset(filters):
    cells = np.random.default_rng(filters).integers(0, 50, (1 << filters, 2))
    states = walk(cells, filters)
    for subset in range(1 << filters):
        kept = [m for m in range(1 << filters) if not m & subset]
        assert (states[subset] == cells[kept].sum(axis=0)).all()
