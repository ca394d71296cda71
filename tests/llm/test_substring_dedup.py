from __future__ import annotations

import hashlib
import random

import numpy as np

from rolescope.llm.queries import QUERIES
from rolescope.llm.substring_dedup import parse, repeated_spans, sliding_min

from .conftest import frame, text


def brute(corpus, window):
    first = {}
    texts = [(i, (t or "").encode().split()) for i, t, _ in corpus]
    for i, words in texts:
        for s in range(len(words) - window + 1):
            key = tuple(words[s:s + window])
            if i is not None and (key not in first or i < first[key]):
                first[key] = i
    out = []
    for i, words in texts:
        keep = [True] * len(words)
        for s in range(len(words) - window + 1):
            low = first.get(tuple(words[s:s + window]))
            if low is not None and (i is None or low < i):
                keep[s:s + window] = [False] * window
        kept = [w for w, k in zip(words, keep) if k]
        out.append((i, len(words), len(words) - len(kept),
                    hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r)[:4] for r in df.collect()), key=repr)


def test_removed_words_match_brute_force(docs, corpus):
    for window in (50, 8, 2):
        assert got(repeated_spans(docs, window)) == brute(corpus, window)


def test_periodic_and_straddling_texts(spark):
    rng = random.Random(11)
    a, b = text(rng, 60), text(rng, 60)
    rows = [(1, "x " * 200, None), (2, "x " * 49, None), (3, "x " * 120 + "y", None),
            (4, a, None), (5, b, None), (6, "q " + a + " " + b + " r", None), (7, a + " " + b, None),
            (8, " ".join((a + " " + b).split()[30:90]), None), (None, b, None), (5, b, None)]
    assert got(repeated_spans(frame(spark, rows))) == brute(rows, 50)


def test_factors_name_their_reference(spark):
    rng = random.Random(12)
    a, b = text(rng, 60), text(rng, 55)
    rows = [(1, a, None), (2, b, None), (3, "u v " + a + " " + b + " w", None)]
    factors = {r["doc_id"]: [tuple(f) for f in r["factors"]]
               for r in repeated_spans(frame(spark, rows)).collect()}
    assert factors == {1: [], 2: [], 3: [(2, 62, 1), (62, 117, 2)]}
    assert parse([0, 1, 2, 5], [1, 1, 4, 4], 3) == [(0, 4, 1), (2, 5, 4), (5, 8, 4)]


def test_sliding_min():
    values = np.random.default_rng(1).integers(0, 50, 200)
    for width in (1, 2, 5, 26, 64, 200, 201):
        want = [values[i:i + width].min() for i in range(len(values) - width + 1)]
        assert sliding_min(values, width).tolist() == want


def test_empty_and_query(spark, sf_dir, empty_docs):
    assert repeated_spans(empty_docs).count() == 0
    rows = [(r["doc_id"], r["text"], None)
            for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert got(QUERIES["op3_substring_dedup"](spark, sf_dir)) == brute(rows, 50)
