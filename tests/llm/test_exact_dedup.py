from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest

import corpus_pipeline
from rolescope.llm.exact_dedup import drop_exact, exact_groups

from .conftest import frame


def brute(corpus, pick):
    groups = defaultdict(list)
    for i, t, _ in corpus:
        groups[(t or "").encode().lower()].append(i)
    out = []
    for i, t, _ in corpus:
        body = (t or "").encode().lower()
        ids = [x for x in groups[body] if x is not None]
        keep = pick(ids) if ids else None
        out.append((i, keep, len(groups[body]), i is not None and i == keep,
                    hashlib.sha256(body).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep,pick", [("smallest", min), ("largest", max)])
@pytest.mark.parametrize("bits", [128, 8])
def test_groups_match_brute_force(docs, corpus, keep, pick, bits):
    """With 8 bits of hash most groups collide and only the bytes tell them apart."""
    got = exact_groups(docs, keep=keep, hash_bits=bits)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(corpus, pick)


def test_folds_ascii_letters_only(spark):
    df = spark.createDataFrame([(1, "É A"), (2, "é a"), (3, "É a"), (4, "K")],
                               "doc_id int, text string")
    assert {r[0]: r[1] for r in exact_groups(df).collect()} == {1: 1, 2: 2, 3: 1, 4: 4}


def test_empty_table_and_drop(docs, corpus, empty_docs):
    assert exact_groups(empty_docs).count() == 0
    kept = drop_exact(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({r[1] for r in brute(corpus, min) if r[1] is not None})


def test_no_text_is_lost(spark, sf_dir, corpus):
    """Texts without any id, and different texts that share an id, each keep one row."""
    rows = [*corpus, (None, "No Id Twice", "a"), (None, "no id twice", "b"),
            (9000, "one text", "a"), (9000, "another text", "a"),
            (9001, "held by a smaller id", "a"), (9001, "by this id alone", "a"),
            (8999, "Held by a smaller id", "a")]
    kept = [(r["doc_id"], (r["text"] or "").encode().lower()) for r in
            corpus_pipeline.drop_copies(spark, frame(spark, rows), sf_dir).collect()]
    texts = [t for _, t in kept]
    assert len(texts) == len(set(texts))
    assert set(texts) == {(t or "").encode().lower() for _, t, _ in rows}
    assert (8999, b"held by a smaller id") in kept and (None, b"no id twice") in kept
    assert {t for i, t in kept if i == 9000} == {b"one text", b"another text"}


def test_texts_stay_in_the_jvm(docs, capsys):
    """Whole texts in Python workers, beside the JVM's copies, took an executor over its memory."""
    exact_groups(docs).explain()
    drop_exact(docs).explain()
    plans = capsys.readouterr().out
    assert "Join" in plans
    assert "MapInArrow" not in plans


def test_letters_beyond_ascii_keep_their_case(spark):
    """Dotted and Kelvin letters, sharp s and control characters: only A-Z change."""
    texts = ["İI", "KK", "ẞß SS", "A\x00B", "ÀZ\U00010400", "", None, "Plain ASCII Z[@"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    assert {r["doc_id"]: r["text_sha256"] for r in exact_groups(df).collect()} == {
        i: hashlib.sha256((t or "").encode().lower()).hexdigest() for i, t in enumerate(texts)}
