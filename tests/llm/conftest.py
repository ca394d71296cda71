from __future__ import annotations

import random

import pytest

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string"
WORDS = [a + b for a in ("ba", "de", "ki", "lo", "mu", "na", "po", "ri", "su", "te")
         for b in ("l", "m", "n", "r", "s", "t", "x", "ck", "nd", "sh")]


def text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def frame(spark, rows):
    """Documents with an extra column that clashes with an internal name; rows (id, text, source)."""
    full = [(i, t, "en", s, None if t is None else len(t), "x") for i, t, s in rows]
    return spark.createDataFrame(full, DOC_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def corpus():
    """(id, text, source): copies, near copies, shared passages, empty, NULL and long texts."""
    rng = random.Random(7)
    rows, n = [], 0

    def add(t, source="s1"):
        nonlocal n
        rows.append((n, t, source))
        n += 1

    passage = text(rng, 70)
    for _ in range(30):
        add(text(rng, rng.randint(40, 160)), rng.choice(["s1", "s2", "s3", None]))
    for _ in range(12):
        base = text(rng, 120)
        add(base)
        add(base.upper() if rng.random() < 0.5 else base, "s2")
        words = base.split()
        for k in range(4):
            changed = list(words)
            for _ in range(1 + k):
                changed[rng.randrange(len(changed))] = "zz" + str(rng.randrange(1000))
            add(" ".join(changed), "s3")
    for _ in range(6):
        add(text(rng, 30) + "\n" + passage + "  " + text(rng, 25))
    add(passage[: len(passage) // 2])
    add("one two three")
    add("one two three")
    add("", "s2")
    add(None, None)
    add("   \n\t ", "s2")
    add(text(rng, 5000), "s4")
    add("unbroken" * 4000, "s4")
    add("naïve Ünïcode — “quotes” 漢字 " * 12)
    rows.append((3, rows[3][1], rows[3][2]))  # a repeated row
    rows.append((None, text(rng, 60), "s1"))
    rows.append((None, rows[5][1], None))
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return frame(spark, corpus)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return frame(spark, []).limit(0)
