from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from rolescope.llm.queries import QUERIES
from rolescope.llm.spelling import FmIndex, SpellingPlan, near_words, spelling_forms

from .conftest import frame

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def brute_counts(rows):
    counts = Counter()
    fold = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for i, t, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(fold)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    p = 0
    while p < len(a) and a[p] == b[p]:
        p += 1
    return a[p + (len(a) == len(b)):] == b[p + 1:]


def brute_near(counts):
    """Near words by their deletions, checked letter by letter."""
    by = {}
    for w in counts:
        for k in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            by.setdefault(k, []).append(w)
    near = {w: set() for w in counts}
    for group in by.values():
        for w in group:
            near[w] |= {x for x in group if one_apart(w, x)}
    return near


def brute(rows):
    counts = brute_counts(rows)
    near = brute_near(counts)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 5 * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted((w, form[w] or "", root(w), n, len(near[w]), counts.get(form[w], -1))
                  for w, n in counts.items())


def plain(got):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"],
                   -1 if r["form_n"] is None else r["form_n"]) for r in got)


def varied(rng, n, letters="abcdéÿ"):
    """Words with many near ones, of counts that make chains."""
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 11))) for _ in range(n)]
    out = Counter()
    for w in base:
        k = rng.choice([5, 6, 30, 160, 800])
        for _ in range(4):
            out[w] += k
            at = rng.randrange(len(w))
            w = rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice(letters) + w[at:],
                            w[:at] + rng.choice(letters) + w[at + 1:]])
            k = max(5, k // 5)
    return {w: n for w, n in out.items() if len(w) >= 6}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    counts = varied(rng, 60)
    flat = [w if rng.random() < 0.7 else w.upper().replace("É", "é").replace("Ÿ", "ÿ")
            for w, n in counts.items() for _ in range(n)]
    rng.shuffle(flat)
    out, at, i = [], 0, 0
    while at < len(flat):
        step = rng.choice([1, 3, 20, 400])
        sep = rng.choice([" ", "\n", "1", "-", "Ā", "_"])
        out.append((i, sep.join(flat[at:at + step]), "s"))
        at, i = at + step, i + 1
    return out + [(i, None, None), (i, "", "s"), (None, "abcabc abcabd " * 9, None),
                  (None, "abcabc abcabd " * 9, None), (0, out[0][1], "s"),
                  (i + 1, "×÷Àabcdef " * 7, "s"), (i + 2, "longest" * 3000, "s")]


def test_equals_brute_force(spark, rows):
    got = spelling_forms(frame(spark, rows))
    assert got.columns == COLUMNS
    assert plain(got.collect()) == brute(rows)


def test_blocks_do_not_change_the_result(spark, rows):
    """Tiny blocks: halves that many words share are dealt to several."""
    small = SpellingPlan(block_words=7, batch=3, held=10)
    assert plain(spelling_forms(frame(spark, rows), small).collect()) == brute(rows)


def test_query_on_whole_table(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in
            spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert plain(QUERIES["op13_spelling_variants"](spark, sf_dir).collect()) == brute(rows)


def test_hot_half(spark):
    """A third of the words share their first half, another third their last one."""
    rng = random.Random(2)
    words = {"prefix" + "".join(rng.choice("abc") for _ in range(6)) for _ in range(300)}
    words |= {"".join(rng.choice("abc") for _ in range(6)) + "suffix" for _ in range(300)}
    words |= {"".join(rng.choice("abc") for _ in range(9)) for _ in range(300)}
    counts = {w: rng.choice([5, 30, 200]) for w in words}
    near = brute_near(counts)
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    got = near_words(df, SpellingPlan(block_words=50)).collect()
    assert {r["word"]: (r["n_near"], r["best"]) for r in got} == {
        w: (len(o), min(o, key=lambda x: (-counts[x], x), default=None)) for w, o in near.items()}


def test_empty_table(spark, empty_docs):
    got = spelling_forms(empty_docs)
    assert got.columns == COLUMNS and got.count() == 0
    assert spelling_forms(frame(spark, [(1, None, None), (2, "short", None)])).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_index_finds_one_edit(seed):
    words = sorted(w.encode("latin-1") for w in varied(random.Random(seed), 40))
    index = FmIndex(words)
    for length in {len(w) for w in words}:
        mine = [w for w in words if len(w) == length]
        codes = index.code[np.frombuffer(b"".join(mine), dtype=np.uint8).reshape(len(mine), length)]
        for exact in (0, 3, length):
            q, w = index.one_edit(codes, length, exact)
            got = {(mine[a], words[b]) for a, b in zip(q, w) if mine[a] != words[b]}
            assert got == {(a, b) for a in mine for b in words
                           if one_apart(a, b) and b.endswith(a[length - exact:])
                           and (one_apart(a[:length - exact], b[:len(b) - exact]))}


def test_index_rows_are_the_sorted_suffixes():
    words = [b"banana", b"bandana", b"ananas"]
    index = FmIndex(words)
    text = b"|" + b"|".join(words) + b"|\0"
    order = sorted(range(len(text)), key=lambda i: text[i:].replace(b"|", b"\1"))
    assert index.suffixes.tolist() == order
