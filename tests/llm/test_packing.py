from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rolescope.llm.packing import WordIds, pack, plan_bins
from rolescope.llm.queries import QUERIES, TOKENIZER


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aB é\t\n\r\x0b\x0c\x1c\x85́ 　's’1.ΣİßK漢가<|endoftext|>",
               max_size=40))
def test_word_cache_equals_tokenizer(value):
    direct = Tokenizer.from_file(TOKENIZER) if not hasattr(test_word_cache_equals_tokenizer, "t") \
        else test_word_cache_equals_tokenizer.t
    test_word_cache_equals_tokenizer.t = direct
    words = getattr(test_word_cache_equals_tokenizer, "w", None) or WordIds(TOKENIZER)
    test_word_cache_equals_tokenizer.w = words
    assert np.frombuffer(words.encode(value), "<u4").tolist() == \
        direct.encode(value, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(25))
def test_plan_places_every_piece_once(seed):
    rng = random.Random(seed)
    cap = rng.choice([7, 30, 100, 4096])
    counts = {rng.randint(1, cap): rng.randint(1, 300) for _ in range(rng.randint(1, 60))}
    runs, bins = plan_bins(counts, cap)
    filled, placed = defaultdict(list), defaultdict(list)
    for length, rank, number, first, per_bin, offset in runs:
        for r in range(number):
            placed[length].append(rank + r)
            filled[first + r // per_bin].append((offset + r % per_bin * length, length))
    assert {k: len(v) for k, v in placed.items()} == counts
    assert all(sorted(v) == list(range(len(v))) for v in placed.values())
    assert sorted(filled) == list(range(bins))
    for content in filled.values():
        end = 0
        for offset, length in sorted(content):
            assert offset == end
            end += length
        assert end <= cap
        assert sum(3 * n > cap for _, n in content) <= 2
    need = max(-(-sum(k * v for k, v in counts.items()) // cap),
               sum(v for k, v in counts.items() if 2 * k > cap))
    assert bins <= need * 11 / 9 * 1.2 + 1


def check(rows, corpus, tokenizer, cap):
    expected = []
    for i, t, _ in corpus:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for k, s in enumerate(range(0, len(ids), cap)):
            part = np.asarray(ids[s:s + cap], "<u4").tobytes()
            expected.append((i, k, s, len(part) // 4, zlib.crc32(part)))
    assert sorted([tuple(r)[:5] for r in rows], key=repr) == sorted(expected, key=repr)
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for content in bins.values():
        end = 0
        for offset, length in sorted(content):
            assert offset == end
            end += length
        assert end <= cap


def test_pack_round_trip(docs, corpus, tokenizer):
    check(pack(docs, TOKENIZER, 64).collect(), corpus, tokenizer, 64)


def test_empty(empty_docs):
    assert pack(empty_docs, TOKENIZER).count() == 0


def test_query(spark, sf_dir, tokenizer):
    rows = QUERIES["op2_best_fit_packing"](spark, sf_dir).collect()
    source = [(r["doc_id"], r["text"], None)
              for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(rows, source, tokenizer, 4096)
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= -(-total // 4096) + 1
