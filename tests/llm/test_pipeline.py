from __future__ import annotations

import random
from collections import Counter

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from rolescope.llm.queries import TOKENIZER

from .conftest import text
from .test_ngram_join import shingle_set
from .test_packing import check


@pytest.fixture(scope="module")
def staged(spark, sf_dir, tmp_path_factory):
    """Result of every stage, each from its predecessor's Parquet."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        stage(spark, out[-1], sf_dir).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stages_keep_the_columns(staged):
    assert all(df.columns == staged[0].columns for df in staged[:-1])


def test_toxic_documents_go_and_clean_ones_stay(spark, staged, sf_dir):
    labels = {r["doc_id"]: r["toxic"] for r in
              spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in staged[1].collect()}
    toxic = [i for i, t in labels.items() if t]
    clean = [i for i, t in labels.items() if not t]
    assert sum(i in kept for i in toxic) <= 0.2 * len(toxic)
    assert sum(i in kept for i in clean) >= 0.95 * len(clean)


def test_dedup_stages(staged):
    before = {r["doc_id"]: r["text"] for r in staged[1].collect()}
    exact = {r["doc_id"] for r in staged[2].collect()}
    first = {}
    for i in sorted(before):
        first.setdefault((before[i] or "").encode().lower(), i)
    assert exact == set(first.values())
    near = {r["doc_id"] for r in staged[3].collect()}
    sets = {i: shingle_set(before[i]) for i in exact}
    gone = exact - near
    assert all(any(len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for j in exact if j != i)
               for i in gone)
    for i in near:
        assert not any(sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
                       for j in near if j < i)


def test_mixing_repeats_whole_rows(staged):
    kept = {tuple(r) for r in staged[3].collect()}
    rows = [tuple(r) for r in staged[4].collect()]
    assert set(rows) <= kept and max(map(rows.count, set(rows))) <= 3
    words = sum(len((r[1] or "").split()) for r in staged[3].collect())
    assert sum(len((r[1] or "").split()) for r in rows) == pytest.approx(words, rel=0.25)


def test_packing_and_run(spark, staged, sf_dir):
    source = [(r["doc_id"], r["text"], None) for r in staged[4].collect()]
    check(staged[5].collect(), source, Tokenizer.from_file(TOKENIZER), 4096)
    assert corpus_pipeline.run(spark, sf_dir).count() == staged[5].count()


CLASHING = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
            "position double, digest string, plan int, copy int, id string, plan_id int, key int")


def odd_rows():
    """(id, text): NULL and repeated ids, near and exact copies of both, empty and NULL texts."""
    rng = random.Random(4)
    a, b, c, d = (text(rng, 60) for _ in range(4))
    near = " ".join([*a.split()[:-1], "changed"])
    return [(1, a), (1, b), (2, near), (None, near), (None, a.upper()), (None, c), (None, c + " x"),
            (3, d), (3, d), (4, ""), (5, None), (None, ""), (6, "one two"), (7, "one two"),
            (8, " ".join([*b.split()[:-1], "other"]))]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", "s1", 1, 0.5, "d", 1, 2, "x", 3, 4) for i, t in odd_rows()]
    return spark.createDataFrame(rows, CLASHING).repartition(3)


def pairs(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def test_toxicity_stage_judges_rows_by_their_texts(spark, odd, sf_dir):
    kept = corpus_pipeline.drop_toxic(spark, odd, sf_dir)
    assert kept.columns == odd.columns and pairs(kept) == sorted(odd_rows(), key=repr)


def test_exact_stage_on_odd_rows(spark, odd, sf_dir):
    kept = corpus_pipeline.drop_copies(spark, odd, sf_dir)
    assert kept.columns == odd.columns
    texts = {(t or "").lower() for _, t in odd_rows()}
    assert sorted((t or "").lower() for _, t in pairs(kept)) == sorted(texts)
    assert {1: 2, 2: 1, 3: 1, 4: 1, 6: 1, 8: 1, None: 2} == Counter(i for i, _ in pairs(kept))


def test_near_stage_on_odd_rows(spark, odd, sf_dir):
    kept = corpus_pipeline.drop_near_copies(spark, odd, sf_dir)
    assert kept.columns == odd.columns
    rows = odd_rows()
    # of the copies of `a` and of `b` the smallest ids stay, also under a shared id; of the two
    # texts without any id that are linked to each other one stays; wordless texts all stay
    got = pairs(kept)
    assert [r for r in got if r[0] == 1] == sorted([rows[0], rows[1]], key=repr)
    assert not any(r[0] in (2, 8) for r in got)
    nameless = [t for i, t in got if i is None and t]
    assert len(nameless) == 1 and nameless[0] in (rows[5][1], rows[6][1])
    assert [r for r in got if r[0] == 3] == [rows[7]]
    assert {(4, ""), (5, None), (None, "")} <= set(got)
    assert sum(t == "one two" for _, t in got) == 1


def test_mixing_stage_keeps_a_column_named_position(spark, odd, sf_dir):
    mixed = corpus_pipeline.mix_sources(spark, odd, sf_dir)
    assert mixed.columns == odd.columns
    assert {r["position"] for r in mixed.collect()} == {0.5}


def test_stages_on_an_empty_table(spark, odd, sf_dir):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), sf_dir).count() == 0
