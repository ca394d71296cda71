from __future__ import annotations

import os
import random
import subprocess
import sys
import zlib
from pathlib import Path

from rolescope.llm import toxicity
from rolescope.llm.queries import QUERIES

from .conftest import frame, text

BAD = ["vile", "rotten", "nasty"]


def data(n=400, seed=3):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        sentences = [text(rng, rng.randint(4, 9)).capitalize() + "." for _ in range(rng.randint(2, 20))]
        bad = i % 5 == 0
        if bad:
            at = rng.randrange(len(sentences))
            sentences[at] = sentences[at].replace(" ", f" {rng.choice(BAD)} ", 1)
        rows.append((i, " ".join(sentences), None))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_learns_from_documents_and_finds_sentences(spark):
    rows, labels = data()
    docs = frame(spark, rows)
    marked = spark.createDataFrame([*labels, (None, 1, 1), (9, 1, None)],
                                   "doc_id bigint, quality int, toxic int")
    model = toxicity.train(docs, marked)
    out = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(len(rows)) if zlib.crc32(str(i).encode()) % 3 == 1]
    right = sum(out[i]["predicted"] == int(i % 5 == 0) for i in held)
    assert right / len(held) > 0.97
    for i in held:
        if out[i]["predicted"] and i % 5 == 0:
            assert any(b in rows[i][1][s["start"]:s["end"]] for s in out[i]["offending"]
                       for b in BAD)
        assert (out[i]["score"] >= 0.7) == bool(out[i]["predicted"])


def test_held_out_labels_are_never_used(spark):
    rows, labels = data(200)
    docs = frame(spark, rows)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    schema = "doc_id bigint, quality int, toxic int"
    models = [toxicity.train(docs, spark.createDataFrame(x, schema)) for x in (labels, flipped)]
    assert (models[0].features == models[1].features).all()
    assert (models[0].weights == models[1].weights).all()


def test_odd_rows(spark, docs, corpus, empty_docs):
    rows, labels = data(100)
    model = toxicity.train(frame(spark, rows), spark.createDataFrame(
        labels, "doc_id bigint, quality int, toxic int"))
    out = toxicity.score(docs, model).collect()
    assert len(out) == len(corpus)
    assert all(0 <= r["score"] <= 1 for r in out)
    texts = {i: t for i, t, _ in corpus}
    assert all(r["score"] == 0 for r in out if not (texts[r["doc_id"]] or "").strip())
    assert toxicity.score(empty_docs, model).count() == 0
    none = toxicity.train(docs, spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert all(r["predicted"] == 0 for r in toxicity.score(docs, none).collect()
               if len(texts[r["doc_id"]] or "") < 300)


def test_query_on_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    out = {r["doc_id"]: r for r in QUERIES["op8_toxicity"](spark, d).collect()}
    labels = [r for r in spark.read.parquet(f"{d}/labels.parquet").collect()
              if out[r["doc_id"]]["held_out"]]
    right = sum(out[r["doc_id"]]["predicted"] == r["toxic"] for r in labels)
    assert right / len(labels) > 0.9


CORES = """
import hashlib, sys
from pyspark.sql import SparkSession
from rolescope.llm import toxicity
from tests.llm.conftest import frame
from tests.llm.test_toxicity import data
spark = (SparkSession.builder.master(sys.argv[1]).config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "8").getOrCreate())
rows, labels = data()
docs = frame(spark, rows)
model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
out = sorted((r["doc_id"], r["score"], r["predicted"]) for r in toxicity.score(docs, model).collect())
print("SCORES", len(out), hashlib.sha256(repr(out).encode()).hexdigest())
"""


def test_scores_do_not_depend_on_cores():
    root = str(Path(__file__).parents[2])
    said = []
    for master in ("local[2]", "local[4]"):
        out = subprocess.run(
            [sys.executable, "-c", CORES, master], cwd=root, capture_output=True, text=True,
            timeout=300, env=os.environ | {
                "PYTHONPATH": f"{root}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"})
        assert out.returncode == 0, out.stderr[-2000:]
        said.append([x for x in out.stdout.splitlines() if x.startswith("SCORES")])
    assert said[0] and said[0] == said[1]
