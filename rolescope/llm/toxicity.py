"""Toxicity by multiple-instance learning: sentences scored, documents labelled."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolescope.llm.base import hash_spans, materialize, mix, text_slices, word_spans

_U = np.uint64
# Everything but letters, digits and bytes of other scripts separates words.
_GAPS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_ENDS = np.isin(np.arange(256), list(b".!?\n"))
# Lengths in bytes of the word beginnings that are features beside the word itself.
PREFIXES = (4, 5, 6, 7, 8)


@dataclass(frozen=True)
class MilPlan:
    """``max_docs`` bounds the labelled documents learned from (least hash of the id).

    They are dealt by hash of the id to ``tasks`` local models, on any number of cores. Among the
    chosen features a share of at most ``false_share`` is expected to be there by chance.
    """

    max_docs: int = 40_000
    tasks: int = 8
    min_docs: int = 2
    false_share: float = 0.8
    rounds: int = 6
    epochs: int = 10
    rate: float = 0.1
    l2: float = 1e-6
    threshold: float = 0.7


def held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 3 == 1


def _sentences(data: np.ndarray, bounds: np.ndarray):
    """Byte spans of words, the sentence of each word, the document of each sentence."""
    starts, ends = word_spans(data, bounds, _GAPS)
    doc = np.searchsorted(bounds, starts, side="right") - 1
    if not len(starts):
        none = np.zeros(0, dtype=np.int64)
        return starts, ends, none, none
    stops = np.concatenate([[0], np.cumsum(_ENDS[data])])
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (stops[starts[1:]] != stops[ends[:-1]])
    return starts, ends, np.cumsum(new) - 1, doc[new]


def _features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Hashes of each word and of its beginnings, one kind at a time, with the words they are of."""
    yield hash_spans(data, starts, ends, fold=True), np.arange(len(starts))
    for n in PREFIXES:
        long = np.flatnonzero(ends - starts > n)
        yield mix(hash_spans(data, starts[long], starts[long] + n, fold=True) + _U(n)), long


def _noisy_or(p: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """log of the chance that no sentence of each document is toxic."""
    return np.bincount(doc, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=n)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _learn(docs: list, start: np.ndarray, plan: MilPlan, seed: int) -> tuple:
    """A task's passes of AdaGrad over its documents, from the shared weights (last is the bias).

    Returns the change of the weights and in how many documents each feature was met.
    """
    w = start.astype(np.float64)
    met = np.bincount(np.concatenate([np.unique(d[1]) for d in docs]), minlength=len(w)).astype(
        np.float32)
    met[-1] = len(docs)
    square = np.full(len(w), 1e-6)
    rng = np.random.default_rng(seed)
    batch = 32
    for _ in range(plan.epochs):
        order = rng.permutation(len(docs))
        for low in range(0, len(docs), batch):
            part = [docs[i] for i in order[low:low + batch]]
            y = np.array([d[0] for d in part], dtype=np.float64)
            counts = [d[3] for d in part]
            doc = np.repeat(np.arange(len(part)), counts)
            shift = np.cumsum([0, *counts[:-1]])
            feature = np.concatenate([d[1] for d in part])
            sentence = np.concatenate([d[2] + s for d, s in zip(part, shift)])
            n = len(doc)
            z = np.bincount(sentence, weights=w[feature], minlength=n) + w[-1]
            p = _sigmoid(z)
            q = np.exp(_noisy_or(p, doc, len(part)))
            pull = np.where(y == 1, q / np.maximum(1 - q, 1e-9), -1.0)
            slope = p * pull[doc] / len(part)
            touched, at = np.unique(feature, return_inverse=True)
            g = np.bincount(at, weights=slope[sentence]) - plan.l2 * w[touched]
            square[touched] += g * g
            w[touched] += plan.rate * g / np.sqrt(square[touched])
            g = slope.sum()
            square[-1] += g * g
            w[-1] += plan.rate * g / np.sqrt(square[-1])
    return (w - start).astype(np.float32), met


class MilModel:
    """Weights of features (sorted by hash), and of every sentence (the last one)."""

    def __init__(self, features: np.ndarray, weights: np.ndarray):
        self.features, self.weights = features, weights
        self.maybe = np.zeros(1 << 16, dtype=bool)  # by low bits: most words need no search
        self.maybe[(features & _U(0xFFFF)).astype(np.int64)] = True

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, sentence: np.ndarray):
        """Known features and the sentences that hold them, by sentence; repeats count once."""
        found, where = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        if len(self.features):
            for hashes, words in _features(data, starts, ends):
                some = np.flatnonzero(self.maybe[(hashes & _U(0xFFFF)).astype(np.int64)])
                at = np.minimum(np.searchsorted(self.features, hashes[some]),
                                len(self.features) - 1)
                hit = self.features[at] == hashes[some]
                found.append(at[hit])
                where.append(words[some[hit]])
        size = max(len(self.features), 1)
        pairs = np.unique(sentence[np.concatenate(where)] * size + np.concatenate(found))
        return pairs % size, pairs // size


def _least(tenths: list, share: float) -> int:
    """The lowest tenth of excess at which chance explains at most this share of what is chosen.

    Chance brings a feature an excess of e with a probability below exp(-e), so of all tests it
    brings tests * exp(-e); the step-up rule takes the lowest e where that is ``share`` of those
    at least as extreme.
    """
    tests, chosen, least = sum(n for _, n in tenths), 0, 1 << 30
    for tenth, n in sorted((t for t in tenths if t[0] is not None), reverse=True):
        chosen += n
        if tests * np.exp(-tenth / 10) <= share * chosen:
            least = tenth
    return int(least)


def train(docs: DataFrame, labels: DataFrame, plan: MilPlan = MilPlan(), id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic") -> MilModel:
    """Learn word weights from document labels alone.

    A sentence's score is logistic in the sum of its features' weights; a document's is the noisy-or
    of its sentences. At most ``plan.max_docs`` labelled documents (parameter; of those that are
    not held out, least hash of the id first) are read. A word, or the
    beginning of words (their first four to eight bytes), gets a weight if at least
    ``plan.min_docs`` toxic documents hold it and more than chance would bring: of the features
    chosen of a kind (words, or beginnings of one length) a share of at most ``plan.false_share`` is
    expected to be there by chance. The chance is bounded by exp(-n KL(k / n, share)), which holds
    for samples of any size, so few labels choose few features and many choose many.
    ``plan.tasks`` shares, dealt by hash of the id and each ordered by its content, train from
    common weights, and the mean of their models starts the next round (a feature's weight counts by
    the documents that hold it), so the model does not depend on cores or partitions. Documents
    without a label, and ids that are NULL, teach nothing; an id with several labels counts as its
    largest.
    """
    spark = docs.sparkSession
    chosen = (labels.select(F.col(id_col).alias("l_id"), F.col(label_col).alias("y"))
              .where(F.col("l_id").isNotNull() & F.col("y").isNotNull()
                     & (F.crc32(F.col("l_id").cast("string").cast("binary")) % 3 != 1))
              .groupBy("l_id").agg(F.max("y").cast("int").alias("y"))
              .orderBy(F.xxhash64("l_id"), "l_id").limit(plan.max_docs))
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(chosen), F.col("id") == F.col("l_id")).select(
        "y", "text", F.xxhash64("l_id").alias("key"))
    sample = materialize(sample.repartition(max(spark.sparkContext.defaultParallelism, 2)),
                         "mil-sample")

    def distinct(batches):
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False)
            for first, last, data, bounds in text_slices(batch.column(1)):
                starts, ends, *_ = _sentences(data, bounds)
                doc = np.searchsorted(bounds, starts, side="right") - 1
                for kind, (hashes, words) in enumerate(_features(data, starts, ends)):
                    order = np.lexsort((hashes, doc[words]))
                    h, d = hashes[order], doc[words][order]
                    new = np.ones(len(h), dtype=bool)
                    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h[new].view(np.int64)), pa.array(label[first + d[new]]),
                         pa.array(np.full(int(new.sum()), kind, dtype=np.int32))],
                        ["w", "y", "kind"])

    held, toxic = sample.agg(F.count(F.lit(1)), F.sum("y")).first()
    share = (toxic or 0) / max(held, 1)
    counted = materialize(
        sample.mapInArrow(distinct, "w bigint, y int, kind int").groupBy("kind", "w")
        .agg(F.count(F.lit(1)).alias("docs"), F.sum("y").alias("toxic"))
        .where(F.col("docs") >= plan.min_docs), "mil-features")
    held_share = F.col("toxic") / F.col("docs")
    # n KL(k / n, share), of which the term without toxic documents is 0 where all are toxic
    excess = F.col("toxic") * F.ln(held_share / share) + F.when(
        F.col("toxic") < F.col("docs"), (F.col("docs") - F.col("toxic"))
        * F.ln((1 - held_share) / (1 - share))).otherwise(0.0) if 0 < share < 1 else F.lit(-1.0)
    rated = counted.withColumn("tenth", F.when(
        (F.col("toxic") >= plan.min_docs) & (held_share > share), F.floor(excess * 10)))
    tenths = rated.groupBy("kind", "tenth").agg(F.count(F.lit(1)).alias("n")).collect()
    least = F.create_map(*[F.lit(x) for kind in range(len(PREFIXES) + 1) for x in (
        kind, _least([(r["tenth"], r["n"]) for r in tenths if r["kind"] == kind],
                     plan.false_share))])
    chosen_words = rated.where(F.col("tenth") >= least[F.col("kind")]).orderBy("w").collect()
    features = np.array([r["w"] for r in chosen_words], dtype=np.int64).view(_U)
    n, n1 = (np.array([r[c] for r in chosen_words], dtype=np.float64) for c in ("docs", "toxic"))
    order = np.argsort(features)
    weights = np.zeros(len(features) + 1, dtype=np.float32)
    # start from the log odds of the features' documents
    weights[:-1] = np.log((n1 + 0.5) / (n - n1 + 0.5) * (1 - share) / max(share, 1e-9))[order]
    weights[-1] = -6.0
    model = MilModel(features[order], weights)

    def cut(batches):
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False)
            for first, last, data, bounds in text_slices(batch.column(1)):
                starts, ends, sentence, doc = _sentences(data, bounds)
                found, own = model.find(data, starts, ends, sentence)
                at = np.searchsorted(doc, np.arange(last - first + 1))
                cuts = np.searchsorted(own, at)
                rows = [(int(label[first + i]), found[a:b].astype(np.int32).tobytes(),
                         (own[a:b] - at[i]).astype(np.int32).tobytes(), int(at[i + 1] - at[i]))
                        for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2).slice(first, last - first),
                     *[pa.array([r[k] for r in rows], t) for k, t in enumerate(
                         (pa.int32(), pa.binary(), pa.binary(), pa.int32()))]],
                    ["key", "y", "feature", "sentence", "n"])

    bags = materialize(
        sample.mapInArrow(cut, "key bigint, y int, feature binary, sentence binary, n int")
        .where("n > 0").withColumn("task", F.expr(f"int(pmod(key, {plan.tasks}))")), "mil-bags")
    for turn in range(plan.rounds):
        def update(group):
            rows = sorted(zip(*(group[c].tolist() for c in (
                "key", "y", "feature", "sentence", "n"))))  # not as the shuffle brought them
            docs = [(y, *(np.frombuffer(x, dtype=np.int32).astype(np.int64)
                          for x in (found, sentence)), n) for _, y, found, sentence, n in rows]
            changed, met = _learn(docs, model.weights, plan, turn)
            return pd.DataFrame({"task": group["task"].iloc[:1], "delta": [changed.tobytes()],
                                 "met": [met.tobytes()]})

        steps = sorted(bags.groupBy("task").applyInPandas(
            update, "task int, delta binary, met binary").collect())  # a row a task
        if not steps:
            break
        delta, met = (np.array([np.frombuffer(r[c], dtype=np.float32) for r in steps],
                               dtype=np.float64) for c in ("delta", "met"))
        step = (delta * met).sum(axis=0) / np.maximum(met.sum(axis=0), 1)
        model = MilModel(model.features, (model.weights + step).astype(np.float32))
    return model


def drop_predicted(docs: DataFrame, model: MilModel, plan: MilPlan = MilPlan(),
                   text_col: str = "text") -> DataFrame:
    """The rows that are not predicted, unchanged: each is judged by its own text, in one pass.

    Nothing is joined, so NULL and repeated ids need no rule. NULL and empty texts stay.
    """
    at = docs.columns.index(text_col)
    weights = model.weights[:-1].astype(np.float64)
    bias = float(model.weights[-1])

    def run(batches):
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            for first, last, data, bounds in text_slices(batch.column(at)):
                starts, ends, sentence, doc = _sentences(data, bounds)
                found, own = model.find(data, starts, ends, sentence)
                p = _sigmoid(np.bincount(own, weights=weights[found], minlength=len(doc)) + bias)
                keep[first:last] = -np.expm1(_noisy_or(p, doc, last - first)) < plan.threshold
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def score(docs: DataFrame, model: MilModel, plan: MilPlan = MilPlan(), id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``id, score, predicted, offending`` for every row, in one pass without a shuffle.

    ``offending`` lists the sentences of a predicted document that score at least half, with their
    positions in code points (from the first to the last word, end exclusive), or the highest
    scoring one. NULL and empty texts have no sentence and score 0. Empty tables give no rows,
    repeated rows are scored alike, other columns are ignored.
    """
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    weights = model.weights[:-1].astype(np.float64)
    bias = float(model.weights[-1])

    def run(batches):
        for batch in batches:
            for first, last, data, bounds in text_slices(batch.column(1)):
                starts, ends, sentence, doc = _sentences(data, bounds)
                n = last - first
                found, own = model.find(data, starts, ends, sentence)
                p = _sigmoid(np.bincount(own, weights=weights[found],
                                         minlength=len(doc)) + bias)
                total = -np.expm1(_noisy_or(p, doc, n))
                total = np.clip(total, 0.0, 1.0)
                bad, spans = total >= plan.threshold, [[] for _ in range(n)]
                at = np.searchsorted(doc, np.arange(n + 1))
                for i in np.flatnonzero(bad):
                    own = np.arange(at[i], at[i + 1])
                    mine = own[p[own] >= 0.5]
                    for s in mine if len(mine) else [own[p[own].argmax()]]:
                        a, b = np.searchsorted(sentence, (s, s + 1))
                        raw = data[bounds[i]:ends[b - 1]].tobytes()
                        low = len(raw[:starts[a] - bounds[i]].decode())
                        spans[i].append({"start": low, "end": len(raw.decode()),
                                         "score": float(p[s])})
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(total),
                     pa.array(bad.astype(np.int32)),
                     pa.array(spans, pa.list_(pa.struct(
                         [("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))],
                    ["id", "score", "predicted", "offending"])

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, score double, predicted int, "
             "offending array<struct<start:bigint,end:bigint,score:double>>")
    return out.withColumnRenamed("id", id_col)
