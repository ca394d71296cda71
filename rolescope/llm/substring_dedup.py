"""Substring dedup: windows on shared blocks looked up by hash, hits merged into factors."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolescope.llm.base import hash_words, materialize, rolling, text_slices

WINDOW = 50
_U = np.uint64


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    if len(values) < width:
        return values[:0]
    low, span = values, 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    n = len(values) - width + 1
    return np.minimum(low[:n], low[width - span:width - span + n])


def window_blocks(words: np.ndarray, window: int) -> np.ndarray:
    """The reference block of each window: the least hash of the half-windows in it.

    Equal windows pick equal blocks, neighbouring windows mostly the same one, so a document is
    indexed by a few percent of its positions and no window can be missed.
    """
    half = window // 2
    return sliding_min(rolling(words, half), window - half + 1)


def parse(starts: list[int], refs: list, window: int) -> list[tuple]:
    """Factors ``(start, end, ref)``: runs of found windows with one reference document, merged.

    Every window was looked up by its hash, those over a factor's boundary too, so a match that
    begins inside one factor and goes on in another document becomes a factor of its own. No match
    is extended against the words of the reference.
    """
    factors: list[tuple] = []
    for s, ref in zip(starts, refs):
        if factors and s == factors[-1][1] - window + 1 and ref == factors[-1][2]:
            factors[-1] = (factors[-1][0], s + window, ref)
        else:
            factors.append((s, s + window, ref))
    return factors


def repeated_spans(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``id, n_words, n_removed, kept_sha256, factors`` for every row.

    A window is ``window`` consecutive words; a word is removed when some window that covers it
    also starts in a document with a smaller id. ``factors`` lists the spans (word positions, end
    exclusive) with the document that each refers to: the smallest id that holds the windows. For
    a copy of an earlier text it is the whole text.

    Identical texts are folded first. Every distinct text is indexed by its blocks (see
    ``window_blocks``); only texts with a block that another text has too meet their words again,
    and only windows on such blocks are looked up, each by a minimum over its 64-bit hash that is
    combined before the shuffle, so a passage that a third of all documents share is one row a
    task. Rows that are compared are windows, never pairs of documents.

    NULL text has no words; a NULL id is larger than any id and never a reference; rows with the
    same id never refer to each other; an empty table gives no rows; other columns are ignored.
    """
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))

    def index(batches):
        for batch in batches:
            for first, last, data, bounds in text_slices(batch.column(1)):
                words, at = hash_words(data, bounds)
                body, n, sha, blocks = [], [], [], []
                raw = data.tobytes()
                for i in range(last - first):
                    own = raw[bounds[i]:bounds[i + 1]]
                    body.append(hashlib.md5(own).hexdigest())
                    sha.append(hashlib.sha256(b" ".join(own.split())).hexdigest())
                    n.append(at[i + 1] - at[i])
                    blocks.append(np.unique(window_blocks(words[at[i]:at[i + 1]], window))
                                  .tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(body), pa.array(n),
                     pa.array(sha), pa.array(blocks, pa.binary())],
                    ["id", "body", "n_words", "sha", "blocks"])

    indexed = materialize(source.mapInArrow(
        index, f"id {id_type}, body string, n_words bigint, sha string, blocks binary"),
        "substring-index")
    bodies = indexed.groupBy("body").agg(F.min("id").alias("first"))
    rows = indexed.select("id", "body", "n_words", "sha")

    def unpack(batches):
        for batch in batches:
            lists = [np.frombuffer(b, dtype=np.int64) for b in batch.column(1).to_pylist()]
            if lists:
                at = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), pa.array(np.concatenate(lists))],
                    ["body", "block"])

    one_each = indexed.where("n_words >= %d" % window).groupBy("body").agg(
        F.min("blocks").alias("blocks"))
    blocks = one_each.mapInArrow(unpack, "body string, block bigint")
    shared = blocks.groupBy("block").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    wanted = blocks.join(shared.select("block"), "block").groupBy("body").agg(
        F.collect_list("block").alias("blocks"))  # at most the document's own blocks
    wanted = wanted.join(bodies, "body")
    keyed = source.withColumn("key", F.md5("text"))
    met = materialize(
        wanted.join(keyed, (F.col("body") == F.col("key"))
                    & F.col("first").eqNullSafe(F.col("id")))
        .select("body", "first", "blocks", "text").dropDuplicates(["body"]), "substring-shared")

    def windows(batches):
        for batch in batches:
            column = batch.column(3)
            for start, last, data, bounds in text_slices(column):
                words, at = hash_words(data, bounds)
                who, where, what = [], [], []
                for i in range(last - start):
                    own = words[at[i]:at[i + 1]]
                    have = np.array(batch.column(2)[start + i].as_py(), dtype=np.int64)
                    found = np.flatnonzero(np.isin(window_blocks(own, window).view(np.int64), have))
                    who.append(np.full(len(found), start + i))
                    where.append(found)
                    what.append(rolling(own, window)[found].view(np.int64))
                who = pa.array(np.concatenate(who))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(what)), pa.array(np.concatenate(where)),
                     batch.column(0).take(who), batch.column(1).take(who)],
                    ["w", "start", "body", "first"])

    seen = met.select("body", "first", "blocks", "text").mapInArrow(
        windows, f"w bigint, start bigint, body string, first {id_type}")
    lowest = seen.groupBy("w").agg(F.min("first").alias("ref"), F.min("body").alias("b0"),
                                   F.max("body").alias("b1")).where("b0 <> b1").drop("b0", "b1")
    repeated = (seen.join(lowest, "w")
                .where(F.col("ref").isNotNull() & F.coalesce(F.col("ref") < F.col("first"),
                                                             F.lit(True)))
                .groupBy("body").agg(F.collect_list(F.struct("start", "ref")).alias("found")))

    def strip(batches):
        for batch in batches:
            out = []
            for body, text, found in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = text.encode().split()
                found = sorted((f["start"], f["ref"]) for f in found)
                factors = parse([s for s, _ in found], [r for _, r in found], window)
                keep = np.ones(len(words), dtype=bool)
                for a, b, _ in factors:
                    keep[a:b] = False
                kept = [w for w, k in zip(words, keep) if k]
                out.append((body, len(words) - len(kept),
                            hashlib.sha256(b" ".join(kept)).hexdigest(),
                            [{"start": a, "end": b, "ref": r} for a, b, r in factors]))
            ref = batch.schema.field(2).type.value_type.field("ref").type
            kinds = (pa.string(), pa.int64(), pa.string(), pa.list_(pa.struct(
                [("start", pa.int64()), ("end", pa.int64()), ("ref", ref)])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)],
                ["body", "removed", "kept", "spans"])

    span = f"array<struct<start:bigint,end:bigint,ref:{id_type}>>"
    stripped = met.join(repeated, "body").select("body", "text", "found").mapInArrow(
        strip, f"body string, removed bigint, kept string, spans {span}")
    full = rows.join(bodies, "body").join(stripped, "body", "left")
    copy = F.col("first").isNotNull() & F.coalesce(F.col("id") > F.col("first"), F.lit(True)) \
        & (F.col("n_words") >= window)
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("start"),
                             F.col("n_words").alias("end"), F.col("first").alias("ref")))
    return full.select(
        F.col("id").alias(id_col), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0)))
        .cast("bigint").alias("n_removed"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest()))
        .otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
        F.when(copy, whole).otherwise(F.coalesce("spans", F.array().cast(span))).alias("factors"))
