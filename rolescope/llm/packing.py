"""Best-fit packing of tokenised documents with large-item matching."""

from __future__ import annotations

import os
import struct
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rolescope.llm.base import materialize

CAPACITY = 4096
END_ID = 1
# Hash buckets in which the pieces of one length are numbered.
BUCKETS = 1024
# Words whose ids a worker remembers, and the longest word that it does.
REMEMBERED, LONGEST = 200_000, 48

_MEMORY: dict = {}


# Byte-level alphabet: a printable byte stands for itself, others take code points from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


def _bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Known(dict):
    """Ids by word; what is missing is asked of ``learn`` and kept."""

    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, word: str) -> bytes:
        ids = self.learn(word)
        if len(word) <= LONGEST:
            self[word] = ids
        return ids


class WordIds:
    """Little-endian 32-bit ids of texts, by a tokenizer that never merges across white space.

    Words are looked up in a dictionary; a word not met lately is encoded, by its letters alone if
    it is letters with one mark behind (the tokenizer separates letters from marks, and case does
    not matter to it). Both dictionaries are emptied when full, so memory is bounded.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.words, self.letters = _Known(self._word), _Known(self._letters)
        self.marks = {m: self._ids(m) for m in ".,;:!?"}

    def _ids(self, value: str) -> bytes:
        return _bytes(self.tokenizer.encode(value, add_special_tokens=False).ids)

    def _letters(self, value: str) -> bytes:
        """Ids of lower-case letters of Latin-1, which normalisation leaves as they are."""
        if not value.isascii():
            value = value.encode().decode("latin-1").translate(_BYTE_CHARS)
        return _bytes([t.id for t in self.tokenizer.model.tokenize(value)])

    def _word(self, word: str) -> bytes:
        if not word:
            return b""
        mark = self.marks.get(word[-1])
        letters = word if mark is None else word[:-1]
        if letters.isalpha() and max(letters) < "\u0100":
            return self.letters[letters.lower()] + (mark or b"")
        return self._ids(word)

    def encode(self, text: str) -> bytes:
        for known in (self.words, self.letters):
            if len(known) > REMEMBERED:
                known.clear()
        known = self.words
        return b"".join([known[w] for w in
                         text.replace("\n", " ").replace("\t", " ").split(" ")])


def word_ids(path: str) -> WordIds:
    if path not in _MEMORY:
        _MEMORY[path] = WordIds(path)
    return _MEMORY[path]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, piece, start, length, ids_crc32``: documents cut where they exceed the capacity."""
    id_type = docs.select(id_col).schema[0].dataType
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def cut(batches):
        words = word_ids(tokenizer)
        for batch in batches:
            at, number, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = words.encode(text.as_py() or "") + end
                n = len(ids) // 4
                for k, s in enumerate(range(0, n, capacity)):
                    part = ids[4 * s:4 * (s + capacity)]
                    at.append(i), number.append(k), start.append(s)
                    length.append(len(part) // 4), crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(number, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(crc, pa.int64())], ["id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        cut, f"id {id_type.simpleString()}, piece int, start bigint, length bigint, "
             "ids_crc32 bigint")


def plan_bins(counts: dict[int, int], capacity: int) -> tuple[list[tuple], int]:
    """Where the pieces of each length go, from the number of pieces of each length alone.

    Returns runs ``(length, first rank, pieces, first bin, pieces a bin, offset)`` and the number
    of bins: piece ``r`` of a run lies in bin ``first bin + r // per bin`` at ``offset + r % per
    bin * length``. Lengths above a third of the capacity are matched greedily, largest first, each
    with the largest partner that fits, so at most two share a bin. Smaller ones go, largest first,
    to the bin with the tightest gap that holds them. Equal bins are kept as intervals, so the work
    depends on the number of distinct lengths (at most ``capacity``), not on the corpus.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    rank = dict.fromkeys(left, 0)
    runs, gaps, bins = [], {}, 0  # gaps: free tokens -> [(first bin, bins)]
    order: list[int] = []  # free sizes that occur, ascending

    def put(length, number, first, per_bin, offset):
        runs.append((length, rank[length], number, first, per_bin, offset))
        rank[length] += number
        left[length] -= number

    def free(gap, first, number):
        if gap and number:
            if gap not in gaps:
                gaps[gap] = []
                insort(order, gap)
            gaps[gap].append((first, number))

    large = sorted(n for n in left if 3 * n > capacity)
    for length in reversed(large):
        while left[length]:
            at = bisect_left(large, min(length, capacity - length) + 1) - 1
            while at >= 0 and (not left[large[at]] or large[at] == length and left[length] < 2):
                at -= 1
            if at < 0:
                number = left[length]
                put(length, number, bins, 1, 0)
                free(capacity - length, bins, number)
            elif large[at] == length:
                number = left[length] // 2
                put(length, 2 * number, bins, 2, 0)
                free(capacity - 2 * length, bins, number)
            else:
                other = large[at]
                number = min(left[length], left[other])
                put(length, number, bins, 1, 0)
                put(other, number, bins, 1, length)
                free(capacity - length - other, bins, number)
            bins += number

    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            at = bisect_left(order, length)
            if at == len(order):
                fit = capacity // length
                free(capacity, bins, -(-left[length] // fit))
                bins += -(-left[length] // fit)
                continue
            gap = order[at]
            first, number = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                order.pop(at)
            fit = gap // length
            filled = min(number, left[length] // fit)
            if filled:
                put(length, filled * fit, first, fit, capacity - gap)
                free(gap - fit * length, first, filled)
            rest = left[length] if filled < number else 0
            if rest:
                put(length, rest, first + filled, fit, capacity - gap)
                free(gap - rest * length, first + filled, 1)
                filled += 1
            free(gap, first + filled, number - filled)
    return runs, bins


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece.

    Texts are tokenised once. The packing is decided from the histogram of piece lengths (at most
    ``capacity`` rows reach the driver); pieces of a length are interchangeable, so each finds its
    place by its rank among them. Ranks are counted within hash buckets and over bucket totals, so
    a length that a third of all pieces share is spread. NULL text is empty (one piece, the end
    id); NULL and repeated ids are packed like any other row; an empty table gives no rows; other
    columns are ignored. ``tokenizer`` is a path on every executor.
    """
    id_name = id_col
    cut = materialize(pieces(docs, tokenizer, capacity, end_id, id_col, text_col)
                      .withColumn("h", F.xxhash64("id", "piece", "ids_crc32"))
                      .withColumn("bucket", F.pmod("h", F.lit(BUCKETS))), "pieces")
    counts = {r["length"]: r["n"] for r in
              cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs, _ = plan_bins(counts, capacity)
    runs.sort()
    table = np.array(runs, dtype=np.int64).reshape(-1, 6)
    keys = (table[:, 0] << 44) + table[:, 1]

    before = Window.partitionBy("b_length").orderBy("b_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    totals = (cut.groupBy(F.col("length").alias("b_length"), F.col("bucket").alias("b_bucket"))
              .agg(F.count(F.lit(1)).alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    inside = Window.partitionBy("length", "bucket").orderBy("h", "id", "piece", "start")
    ranked = (cut.withColumn("rn", F.row_number().over(inside))
              .join(totals, (F.col("length") == F.col("b_length"))
                    & (F.col("bucket") == F.col("b_bucket")))
              .select("id", "piece", "start", "length", "ids_crc32",
                      (F.col("before") + F.col("rn") - 1).alias("rank")))

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            run = table[np.searchsorted(keys, (length << 44) + rank, side="right") - 1]
            index = rank - run[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(run[:, 3] + index // run[:, 4]),
                 pa.array(run[:, 5] + index % run[:, 4] * length)],
                ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    out = ranked.mapInArrow(place, f"id {id_type}, piece int, start bigint, length bigint, "
                                   "ids_crc32 bigint, sequence_id bigint, offset bigint")
    return out.withColumnRenamed("id", id_name)
