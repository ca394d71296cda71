"""Token ids in fixed-width bits: files written and read by Spark, unpacked by numpy.

A file holds consecutive documents, in ascending order of their ids. All numbers are little-endian.

====================  ==========================================================================
header                ``HEADER``: magic, version, bits an id, ids a block, task, number of the file
                      in its task, ids, documents, blocks, bytes of the index
block offsets         ``blocks + 1`` unsigned 64-bit positions of the blocks, from the file's start
blocks                each ``ids a block`` ids (the last one fewer), most significant bit first,
                      padded to a whole byte
index                 an Arrow stream of one batch: the documents' ids and their first token's
                      position in the file
last byte             a line feed, which Spark's writer adds
====================  ==========================================================================

Every block starts at a byte, so any range of ids is read from the blocks that hold it alone.
"""

from __future__ import annotations

import codecs
import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rolescope.llm.base import materialize
from rolescope.session import scratch_path

END_ID = 2
BLOCK_IDS = 1 << 14
# A file is closed at the end of the document that brings it to so many ids.
FILE_IDS = 1 << 23
# Chunks of text whose ids a worker remembers, and the longest one that it does.
REMEMBERED, LONGEST = 500_000, 64

MAGIC, VERSION = b"TOKBITS1", 1
HEADER = struct.Struct("<8sHHIIIQQQQ")

_MEMORY: dict = {}


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Each id in ``bits`` bits, most significant first, padded to a whole byte."""
    if bits == 16:
        return ids.astype(">u2").tobytes()
    wide = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    return np.packbits(wide[:, 32 - bits:].ravel()).tobytes()


def unpack_bits(data: bytes, bits: int, n: int) -> np.ndarray:
    """The first ``n`` ids of ``pack_bits``, as unsigned 32-bit numbers."""
    if bits == 16:
        return np.frombuffer(data, dtype=">u2", count=n).astype("<u4")
    flat = np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=n * bits).reshape(n, bits)
    wide = np.zeros((n, 32), dtype=np.uint8)
    wide[:, 32 - bits:] = flat
    return np.packbits(wide, axis=1).view(">u4").ravel().astype("<u4")


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def file_bytes(ids: np.ndarray, index: pa.RecordBatch, bits: int, task: int, number: int,
               block_ids: int = BLOCK_IDS) -> bytes:
    """A file without its last byte."""
    blocks = [pack_bits(ids[i:i + block_ids], bits) for i in range(0, len(ids), block_ids)]
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, index.schema) as stream:
        stream.write_batch(index)
    tail = sink.getvalue().to_pybytes()
    first = HEADER.size + 8 * (len(blocks) + 1)
    offsets = first + np.concatenate([[0], np.cumsum([len(b) for b in blocks], dtype=np.int64)])
    header = HEADER.pack(MAGIC, VERSION, bits, block_ids, task, number, len(ids),
                         index.num_rows, len(blocks), len(tail))
    return b"".join([header, offsets.astype("<u8").tobytes(), *blocks, tail])


class TokenFile:
    """A file's bytes (or a memory map of them): its header, its documents and any range of ids."""

    def __init__(self, data):
        self.data = memoryview(data)
        (magic, version, self.bits, self.block_ids, self.task, self.number, self.ids,
         self.documents, self.blocks, tail) = HEADER.unpack_from(self.data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a file of token ids")
        self.offsets = np.frombuffer(self.data, dtype="<u8", count=self.blocks + 1,
                                     offset=HEADER.size).astype(np.int64)
        self._index = (int(self.offsets[-1]), tail)

    def index(self) -> pa.RecordBatch:
        """``id, start`` of the documents; a document ends where the next one starts."""
        at, size = self._index
        return pa.ipc.open_stream(self.data[at:at + size]).read_next_batch()

    def block(self, k: int) -> np.ndarray:
        n = min(self.block_ids, self.ids - k * self.block_ids)
        return unpack_bits(bytes(self.data[self.offsets[k]:self.offsets[k + 1]]), self.bits, n)

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` (exclusive), from the blocks that hold them."""
        stop = min(stop, self.ids)
        if start >= stop:
            return np.zeros(0, dtype="<u4")
        low = start // self.block_ids
        got = [self.block(k) for k in range(low, (stop - 1) // self.block_ids + 1)]
        flat = np.concatenate(got)
        return flat[start - low * self.block_ids:stop - low * self.block_ids]


# Byte-level alphabet: printable bytes stand for themselves, the others for code points from 256.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_OTHERS = [b for b in range(256) if b not in _PRINTABLE]
_BYTE_CHARS = "".join(chr(b if b in _PRINTABLE else 256 + _OTHERS.index(b)) for b in range(256))

# Marks that the tokenizer separates from the letters before them.
_MARKS = "!\"#$%&()*+,./:;<=>?@[]^_`{|}~-"
# Packers of few ids.
_PACK = [struct.Struct(f"<{n}I").pack for n in range(32)]


class _Uneven(Exception):
    """White space behind a space or line feed, or a text that ends in one of the two."""


class _Known(dict):
    """Ids by text; what is missing is asked of ``learn`` and kept if it is short.

    When ``REMEMBERED`` are kept they become the old ones, which are dropped when that happens next;
    old ones that are met are kept again. So frequent texts stay.
    """

    def __init__(self, learn):
        super().__init__()
        self.learn, self.old = learn, {}

    def __missing__(self, key: str) -> bytes:
        ids = self.old.get(key)
        if ids is None:
            ids = self.learn(key)
        if len(key) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[key] = ids
        return ids


class ChunkIds:
    """Ids of whole texts by a byte-level tokenizer that splits before white space.

    Such a tokenizer always splits before a space or line feed that something else than white
    space follows, so a text is cut there and each chunk is looked up by its text. A chunk not met
    lately is encoded: by its letters and by its marks if it is letters with marks behind (the
    tokenizer separates the two), else as a whole. The dictionaries forget what was not met lately.
    """

    _CUT = re.compile(r"(?=[ \n]\S)")
    _LETTERS = re.compile(rf"([ \n]?)([^\W\d_]+)([{re.escape(_MARKS)}]*)")

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # strings of special tokens in a text are ordinary text
        self.tokenizer.encode_special_tokens = True
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.tokenize = self.tokenizer.model.tokenize
        self.chunks = _Known(self._chunk)
        self.after_space = _Known(self._after_space)
        self.words = _Known(self._word)

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids,
                          dtype="<u4").tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of letters, with a space before them or not; also of marks alone."""
        mapped = codecs.charmap_decode(word.encode(), "strict", _BYTE_CHARS)[0]
        tokens = [t.id for t in self.tokenize(mapped)]
        n = len(tokens)
        return _PACK[n](*tokens) if n < len(_PACK) else struct.pack(f"<{n}I", *tokens)

    def _after_space(self, chunk: str) -> bytes:
        """Ids of a chunk and the space before it, or of one that begins with a line feed."""
        if chunk.isalpha():
            return self._word(" " + chunk)
        if chunk[:1] == "\n":
            if len(chunk) == 1 or chunk[1].isspace():
                raise _Uneven
            return self._chunk(chunk)
        if not chunk or chunk[0].isspace():
            raise _Uneven
        letters = chunk.rstrip(_MARKS)
        if letters.isalpha():
            return self.after_space[letters] + self.words[chunk[len(letters):]]
        return self._chunk(" " + chunk)

    def _chunk(self, chunk: str) -> bytes:
        simple = self._LETTERS.fullmatch(chunk)
        if simple is None:
            return self.whole(chunk)
        before, letters, marks = simple.groups()
        words = self.words
        ids = words["\n"] + words[letters] if before == "\n" else words[before + letters]
        return ids + words[marks] if marks else ids

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if "  " not in text and "\n\n" not in text:
            first, *rest = text.replace("\n", " \n").split(" ")
            try:
                ids = b"".join(map(self.after_space.__getitem__, rest))
                return self.chunks[first] + ids if first else ids
            except _Uneven:
                pass
        return b"".join([self.chunks[c] for c in self._CUT.split(text) if c])


def chunk_ids(path: str) -> ChunkIds:
    if path not in _MEMORY:
        _MEMORY[path] = ChunkIds(path)
    return _MEMORY[path]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text", *, file_ids: int = FILE_IDS,
                 block_ids: int = BLOCK_IDS) -> None:
    """Write every document's ids and ``end_id`` to files below ``path``, by ascending id.

    Documents are range-partitioned by (id, hash of the text) and sorted, so a task's files follow
    those of the task before it and an id that many rows share is still spread. A task holds one
    file's ids. The files go through Spark's own writer (a binary column as one line a file), to
    any file system that Spark writes to, and a lost task leaves no file behind.

    NULL text is empty (the end id alone); NULL ids come first, rows that share an id follow each
    other; an empty table leaves no file; other columns are ignored. A document is never split, so
    a very long one makes a file longer. ``tokenizer`` is a path on every executor.
    """
    end = struct.pack("<I", end_id)

    def encode(batches):
        from pyspark import TaskContext
        task, number = TaskContext.get().partitionId(), 0
        known = chunk_ids(tokenizer)
        bits = bits_for(max(known.vocabulary, end_id + 1))
        parts, ids, starts, size = [], [], [], 0

        def close():
            flat = np.frombuffer(b"".join(parts), dtype="<u4")
            index = pa.RecordBatch.from_arrays(
                [pa.concat_arrays(ids), pa.array(starts, pa.int64())], ["id", "start"])
            return pa.RecordBatch.from_arrays([pa.array(
                [file_bytes(flat, index, bits, task, number, block_ids)], pa.binary())], ["value"])

        for batch in batches:
            first = 0
            for i, text in enumerate(batch.column(1)):
                body = known.encode(text.as_py() or "") + end
                parts.append(body)
                starts.append(size)
                size += len(body) // 4
                if size >= file_ids:
                    ids.append(batch.column(0).slice(first, i + 1 - first))
                    yield close()
                    parts, ids, starts, size, first = [], [], [], 0, i + 1
                    number += 1
            if first < batch.num_rows:
                ids.append(batch.column(0).slice(first))
        if parts:
            yield close()

    order = ("id", "h")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn(
        "h", F.xxhash64("text"))
    files = (rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
             .mapInArrow(encode, "value binary"))
    (files.select(F.col("value").cast("string").alias("value")).write
     .option("maxRecordsPerFile", 1).option("compression", "none").text(path))


def read_tokens(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """``task, number, id, start, n_tokens, ids_crc32`` of every document in the files of ``path``.

    ``start`` counts from the beginning of the document's file. ``ids_crc32`` is the unsigned CRC
    of the ids read back, as little-endian unsigned 32-bit numbers.
    """
    def unpack(batches):
        for batch in batches:
            for content in batch.column(0):
                file = TokenFile(content.as_buffer())
                index = file.index()
                starts = index.column(1).to_numpy()
                stops = np.append(starts[1:], file.ids)
                flat = file.read(0, file.ids).tobytes()
                crc = [zlib.crc32(flat[4 * a:4 * b]) for a, b in zip(starts, stops)]
                n = index.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, file.task, dtype=np.int32)),
                     pa.array(np.full(n, file.number, dtype=np.int32)), index.column(0),
                     index.column(1), pa.array(stops - starts), pa.array(crc, pa.int64())],
                    ["task", "number", "id", "start", "n_tokens", "ids_crc32"])

    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
             .select("content"))
    return files.mapInArrow(unpack, f"task int, number int, id {id_type}, start bigint, "
                                    "n_tokens bigint, ids_crc32 bigint")


def token_index(docs: DataFrame, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id",
                text_col: str = "text", path: str | None = None, **sizes: int) -> DataFrame:
    """``id, start, n_tokens, ids_crc32`` of every document, from the files that were written.

    ``start`` is the number of ids of all documents before it: its place in its file, after the
    files before (running sums over files within a task and over tasks, a row each). The files go
    to ``path``, or to the shared scratch folder. See ``write_tokens`` for NULL, empty and repeated
    rows; an empty table gives no rows.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-ids")
    write_tokens(docs, path, tokenizer, end_id, id_col, text_col, **sizes)
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    found = materialize(read_tokens(spark, path, id_type), "token-index")
    files = found.groupBy("task", "number").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.unboundedPreceding, -1
    inside = F.sum("n").over(Window.partitionBy("task").orderBy("number").rowsBetween(*earlier))
    tasks = files.groupBy(F.col("task").alias("t")).agg(F.sum("n").alias("n")).select(
        "t", F.sum("n").over(Window.orderBy("t").rowsBetween(*earlier)).alias("before"))
    base = files.withColumn("inside", inside).join(tasks, F.col("task") == F.col("t")).select(
        F.col("task").alias("b_task"), F.col("number").alias("b_number"),
        (F.coalesce("inside", F.lit(0)) + F.coalesce("before", F.lit(0))).alias("base"))
    return found.join(base, (F.col("task") == F.col("b_task"))
                      & (F.col("number") == F.col("b_number"))).select(
        F.col("id").alias(id_col), (F.col("base") + F.col("start")).alias("start"), "n_tokens",
        "ids_crc32")
