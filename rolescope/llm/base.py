"""Shared helpers: scratch tables, word hashing in numpy, connected components."""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolescope.session import scratch_path

# Bytes of text hashed at a time: intermediate arrays stay in the processor's cache.
SLICE_BYTES = 1 << 19
# Edges that a task of the connected-components loop takes at least.
EDGES_PER_TASK = 100_000
# ASCII white space, as in the word pattern [^\x20\x09-\x0D]+
SPACES = bytes([32, 9, 10, 11, 12, 13])

_U = np.uint64
_MULT = 0x9E3779B97F4A7C15 | 1


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """The name, with as many underscores behind as keep it apart from the table's columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def materialize(df: DataFrame, name: str, partitions: tuple[str, ...] = ()) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder of ``spark.checkpoint.dir`` (a local one in tests only)."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        root = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            root = tempfile.mkdtemp(prefix="rolescope-")
        context.setCheckpointDir(root)
    return df.checkpoint(eager=True)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over a 64-bit word."""
    x = np.asarray(x, dtype=_U)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _byte_codes(fold: bool) -> np.ndarray:
    codes = mix(np.arange(1, 257, dtype=_U) * _U(_MULT))
    if fold:
        codes[65:91] = codes[97:123]
    return codes


_CODES = {fold: _byte_codes(fold) for fold in (False, True)}
_SPACE = np.isin(np.arange(256), list(SPACES))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the (odd) multiplier and of its inverse modulo 2**64."""
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        for key, base in (("up", _MULT), ("down", pow(_MULT, -1, 1 << 64))):
            steps = np.full(size, base, dtype=_U)
            steps[0] = 1
            _POWERS[key] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def word_spans(data: np.ndarray, bounds: np.ndarray, gaps: np.ndarray = _SPACE,
               ) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions at which words start and end; ``gaps`` marks the bytes between words."""
    n = len(data)
    gap = np.ones(n + 1, dtype=bool)
    np.take(gaps, data, out=gap[:n])
    cut = np.zeros(n + 1, dtype=bool)
    cut[bounds] = True
    start = ~gap[:n]
    end = start & (gap[1:] | cut[1:])
    start[1:] &= gap[:n - 1] | cut[1:n] if n else True
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False,
               ) -> np.ndarray:
    """64-bit hashes of the given byte spans; ``fold`` lower-cases A-Z."""
    return hash_span_sets(data, [(starts, ends)], fold)[0]


def hash_span_sets(data: np.ndarray, sets: list[tuple[np.ndarray, np.ndarray]], fold: bool = False,
                   ) -> list[np.ndarray]:
    """``hash_spans`` of several sets of spans in the same bytes, whose running sum is taken once."""
    n = len(data)
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, dtype=_U)
    codes = _CODES[fold].take(data)
    codes *= up[:n]
    np.cumsum(codes, out=total[1:])
    return [mix((total.take(ends) - total.take(starts)) * down.take(starts)
                + (ends - starts).astype(_U)) for starts, ends in sets]


def hash_words(data: np.ndarray, bounds: np.ndarray, fold: bool = False,
               ) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of several texts, and where each text's words begin.

    ``data`` holds the UTF-8 bytes, text ``i`` is ``data[bounds[i]:bounds[i + 1]]``. Returns 64-bit
    word hashes and ``len(bounds)`` offsets into them.
    """
    starts, ends = word_spans(data, bounds)
    return hash_spans(data, starts, ends, fold), np.searchsorted(starts, bounds)


def text_slices(column: pa.Array, limit: int = SLICE_BYTES):
    """``first, last, data, bounds`` over consecutive texts of about ``limit`` bytes; null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[
        column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last, data[offsets[first]:offsets[last]], \
            offsets[first:last + 1] - offsets[first]
        first = last
    pa.default_memory_pool().release_unused()  # workers outlive their tasks


def rolling(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes (empty if there are fewer)."""
    if len(words) < n:
        return np.zeros(0, dtype=_U)
    up, down = _powers(len(words) + 1)
    total = np.zeros(len(words) + 1, dtype=_U)
    np.cumsum(words * up[:len(words)], out=total[1:])
    return mix((total[n:] - total[:-n]) * down[:len(words) - n + 1])


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest item reachable from each of ``n`` items over the given pairs (in one task)."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root``: the smallest node of each node's connected component.

    Alternating large-star and small-star steps: every step is one minimum per node (combined
    before the shuffle) and one join, the number of edges never grows, and a chain of any length
    is halved by each round. Nodes without an edge are not returned. Each round is checkpointed and
    merged into as many partitions as its edges need.
    """
    state = checkpoint(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                       .where("u <> v").distinct())

    def star(pairs: DataFrame) -> DataFrame:
        low = pairs.groupBy("u").agg(F.min("v").alias("low"))
        return pairs.join(low, "u").withColumn("m", F.least("u", "low"))

    def mark(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    def two_each(df: DataFrame, *ends: tuple[str, str]) -> DataFrame:
        return df.select(F.inline(F.array(*[
            F.struct(F.col(x).alias("u"), F.col(y).alias("v")) for x, y in ends])))

    def merged(df: DataFrame, edges: int) -> DataFrame:
        return df.coalesce(edges // EDGES_PER_TASK + 1)

    seen = mark(state)
    while seen[0]:
        state = merged(state, seen[0])
        both = two_each(state, ("u", "v"), ("v", "u"))
        large = star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = star(large)
        state = checkpoint(two_each(small, ("v", "m"), ("u", "m")).where("u <> v").distinct())
        now = mark(state)
        if now == seen:
            break
        seen = now
    state = merged(state, seen[0])
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def average_models(updates: DataFrame, shape: tuple[int, ...]) -> np.ndarray | None:
    """The mean of local models, weighted by what each has seen; None if nothing was.

    ``updates`` has rows ``part, block, weight, delta``: a slice of one task's model change as
    float32 bytes. Slices are added in groups of 32 tasks and then by slice, so that no task holds
    more than a few of them for any number of partitions; the driver gets one model.
    """
    import pandas as pd

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(d, dtype=np.float32) for d in group["delta"])
        return pd.DataFrame({"part": [group["part"].iloc[0] // 32],
                             "block": [group["block"].iloc[0]],
                             "weight": [group["weight"].sum()], "delta": [total.tobytes()]})

    schema = "part bigint, block int, weight double, delta binary"
    scaled = updates.withColumn("part", F.floor(F.col("part") / 32).cast("bigint"))
    once = scaled.groupBy("part", "block").applyInPandas(add, schema)
    rows = (once.withColumn("part", F.lit(0).cast("bigint")).groupBy("part", "block")
            .applyInPandas(add, schema).orderBy("block").collect())
    if not rows or not rows[0]["weight"]:
        return None
    flat = np.concatenate([np.frombuffer(r["delta"], dtype=np.float32) for r in rows])
    return flat.reshape(shape) / np.float32(rows[0]["weight"])


def model_update(delta: np.ndarray, weight: float, blocks: int):
    """Rows of ``average_models`` for one task: the change times its weight, in slices."""
    from pyspark import TaskContext
    parts = np.array_split((delta * np.float32(weight)).astype(np.float32).ravel(), blocks)
    return pa.RecordBatch.from_arrays(
        [pa.array([TaskContext.get().partitionId()] * blocks, pa.int64()),
         pa.array(range(blocks), pa.int32()), pa.array([float(weight)] * blocks),
         pa.array([p.tobytes() for p in parts], pa.binary())],
        ["part", "block", "weight", "delta"])


UPDATE = "part bigint, block int, weight double, delta binary"
