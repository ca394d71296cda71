"""Language-model scores from a hashed maximum-entropy model with class-factored softmax."""

from __future__ import annotations

import zlib
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolescope.llm.base import (UPDATE, average_models, hash_span_sets, materialize, mix,
                                model_update, text_slices, word_spans)
from rolescope.llm.word_tree import (GROUPS, LAYERS, PARTS, UNIT, Paths, Tree, context_hash, layer,
                                     part_of, weights)

_U = np.uint64
END_TOKEN = _U(0x5EED5EED5EED5EED)  # no word hashes to it but by chance


@dataclass(frozen=True)
class LmPlan:
    """``chunk_bytes`` of text share a vocabulary; buckets x ``classes`` weights are learned.

    There are ``buckets`` to start with, and more as the training vocabulary grows (a quarter of
    its size, as a power of two), at most ``most_buckets``: the model must fit a task. ``ridge``
    holds back the weights of contexts inside the classes.
    """

    chunk_bytes: int = 6 << 20
    classes: int = 32
    buckets: int = 1 << 13
    most_buckets: int = 1 << 16
    rounds: int = 2
    batch: int = 4096
    rate: float = 0.2
    ridge: float = 4.0

    @property
    def cells(self) -> int:
        """Weights of the decisions inside the classes, for each group of contexts."""
        return 16 * self.buckets

    def grown(self, words: int) -> LmPlan:
        """The plan for a training vocabulary of so many words."""
        wanted = 1 << max(words // 4 - 1, 0).bit_length()
        return replace(self, buckets=max(self.buckets, min(wanted, self.most_buckets)))


def held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def _pack(values: np.ndarray, kind: str = "<u4") -> bytes:
    """Whole numbers as compressed byte planes: the high planes of small ones are zeros."""
    raw = values.astype(kind)
    planes = np.ascontiguousarray(raw.view(np.uint8).reshape(-1, raw.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(raw: bytes, kind: str = "<u4") -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    planes = planes.reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel().astype(np.int64)


def _encode(docs: DataFrame, plan: LmPlan) -> DataFrame:
    """Chunks of whole documents as vocabulary indices, and each chunk's vocabulary.

    Rows with a ``body``: ids, held-out marks and lengths of a chunk's documents and their token
    indices. Rows with a ``tok``: token hash, place (chunk and index), training count with class.
    """
    id_type = docs.schema["id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    arrow_id = to_arrow_type(id_type)
    names = ["chunk", "ids", "held", "lens", "body", "tok", "place", "seen"]
    kinds = [pa.int64(), pa.list_(arrow_id), pa.list_(pa.bool_()),
             pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def flush(number, ids, tokens, classes, lens):
        held = np.array([held_out(i) for i in ids])
        tokens, classes = np.concatenate(tokens), np.concatenate(classes)
        by_word = np.argsort(tokens)
        ordered = tokens.take(by_word)
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        at = np.flatnonzero(new)
        words, count = ordered.take(at), np.diff(at, append=len(tokens))
        kind = classes.take(by_word.take(at))  # the same wherever the word stands
        lid = np.empty(len(tokens), dtype=np.int64)
        lid[by_word] = np.cumsum(new) - 1
        order = np.argsort(-count, kind="stable")  # frequent words get small indices
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        lid = place[lid]
        learned = np.bincount(lid, weights=~np.repeat(held, lens), minlength=len(words))
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip(
                [number, ids, held.tolist(), lens, _pack(lid), None, None, None],
                kinds)], names)
        n = len(words)
        for low in range(0, n, 100_000):
            part = slice(low, min(low + 100_000, n))
            size = part.stop - low
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size, number)), *[pa.nulls(size, k) for k in kinds[1:5]],
                 pa.array(words[order][part].view(np.int64)),
                 pa.array((number << 24) + np.arange(low, part.stop)),
                 pa.array(learned[part].astype(np.int64) * 256 + kind[order][part])],
                names)

    def run(batches):
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 16
        ids, tokens, classes, lens, size = [], [], [], [], 0
        for batch in batches:
            batch_ids = batch.column(0).to_pylist()
            for first, last, data, bounds in text_slices(batch.column(1)):
                starts, ends = word_spans(data, bounds)
                words, tail = hash_span_sets(
                    data, [(starts, ends), (np.maximum(starts, ends - 3), ends)], fold=True)
                kind = (mix(tail) % _U(plan.classes - 1)).astype(np.uint8) + np.uint8(1)
                at = np.searchsorted(starts, bounds)
                n = np.diff(at)
                into = np.arange(len(words)) + np.repeat(np.arange(len(n)), n)
                own = np.full(len(words) + len(n), END_TOKEN)
                own_kind = np.ones(len(own), dtype=np.uint8)
                own[into], own_kind[into] = words, kind
                ids += batch_ids[first:last]
                tokens.append(own), classes.append(own_kind)
                lens += (n + 1).tolist()
                size += len(data)
                if size >= plan.chunk_bytes:
                    yield from flush(number, ids, tokens, classes, lens)
                    pa.default_memory_pool().release_unused()
                    number += 1
                    ids, tokens, classes, lens, size = [], [], [], [], 0
        if ids:
            yield from flush(number, ids, tokens, classes, lens)

    return docs.mapInArrow(
        run, f"chunk bigint, ids array<{id_type.simpleString()}>, held array<boolean>,"
             " lens array<bigint>, body binary, tok bigint, place bigint, seen bigint")


def _word_buckets(code: np.ndarray, kind: np.ndarray, plan: LmPlan) -> dict[str, np.ndarray]:
    """What a word of the vocabulary gives to the features after it; the last row is a text's edge.

    Code 0 is a word that training never saw, code 1 the edge.
    """
    span = _U(plan.buckets - 2)
    dtype = np.min_scalar_type(plan.buckets - 1)
    code = np.append(code.astype(_U), _U(1))

    def bucket(mixed):
        return np.where(code == 0, 1, mixed % span + _U(2)).astype(dtype)

    by_kind = (mix(np.arange(plan.classes, dtype=_U) + _U(77)) % span + _U(2)).astype(dtype)
    return {"code": code, "pair": mix(code) * _U(3), "one": bucket(mix(code + _U(0x1111))),
            "two": bucket(mix(code + _U(0x2222))), "three": bucket(mix(code + _U(0x3333))),
            "ending": by_kind.take(np.append(kind, 0))}


def _features(lid: np.ndarray, lens: np.ndarray, code: np.ndarray, kind: np.ndarray,
              plan: LmPlan, words: dict[str, np.ndarray] | None = None) -> np.ndarray:
    """Hashed context features of each token: one and two words back, two skips, an ending.

    Every token also has feature 0, the bias. A feature that holds a word which training never saw
    goes to bucket 1, which no training token has and whose weights stay 0; the ending of the word
    before is there for every word. ``words``: the ``_word_buckets`` of ``code`` and ``kind``.
    """
    words = _word_buckets(code, kind, plan) if words is None else words
    start = np.cumsum([0, *lens[:-1]])
    back, own = [], lid
    for _ in range(3):
        own = np.concatenate([[0], own[:-1]])
        own[start] = len(words["code"]) - 1
        back.append(own)
    one, two, three = back
    out = np.empty((len(lid), 5), dtype=words["one"].dtype)
    out[:, 0], out[:, 2] = words["one"].take(one), words["two"].take(two)
    pair = mix(words["pair"].take(one) + words["code"].take(two)) % _U(plan.buckets - 2)
    out[:, 1] = pair + _U(2)
    out[(out[:, 0] == 1) | (out[:, 2] == 1), 1] = 1
    out[:, 3], out[:, 4] = words["three"].take(three), words["ending"].take(one)
    return out


def _softmax(w: np.ndarray, bias: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Class probabilities of tokens, from rows of weights; a row of ``features`` for each token."""
    # take with "clip" copies whole rows; every index is a row of w
    z = w.take(features[:, 0], axis=0, mode="clip")
    row = np.empty_like(z)
    for k in range(1, features.shape[1]):
        z += w.take(features[:, k], axis=0, mode="clip", out=row)
    z += bias
    ones = np.ones(z.shape[1], dtype=z.dtype)
    if z.max(initial=0) < 60:
        p = np.exp(z, out=row)
        total = p @ ones
        if total.min(initial=1) > 1e-20:
            p /= total[:, None]
            return p
    z -= z.max(axis=1, keepdims=True)  # weights so large that their powers would not be numbers
    np.exp(z, out=z)
    z /= (z @ ones)[:, None]
    return z


@dataclass(frozen=True)
class Totals:
    """Counts over all training tokens: tokens, distinct, seen once, seen twice, mass by class."""

    tokens: int
    words: int
    once: int
    twice: int
    mass: tuple[int, ...]


def _rows(batch: pa.RecordBatch):
    """The rows one at a time: each may hold megabytes."""
    for i in range(batch.num_rows):
        yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}
        pa.default_memory_pool().release_unused()


class Chunk:
    """A chunk's documents with the corpus counts of its vocabulary."""

    def __init__(self, row: dict, totals: Totals, plan: LmPlan):
        self.ids, self.held = row["ids"], np.array(row["held"], dtype=bool)
        self.lens = np.array(row["lens"], dtype=np.int64)
        self.lid = _unpack(row["body"])
        self.count = _unpack(row["counts"])
        self.kind = np.frombuffer(row["kinds"], dtype=np.uint8).astype(np.int64)
        self.cls = np.where(self.count >= 2, self.kind, 0)
        self.code = _unpack(row["codes"]).astype(_U)
        self.rank = _unpack(row["ranks"])
        self.plan = plan
        self.words = _word_buckets(self.code, self.kind, plan)

    def batches(self, learn: bool):
        """``rows, features`` of the tokens to learn from (or of all), a batch at a time."""
        keep = np.repeat(~self.held, self.lens) if learn else None
        step = 1 << 17
        bounds = np.concatenate([[0], np.cumsum(self.lens)])
        first = 0
        while first < len(self.lens):  # whole documents at a time
            last = max(int(np.searchsorted(bounds, bounds[first] + step, side="right")) - 1,
                       first + 1)
            a, b = bounds[first], bounds[last]
            features = _features(self.lid[a:b], self.lens[first:last], self.code, self.kind,
                                 self.plan, self.words)
            rows = np.arange(a, b)
            if keep is not None:
                rows, features = rows[keep[a:b]], features[keep[a:b]]
            for low in range(0, len(rows), self.plan.batch):
                yield rows[low:low + self.plan.batch], features[low:low + self.plan.batch]
            first = last

    def paths(self, tree: Tree) -> Paths:
        return Paths(tree, self.count, self.cls, self.code, self.rank)

    def before(self) -> np.ndarray:
        """The index of the word before each token; the vocabulary's size is a text's edge."""
        out = np.concatenate([[0], self.lid[:-1]])
        out[np.cumsum([0, *self.lens[:-1]])] = len(self.code)
        return out

    def contexts(self) -> list[np.ndarray]:
        """What a word before says inside the classes, by group: its ending, and itself if known."""
        code = self.words["code"]
        return [context_hash(np.append(self.kind, 0), 0x4444),
                np.where(code == 0, np.uint32(0), context_hash(code, 0x5555))]

    def pairs(self, by_ending: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The different pairs ``word, word before`` of the tokens to learn from, and their counts.

        ``by_ending``: one word before stands for all that have its ending.
        """
        keep = np.repeat(~self.held, self.lens)
        word, before, n = self.lid[keep], self.before()[keep], len(self.code) + 1
        if by_ending:
            kind = np.append(self.kind, 0)
            some = np.zeros(self.plan.classes, dtype=np.int64)
            some[kind] = np.arange(n)
            before = some.take(kind.take(before))
        found, count = np.unique(word * n + before, return_counts=True)
        return found // n, found % n, count


def _count_words(table: pa.Table, classes: int) -> pa.Table:
    """The rows of a part's words with each word's training count, class and rank in its layer.

    The rank is among the part's words of the same class and layer, by hash. Rows of a negative
    chunk give the layers' sizes: ``place`` is the layer, ``rank`` its words, ``c`` their tokens.
    """
    tok, place, seen = (table[n].to_numpy() for n in ("tok", "place", "seen"))
    order = np.argsort(tok, kind="stable")
    tok, place, seen = tok.take(order), place.take(order), seen.take(order)
    new = np.concatenate([[True], tok[1:] != tok[:-1]])
    starts = np.flatnonzero(new)
    count, kind = np.add.reduceat(seen >> 8, starts), seen.take(starts) & 255
    first = np.minimum.reduceat(place, starts)
    cell = np.where(count >= 2, kind, 0) * LAYERS + layer(count)
    cell[count == 0] = classes * LAYERS  # not a word of training
    by_cell = np.argsort(cell, kind="stable")
    sizes = np.bincount(cell, minlength=classes * LAYERS + 1)
    rank = np.empty(len(cell), dtype=np.int64)
    rank[by_cell] = np.arange(len(cell)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    mass = np.bincount(cell, weights=count)[:classes * LAYERS].astype(np.int64)
    cells = np.flatnonzero(sizes[:classes * LAYERS])
    each = np.cumsum(new) - 1
    part = int(part_of(tok[:1].view(_U))[0])

    def column(of_words, of_cells, kind):
        return pa.array(np.concatenate([of_words, of_cells]).astype(kind))

    none = np.zeros(len(cells))
    return pa.table({
        "chunk": column(place >> 24, none - 1 - part, np.int64),
        "code": column((tok & 0xFFFFFFFF).astype(np.uint32).view(np.int32), none, np.int32),
        "place": column(place & 0xFFFFFF, cells, np.int32),
        "k": column(kind.take(each), none, np.int8),
        "c": column(count.take(each), mass[cells], np.int64),
        "first": column(place == first.take(each), none, bool),
        "rank": column(rank.take(each), sizes[cells], np.int32)})


COUNTED = "chunk bigint, code int, place int, k tinyint, c bigint, first boolean, rank int"


def _tree(parts: list, classes: int) -> Tree:
    """From rows ``chunk, codes, counts, ranks`` of the negative chunks."""
    sizes = np.zeros((classes * LAYERS, PARTS), dtype=np.int64)
    mass = np.zeros(classes * LAYERS)
    for row in parts:
        cells = _unpack(row["codes"])
        sizes[cells, -1 - row["chunk"]] = _unpack(row["ranks"])
        mass[cells] += _unpack(row["counts"], "<i8")
    return Tree(sizes, mass, classes)


MOVES = "part bigint, block int, push binary, curve binary"


def _moves(part: int, block: int, push: np.ndarray, curve: np.ndarray) -> list:
    """Values of a row of ``MOVES``; the sign of a gradient goes to its lowest bit."""
    return [part, block, _pack((push << 1) ^ (push >> 63), "<i8"), _pack(curve, "<i8")]


def _task_moves(sums: np.ndarray, blocks: int = 16) -> pa.RecordBatch:
    """The gradients and second derivatives of a task in slices, as sixteenths."""
    from pyspark import TaskContext
    part = TaskContext.get().partitionId()
    push, curve = ((x + 8) >> 4 for x in (sums >> 32, sums & 0xFFFFFFFF))
    rows = [_moves(part, i, p, c) for i, (p, c) in enumerate(
        zip(np.array_split(push, blocks), np.array_split(curve, blocks)))]
    return pa.RecordBatch.from_arrays(
        [pa.array(v, k) for v, k in zip(zip(*rows), (pa.int64(), pa.int32(), pa.binary(),
                                                     pa.binary()))],
        ["part", "block", "push", "curve"])


def _added(updates: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """The sums of all tasks, added as ``average_models`` does: in groups, then by slice."""
    def total(rows) -> tuple[np.ndarray, np.ndarray]:
        push = curve = 0
        for p, c in rows:
            p = _unpack(p, "<i8")
            push, curve = push + ((p >> 1) ^ -(p & 1)), curve + _unpack(c, "<i8")
        return push, curve

    def add(group: pd.DataFrame) -> pd.DataFrame:
        sums = total(zip(group["push"], group["curve"]))
        return pd.DataFrame([_moves(group["part"].iloc[0] // 32, group["block"].iloc[0], *sums)],
                            columns=["part", "block", "push", "curve"])

    scaled = updates.withColumn("part", F.floor(F.col("part") / 32).cast("bigint"))
    once = scaled.groupBy("part", "block").applyInPandas(add, MOVES)
    rows = (once.withColumn("part", F.lit(0).cast("bigint")).groupBy("part", "block")
            .applyInPandas(add, MOVES).orderBy("block").collect())
    if not rows:
        return None
    found = [total([(r["push"], r["curve"])]) for r in rows]
    return tuple(np.concatenate(x) * (16 / UNIT) for x in zip(*found))


def _run_sums(p: np.ndarray, rows: np.ndarray, starts: np.ndarray, fan: int = 8) -> np.ndarray:
    """The sums of ``p[rows]`` over the runs that begin at ``starts``, one row for each run.

    ``np.add.reduceat`` takes a step for each run and column; this one adds whole arrays. Most runs
    hold one row, and short ones are added row by row, all runs at once. Longer runs are summed in
    groups of ``fan`` rows, then their sums likewise until one is left.
    """
    sizes = np.diff(starts, append=len(rows))
    out = p.take(rows.take(starts), axis=0, mode="clip")
    short = np.flatnonzero((sizes > 1) & (sizes <= fan // 2))
    for k in range(1, fan // 2):
        out[short] += p.take(rows.take(starts.take(short) + k), axis=0, mode="clip")
        short = short[sizes.take(short) > k + 1]
    runs = np.flatnonzero(sizes > fan // 2)
    begin, sizes, values = starts[runs], sizes[runs], p
    while len(runs):
        groups = -(-sizes // fan)
        ends = np.cumsum(groups)
        first = np.repeat(begin - fan * (ends - groups), groups) + fan * np.arange(ends[-1])
        last = np.repeat(begin + sizes - 1, groups)
        sums = values.take(rows.take(first), axis=0, mode="clip")
        for k in range(1, fan):
            more = values.take(rows.take(np.minimum(first + k, last)), axis=0, mode="clip")
            more[first + k > last] = 0  # the last group of a run may be short
            sums += more
        done = groups == 1
        out[runs[done]] = sums[ends[done] - 1]
        runs, begin, sizes = runs[~done], (ends - groups)[~done], groups[~done]
        values, rows = sums, np.arange(len(sums))
    return out


def _put(table: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """``table[at] = rows``, a whole row copied at a time."""
    whole = np.dtype((np.void, table.shape[1] * table.itemsize))
    table.view(whole)[:, 0][at] = rows.view(whole)[:, 0]


def _descend(w: np.ndarray, square: np.ndarray, features: np.ndarray, target: np.ndarray,
             rate: float) -> None:
    """One AdaGrad step of the class softmax on a batch of tokens, sparse in the features.

    The rows of the two tables that the batch touches are read and written once, in their order.
    """
    each = features.shape[1]
    flat = features.ravel()  # numpy sorts numbers of 16 bits by radix
    order = np.argsort(flat, kind="stable")
    flat = flat.take(order)
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    starts = np.flatnonzero(new)
    touched = flat.take(starts).astype(np.intp)
    place = np.empty(len(flat), dtype=np.intp)
    place[order] = np.cumsum(new) - 1
    own = w.take(touched, axis=0, mode="clip")
    p = _softmax(own, w[0], place.reshape(-1, each))
    p[np.arange(len(target)), target] -= 1
    p /= np.float32(len(target))
    bias = np.ones(len(p), dtype=p.dtype) @ p  # of feature 0, which no other is
    square[0] += bias * bias
    w[0] -= np.float32(rate) * bias / np.sqrt(square[0])
    g = _run_sums(p, order // each, starts)
    seen = square.take(touched, axis=0, mode="clip")
    seen += g * g
    _put(square, touched, seen)
    np.sqrt(seen, out=seen)
    g *= np.float32(rate)
    g /= seen
    own -= g
    _put(w, touched, own)


def lm_scores(docs: DataFrame, plan: LmPlan = LmPlan(), id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    Tokens are words (A-Z lower-cased) and an end token. Documents are encoded once in chunks of
    bounded size against the chunk's own vocabulary; each word's counts are summed over the whole
    corpus and go back to the chunks that have it, so what is shuffled is one row per chunk and
    distinct word, and no vocabulary is broadcast or collected. Documents with crc32(id as text) mod 7 = 2 are held out.

    The model: a word of training count two or more belongs to a class by its ending; class 0
    holds words seen once and the unseen word. P(word | context) = P(class | context) times
    P(word | class, context). The first factor is a maximum-entropy model over hashed n-gram and
    skip features of the three words before (each word of training, however rare, by its own hash)
    and the ending of the last one, learned by AdaGrad steps in numpy batches: every task
    starts a round from the common weights and sees its chunks once; the mean of their models,
    weighted by tokens, starts the next. The second is the product of the decisions that lead to the
    word in its class's tree (``word_tree``): their log odds start from the sizes of both sides and
    add hashed weights of the ending of the word before and of that word, each group learned by a
    regularised Newton step over all training tokens. Class 0 splits between the unseen word and
    those seen once as Good-Turing counts suggest. All outcomes sum to one.

    NULL text is empty (the end token alone), a NULL id has crc32 0 (training), repeated rows count
    each time, an empty table gives no rows, other columns are ignored.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    spark = docs.sparkSession
    id_type = docs.select(id_col).schema[0].dataType
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    encoded = materialize(_encode(source, plan), "lm-encoded")
    words = encoded.where("tok IS NOT NULL").select("tok", "place", "seen")
    # a word's rows are one for each chunk that has it, never one for each document
    part = F.shiftright("tok", 8).bitwiseAND(PARTS - 1).cast("int")
    counted = words.withColumn("part", part).groupBy("part").applyInArrow(
        lambda table: _count_words(table, plan.classes), COUNTED)

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        if group["chunk"].iloc[0] < 0:  # sizes of a part's layers
            return pd.DataFrame({
                "chunk": group["chunk"].iloc[:1], "codes": [_pack(group["place"].to_numpy())],
                "kinds": [b""], "counts": [_pack(group["c"].to_numpy(), "<i8")],
                "ranks": [_pack(group["rank"].to_numpy())], "tokens": [0], "words": [0],
                "once": [0], "twice": [0], "mass": [[0] * plan.classes]})
        group = group.sort_values("place")
        c, k = group["c"].to_numpy(), group["k"].to_numpy().astype(np.int64)
        own = np.where(c >= 2, k, 0)
        # every word of the training texts is a context of its own (1 is the text's edge)
        code = np.where(c > 0, np.maximum(group["code"].to_numpy().view(np.uint32), 2), 0)
        new = group["first"].to_numpy(dtype=bool)
        return pd.DataFrame({
            "chunk": group["chunk"].iloc[:1], "codes": [_pack(code)],
            "kinds": [k.astype(np.uint8).tobytes()],
            "counts": [_pack(np.minimum(c, 2 ** 32 - 1))],
            "ranks": [_pack(group["rank"].to_numpy())],
            "tokens": [int(c[new].sum())], "words": [int((c[new] > 0).sum())], "once": [int((c[new] == 1).sum())],
            "twice": [int((c[new] == 2).sum())],
            "mass": [np.bincount(own[new], weights=np.where(c[new] >= 2, c[new], 0),
                                 minlength=plan.classes).astype(np.int64).tolist()]})

    vocabulary = materialize(counted.groupBy("chunk").applyInPandas(
        gather, "chunk bigint, codes binary, kinds binary, counts binary, ranks binary, "
                "tokens bigint, words bigint, once bigint, twice bigint, mass array<bigint>"), "lm-vocabulary")
    found = vocabulary.agg(
        F.sum("tokens").alias("tokens"), F.sum("words").alias("words"), F.sum("once").alias("once"), F.sum("twice").alias("twice"),
        *[F.sum(F.col("mass")[i]).alias(f"m{i}") for i in range(plan.classes)]).first()
    mass = [int(found[f"m{i}"] or 0) for i in range(plan.classes)]
    totals = Totals(*[int(found[n] or 0) for n in ("tokens", "words", "once", "twice")],
                    tuple(mass))
    chunks = materialize(
        encoded.where("body IS NOT NULL").select("chunk", "ids", "held", "lens", "body")
        .join(vocabulary.where("chunk >= 0").select("chunk", "codes", "kinds", "counts", "ranks"),
              "chunk"), "lm-chunks")

    plan = plan.grown(totals.words)
    w = np.zeros((plan.buckets, plan.classes), dtype=np.float32)
    # the bias starts from the class shares; classes without words can never occur
    share = np.array([max(totals.once, 1), *mass[1:]], dtype=np.float64)
    w[0] = np.where(share > 0, np.log(np.maximum(share, 1) / share.sum()), -60.0)

    def learn(w):
        shared = spark.sparkContext.broadcast(w)  # at most most_buckets x classes

        def run(batches):
            start = shared.value
            own, square = start.copy(), np.full_like(start, 1e-4)
            seen = 0
            for batch in batches:
                for row in _rows(batch):
                    chunk = Chunk(row, totals, plan)
                    for rows, features in chunk.batches(learn=True):
                        _descend(own, square, features, chunk.cls[chunk.lid[rows]], plan.rate)
                        seen += len(rows)
            yield model_update(own - start, float(seen), 16)

        return average_models(chunks.mapInArrow(run, UPDATE), w.shape)

    for _ in range(plan.rounds):
        step = learn(w)
        if step is None:
            break
        w = w + step
    final = spark.sparkContext.broadcast(w)

    tree = _tree(vocabulary.where("chunk < 0").select("chunk", "codes", "counts", "ranks")
                 .collect(), plan.classes)  # at most PARTS x classes x LAYERS sizes
    leaves = spark.sparkContext.broadcast(tree)

    def learn_words(tables):
        shared = spark.sparkContext.broadcast(tables)

        def run(batches):
            tables, tree = shared.value, leaves.value
            sums = np.zeros(plan.cells + 1, dtype=np.int64)
            for batch in batches:
                for row in _rows(batch):
                    chunk = Chunk(row, totals, plan)
                    words, before, count = chunk.pairs(by_ending=not tables)
                    chunk.paths(tree).learn(words, count, before, chunk.contexts(), tables, sums)
            yield _task_moves(sums)

        return _added(chunks.mapInArrow(run, MOVES))

    tables = []
    for _ in GROUPS:
        sums = learn_words(tables)
        if sums is None:
            break
        tables.append(weights(*sums, plan.ridge))
    inside = spark.sparkContext.broadcast(tables)
    arrow_id = to_arrow_type(id_type)
    # class 0: the unseen word against all words seen once, whose tree has what it leaves
    once, twice = totals.once, totals.twice
    unseen = min(once / (once + 2 * twice), 0.99) if once else 1.0
    log_unseen = np.log10(unseen)
    log_seen = np.log10(1 - unseen) if once else 0.0

    def score(batches):
        w, tree, tables = final.value, leaves.value, inside.value
        for batch in batches:
            for row in _rows(batch):
                chunk = Chunk(row, totals, plan)
                count, lid = chunk.count, chunk.lid
                within = np.where(count >= 2, 0, np.where(count == 1, log_seen, log_unseen))
                logs = np.empty(len(lid))
                for rows, features in chunk.batches(learn=False):
                    p = _softmax(w, w[0], features)
                    kind = chunk.cls[lid[rows]]
                    logs[rows] = np.log10(np.maximum(p[np.arange(len(rows)), kind], 1e-30))
                logs += within[lid]
                logs += chunk.paths(tree).log_share(lid, chunk.before(), chunk.contexts(), tables)
                base = np.log10((count + 1) / (totals.tokens + totals.words + 1))
                at = np.cumsum([0, *chunk.lens[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chunk.ids, arrow_id), pa.array(chunk.held),
                     pa.array(chunk.lens), pa.array(np.add.reduceat((count > 0)[lid]
                                                                    .astype(np.int64), at)),
                     pa.array(np.full(len(at), totals.tokens)),
                     pa.array(np.add.reduceat(base[lid], at)),
                     pa.array(np.add.reduceat(logs, at))],
                    ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score",
                     "score"])

    out = chunks.mapInArrow(
        score, f"id {id_type.simpleString()}, held_out boolean, n_tokens bigint, n_known bigint, "
               "train_tokens bigint, base_score double, score double")
    return out.withColumnRenamed("id", id_col)
