"""Spelling variants: words one edit apart, found by FM-index search schemes."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolescope.llm.base import materialize

# One letter of a run goes when this divides the hash of id and run.
DROP_EVERY = 199


@dataclass(frozen=True)
class SpellingPlan:
    """``block_words`` is the number of words that one index holds, about."""

    least_letters: int = 6
    least_count: int = 5
    form_ratio: int = 5
    block_words: int = 40_000
    # Queries of one length that walk through an index together.
    batch: int = 4096
    # Distinct words whose counts a task holds before it passes them on.
    held: int = 300_000


def word_counts(docs: DataFrame, plan: SpellingPlan = SpellingPlan(), id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``word, n``: the words of the whole table and how often they occur.

    A word is a maximal run of letters up to U+00FF with A-Z lower-cased; of a run whose hash with
    its document's id asks for it, one letter is deleted. Counts are added up in the tasks before
    they are shuffled, and a task holds a bounded number of words.
    """
    least = plan.least_letters
    runs = re.compile(rb"[a-z\xc0-\xff]{%d,}" % least)

    def passed(counts: Counter):
        return pa.RecordBatch.from_arrays(
            [pa.array([w.decode("latin-1") for w in counts], pa.string()),
             pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def count(batches):
        total: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                if not text:
                    continue
                # a letter of these runs is one byte of Latin-1, and bytes fold A-Z alone
                found = Counter(runs.findall(text.encode("latin-1", "replace").lower()))
                salt = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in found.items():
                    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), salt)
                    if h % DROP_EVERY == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1:]
                        if len(run) < least:
                            continue
                    total[run] += n
                if len(total) >= plan.held:
                    yield passed(total)
                    total.clear()
        if total:
            yield passed(total)

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")))


END = 1  # delimiter between words; 0 ends the whole text


class FmIndex:
    """Suffix-rank intervals over ``|word|word|...|``: extending a pattern by a letter on its left.

    The transform's rows are sorted by (letter, row), so a letter's rank of a row is one binary
    search: ``step(c, row)`` is where row ``row`` goes when ``c`` is put before the pattern.
    """

    def __init__(self, words: list[bytes]):
        letters = sorted(set(b"".join(words)))
        self.code = np.zeros(256, dtype=np.int64)
        self.code[letters] = np.arange(2, len(letters) + 2)
        self.sigma = len(letters) + 2
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        self.starts = np.cumsum(lengths + 1) - lengths
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        text = np.full(int(lengths.sum()) + len(words) + 2, END, dtype=np.int64)
        text[-1] = 0
        inside = np.ones(len(text), dtype=bool)
        inside[0] = inside[-1] = False
        inside[self.starts + lengths] = False
        text[inside] = self.code[flat]
        self.suffixes = self._suffix_array(text)
        self.n = len(text)
        self.bwt = text[self.suffixes - 1]
        self.keys = np.sort(self.bwt * (self.n + 1) + np.arange(self.n))

    @staticmethod
    def _suffix_array(text: np.ndarray) -> np.ndarray:
        """Prefix doubling: ranks by 1, 2, 4, ... letters until all differ."""
        n, width = len(text), 1
        rank = text.copy()
        while True:
            after = np.zeros(n, dtype=np.int64)
            after[:n - width] = rank[width:] + 1 if width < n else 0
            key = rank * (rank.max() + after.max() + 2) + after
            order = np.argsort(key, kind="stable")
            new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
            rank = np.empty(n, dtype=np.int64)
            rank[order] = new
            if new[-1] == n - 1:
                return order
            width *= 2

    def step(self, letter: np.ndarray, row: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.keys, letter * (self.n + 1) + row)

    def extend(self, letter, low, high):
        """The intervals with the letter put before, and which of them are not empty."""
        low, high = self.step(letter, low), self.step(letter, high)
        return low, high, np.flatnonzero(high > low)

    def letters_before(self, low: np.ndarray, high: np.ndarray):
        """``state, letter`` pairs of the letters that stand before each interval's rows.

        Narrow intervals are listed row by row; of wide ones every letter is tried.
        """
        width = high - low
        narrow = np.flatnonzero(width <= self.sigma)
        sizes = width[narrow]
        state = np.repeat(narrow, sizes)
        rows = np.arange(len(state)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[state]
        pairs = np.unique(state * self.sigma + self.bwt[rows])
        wide = np.flatnonzero(width > self.sigma)
        tried = (wide[:, None] * self.sigma + np.arange(2, self.sigma)).ravel()
        pairs = np.concatenate([pairs[pairs % self.sigma > END], tried])
        return pairs // self.sigma, pairs % self.sigma

    def one_edit(self, words: np.ndarray, length: int, exact: int) -> tuple[np.ndarray, np.ndarray]:
        """``query, word`` pairs: indexed words that end in a query's last ``exact`` letters, and
        whose other letters become the query's by exactly one edit. A pair may come twice.

        ``words`` are codes, a row a query, all of one length.
        """
        q = np.arange(len(words))
        low = np.full(len(q), self.step(np.int64(END), np.int64(0)))
        high = np.full(len(q), self.step(np.int64(END), np.int64(self.n)))
        for at in range(length - 1, length - exact - 1, -1):
            low, high, kept = self.extend(words[q, at], low, high)
            q, low, high = q[kept], low[kept], high[kept]
        # after the edit: query, interval, and all letters left of position `at` still to match
        edited = [np.zeros(0, dtype=np.int64)] * 3
        for at in range(length - exact, -1, -1):
            state, letter = self.letters_before(low, high)
            s_low, s_high, kept = self.extend(letter, low[state], high[state])
            state, letter, s_low, s_high = state[kept], letter[kept], s_low[kept], s_high[kept]
            inserted = (q[state], s_low, s_high)
            edited = [np.concatenate(x) for x in zip(edited, inserted)]
            if at == 0:
                break
            wanted = words[q, at - 1]
            other = letter != wanted[state]
            replaced = (q[state[other]], s_low[other], s_high[other])
            deleted = (q, low, high)
            e_low, e_high, kept = self.extend(words[edited[0], at - 1], edited[1], edited[2])
            same = (edited[0][kept], e_low[kept], e_high[kept])
            edited = [np.concatenate(x) for x in zip(same, replaced, deleted)]
            low, high, kept = self.extend(wanted, low, high)
            q, low, high = q[kept], low[kept], high[kept]
        low, high, kept = self.extend(np.full(len(edited[0]), END), edited[1], edited[2])
        # words differ, so the delimiters on both sides leave one row
        return edited[0][kept], np.searchsorted(self.starts, self.suffixes[low[kept]] + 1)


def _halves(length: int, side: int) -> int:
    """Letters of the half that must match: the first half (side 0) or the last (side 1)."""
    return length // 2 if side == 0 else length - length // 2


def _search(block: pd.DataFrame, plan: SpellingPlan) -> pd.DataFrame:
    """Near words within one block: for each word asked about, their number and the best one."""
    side = int(block["side"].iloc[0])
    turn = slice(None, None, -1) if side == 0 else slice(None)
    # a word is held under one half or two
    block = block.assign(least=block["held"], most=block["held"]).groupby(
        "word", as_index=False).agg({"n": "first", "asked": "max", "least": "min",
                                     "most": "max"}).sort_values("word")
    words = [w.encode("latin-1") for w in block["word"]]
    n, asked = block["n"].to_numpy(), block["asked"].to_numpy(dtype=bool)
    least, most = (block[c].fillna(0).to_numpy(dtype=np.int64) for c in ("least", "most"))
    at = np.flatnonzero(most)
    size = np.array([len(w) for w in words], dtype=np.int64)
    found_q, found_w = [], []
    if len(at):
        oriented = [words[i][turn] for i in at]
        index = FmIndex(oriented)
        for length in np.unique(size[asked]):
            mine = np.flatnonzero(asked & (size == length))
            for first in range(0, len(mine), plan.batch):
                part = mine[first:first + plan.batch]
                codes = index.code[np.frombuffer(b"".join(words[i][turn] for i in part),
                                                 dtype=np.uint8).reshape(len(part), length)]
                half = _halves(int(length), side)
                q, w = index.one_edit(codes, int(length), half)
                # held under another half, a word is found in that half's block
                mine_too = (least[at[w]] == half) | (most[at[w]] == half)
                found_q.append(part[q[mine_too]]), found_w.append(at[w[mine_too]])
    pairs = np.zeros((0, 2), dtype=np.int64)
    if found_q:
        pairs = np.unique(np.column_stack([np.concatenate(found_q), np.concatenate(found_w)]),
                          axis=0)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    if side == 1 and len(pairs):  # the search from the first half has found these
        pairs = pairs[[not words[w].startswith(words[q][:_halves(len(words[q]), 0)])
                       for q, w in pairs]]
    q, w = pairs[:, 0], pairs[:, 1]
    order = np.lexsort((w, -n[w], q))  # words are in code-point order
    q, w = q[order], w[order]
    new = np.ones(len(q), dtype=bool)
    new[1:] = q[1:] != q[:-1]
    near = np.bincount(q, minlength=len(words))
    best = np.full(len(words), -1)
    best[q[new]] = w[new]
    out = np.flatnonzero(asked)
    names = np.array(block["word"].tolist(), dtype=object)
    return pd.DataFrame({
        "word": names[out], "n": n[out], "n_near": near[out],
        "best": np.array([names[b] if b >= 0 else None for b in best[out]], dtype=object),
        "best_n": pd.array([n[b] if b >= 0 else None for b in best[out]], dtype="Int64")})


def near_words(words: DataFrame, plan: SpellingPlan = SpellingPlan()) -> DataFrame:
    """``word, n, n_near, best, best_n``: how many words lie one edit from each, and the best.

    One edit leaves the first or the last half of a word as it is. A word is therefore asked for
    in the block of its first half and in that of its last half, and is held in the blocks of the
    halves that a near word can have (words one letter shorter or longer have other halves), at
    most four. Each block is an FM-index over its delimited words (over the reversed ones where
    first halves match), whose intervals follow the exact half letter by letter and then branch
    into one insertion, deletion or replacement; the delimiters end the match on both sides. A
    pair that both searches find counts for the first.

    Blocks hold about ``plan.block_words`` words whatever the vocabulary: a half that more words
    share is dealt to several blocks by hash of the held word and asked for in all of them.
    """
    least = plan.least_letters
    # lengths of the halves that words of this length, one less and one more are asked for with
    size = F.length("word")
    lengths = [F.greatest(size + d, F.lit(least)) for d in (-1, 0, 1)]

    def entries(side: int):
        half = (lambda s: F.floor(s / 2).cast("int")) if side == 0 else \
            (lambda s: F.ceil(s / 2).cast("int"))
        cut = (lambda k: F.substring(F.col("word"), F.lit(1), k)) if side == 0 else \
            (lambda k: F.col("word").substr(size - k + 1, k))
        held = F.array_distinct(F.array(*map(half, lengths)))
        return F.concat(
            F.transform(held, lambda k: F.struct(
                F.lit(side).alias("side"), cut(k).alias("half"), F.lit(False).alias("asked"))),
            F.array(F.struct(F.lit(side).alias("side"), cut(half(size)).alias("half"),
                             F.lit(True).alias("asked"))))

    rows = words.select("word", "n", F.explode(F.concat(entries(0), entries(1))).alias("e")) \
        .select("word", "n", "e.side", "e.half", "e.asked")
    rows = materialize(rows, "word-halves")
    held = rows.where(~F.col("asked")).groupBy("side", "half").agg(F.count(F.lit(1)).alias("c"))
    blocks = 1 + (held.agg(F.sum("c")).first()[0] or 0) // plan.block_words
    crowded = held.where(F.col("c") > plan.block_words).select(
        F.col("side").alias("c_side"), F.col("half").alias("c_half"),
        F.ceil(F.col("c") / plan.block_words).cast("int").alias("shares"))
    shares = F.coalesce("shares", F.lit(1))
    share = F.when(F.col("asked"), F.sequence(F.lit(0), shares - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("word"), shares).cast("int")))
    dealt = (rows.join(crowded, (F.col("side") == F.col("c_side"))
                       & (F.col("half") == F.col("c_half")), "left")
             .withColumn("share", F.explode(share))
             .select("side", "word", "n", "asked",
                     F.when(~F.col("asked"), F.length("half")).alias("held"),
                     F.pmod(F.xxhash64("half", "share"), F.lit(blocks)).alias("block")))
    found = dealt.groupBy("side", "block").applyInPandas(
        lambda block: _search(block, plan),
        "word string, n bigint, n_near bigint, best string, best_n bigint")
    best = F.min(F.when(F.col("best").isNotNull(), F.struct(
        (-F.col("best_n")).alias("minus"), F.col("best").alias("best")))).alias("b")
    return found.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best) \
        .select("word", "n", "n_near", F.col("b.best").alias("best"),
                (-F.col("b.minus")).alias("best_n"))


def roots(links: DataFrame) -> DataFrame:
    """``word, root``: the last word of each word's chain of forms.

    Every round a word takes over the end that its present end has reached, so chains of any
    length end after as many rounds as their length has binary digits. Counts grow along a chain,
    so there are no rings.
    """
    state = materialize(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ends = state.select(F.col("word").alias("at"), F.col("root").alias("further"))
        moved = materialize(state.join(ends, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("further", "root").alias("root"),
            F.col("further").isNotNull().alias("moved")), "roots")
        state = moved.select("word", "root")
        if not moved.where("moved").limit(1).count():
            return state


def spelling_forms(docs: DataFrame, plan: SpellingPlan = SpellingPlan(), id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the whole table.

    Words (see ``word_counts``) have at least ``least_letters`` letters and ``least_count``
    occurrences. A word's form is its most frequent near word (of equally frequent ones the first
    in code-point order) if that occurs at least ``form_ratio`` times as often; its root is the end
    of the chain of forms, the word itself without one.

    NULL and empty texts have no words; a NULL id hashes as an empty one; repeated rows count again;
    an empty table gives no rows; other columns are ignored. Texts are read whole, however long.
    """
    words = materialize(word_counts(docs, plan, id_col, text_col)
                        .where(F.col("n") >= plan.least_count), "vocabulary")
    near = near_words(words, plan)
    known = F.col("best_n") >= plan.form_ratio * F.col("n")
    formed = materialize(near.select(
        "word", "n", "n_near", F.when(known, F.col("best")).alias("form"),
        F.when(known, F.col("best_n")).alias("form_n")), "word-forms")
    ends = roots(formed.where(F.col("form").isNotNull())).withColumnRenamed("word", "at")
    return formed.join(ends, F.col("word") == F.col("at"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
