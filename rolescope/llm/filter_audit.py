"""What each document filter removes alone and in every order, by a Gray-code walk over subsets."""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolescope.llm.base import materialize

WORD_GAP = r"[\x20\x09-\x0D]+"

# The limits of the production filters.
LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITALS_PERCENT = 3
MARKS = r"[#$%&*|]"

# A filter is true for a text that fails it. What is equal to an earlier text is a filter by itself.
Filter = Callable[[Column], Column]
REPEATED = "E"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, WORD_GAP), lambda w: w != "")


def _few_distinct(text: Column) -> Column:
    """Words are split once: the struct holds both sizes."""
    sizes = F.transform(F.array(_words(text)), lambda w: F.size(F.array_distinct(w)) * 100
                        < F.size(w) * LEAST_DISTINCT_PERCENT)
    return sizes[0]


FILTERS: dict[str, Filter] = {
    "A": lambda t: F.regexp_count(t, F.lit(r"[^\x20\x09-\x0D]+")) < LEAST_WORDS,
    "B": _few_distinct,
    "C": lambda t: F.regexp_count(t, F.lit("[A-Z]")) * 100 > F.length(t) * MOST_CAPITALS_PERCENT,
    "D": lambda t: t.rlike(MARKS),
}


def walk(cells: np.ndarray, filters: int) -> np.ndarray:
    """What survives every subset of the filters, from the counts of each failure mask.

    ``cells[m]`` are counts of the documents that fail exactly the filters in bits ``m``. Subsets
    are met in Gray-code order: one filter is toggled at a time, each cell keeps the number of its
    failures that are active, and the running survivors change by the cells whose number becomes
    or stops being zero. Row ``s`` of the result is what is left when the filters in ``s`` ran.
    """
    masks = np.arange(1 << filters)
    active = np.zeros(len(masks), dtype=np.int64)
    left = cells.sum(axis=0)
    states = np.zeros_like(cells)
    states[0] = left
    subset = 0
    for step in range(1, len(masks)):
        toggled = (step & -step).bit_length() - 1
        subset ^= 1 << toggled
        touched = (masks >> toggled) & 1 == 1
        if subset >> toggled & 1:
            left = left - cells[touched & (active == 0)].sum(axis=0)
            active[touched] += 1
        else:
            active[touched] -= 1
            left = left + cells[touched & (active == 0)].sum(axis=0)
        states[subset] = left
    return states


def _rows(cells: np.ndarray, names: str) -> list[tuple]:
    """A row for each order and step, by differences of the states."""
    n = len(names)
    states = walk(cells, n)
    fails = [int(cells[[m for m in range(1 << n) if m >> f & 1], 0].sum()) for f in range(n)]
    rows, total = [], [0] * n
    for order in permutations(range(n)):
        before = 0
        for step, f in enumerate(order, 1):
            after = before | 1 << f
            gone = states[before] - states[after]
            total[f] += int(gone[0])
            rows.append(("".join(names[i] for i in order), step, f, int(states[after, 0]),
                         int(gone[0]), fails[f] - int(gone[0]), int(cells[1 << f, 0]),
                         int(gone[1]), int(gone[2])))
            before = after
    return [(order, step, *rest, total[f]) for order, step, f, *rest in rows]


def filter_audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Filter] | None = None, *,
                 part_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
                 ) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley``: every order of the filters, step by step, within each part.

    A document is reduced to a mask of the filters that it fails; the last filter, ``E``, fails
    rows whose text is that of any smaller id in the whole table. A part's at most 32 masks are
    counted with their good and toxic documents; all orders follow from the 32 states that
    ``walk`` stores. ``removed`` counts what a step takes, ``redundant`` what fails its filter but
    went earlier, ``unique_fails`` what fails its filter alone, ``shapley`` what its filter
    removes summed over all orders.

    Texts are read once; narrow rows (id, part, mask, 128-bit digest of the text) are written,
    and the smallest id of each text comes back by a join on (digest, id), which spreads a group
    of copies however large. Only counts of masks meet by part.

    NULL text and part are empty strings. A row without id repeats nothing, nothing repeats it,
    and it has no label. Rows that share the smallest id of a text all pass ``E``. An id with
    several labels is good or toxic if any says so. An empty table gives no rows; other columns
    are ignored.
    """
    filters = FILTERS if filters is None else filters
    names = "".join(filters) + REPEATED
    text = F.coalesce(F.col(text_col), F.lit(""))
    bits = [F.when(f(F.col("text")), 1 << i).otherwise(0) for i, f in enumerate(filters.values())]
    rows = docs.select(F.col(id_col).alias("id"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       text.alias("text"))
    rows = materialize(rows.select("id", "part", F.unhex(F.md5("text")).alias("digest"),
                                   sum(bits[1:], bits[0]).alias("mask")), "filter-masks")
    known = rows.where(F.col("id").isNotNull())
    first = known.groupBy("digest").agg(F.min("id").alias("first")).select(
        F.col("first"), F.col("digest").alias("of"))
    marks = (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("l_id"))
             .agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
                  F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")))
    repeated = F.when(F.col("first").isNull(), 1 << len(filters)).otherwise(0)
    judged = (known.join(marks, F.col("id") == F.col("l_id"), "left")
              .join(first, (F.col("id") == F.col("first")) & (F.col("digest") == F.col("of")),
                    "left")
              .select("part", (F.col("mask") + repeated).alias("mask"),
                      F.coalesce("good", F.lit(0)).alias("good"),
                      F.coalesce("toxic", F.lit(0)).alias("toxic")))
    nameless = rows.where(F.col("id").isNull()).select(
        "part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    cells = judged.unionByName(nameless).groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))

    def audit(group: pd.DataFrame) -> pd.DataFrame:  # at most a row a mask
        table = np.zeros((1 << len(names), 3), dtype=np.int64)
        table[group["mask"].to_numpy()] = group[["n", "good", "toxic"]].to_numpy()
        out = pd.DataFrame(_rows(table, names), columns=[
            "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
            "toxic_lost", "shapley"])
        out.insert(0, "part", group["part"].iloc[0])
        return out

    return cells.groupBy("part").applyInPandas(
        audit, "part string, filter_order string, step int, kept bigint, removed bigint, "
               "redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, "
               "shapley bigint")
