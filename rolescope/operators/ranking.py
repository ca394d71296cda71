"""Top-k groups, ranks and running shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rolescope.functions.columns import n_rows, pct, ref
from rolescope.operators.counts import group_counts, shares, totals


def _ranking(keys: list[str]) -> list:
    """Most frequent first; the keys break ties, so the cut is the same on every run."""
    return [F.desc("cnt"), *[ref(k).asc_nulls_last() for k in keys]]


def top_groups(df: DataFrame, keys: list[str], k: int, *, keep_null: bool = True,
               weight: str | None = None) -> DataFrame:
    """The ``k`` most frequent key combinations with their share of all rows."""
    return (shares(group_counts(df, keys, weight), keep_null=keep_null)
            .orderBy(*_ranking(keys)).limit(k))


def top_keys(df: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` most frequent non-null values of a column (at most ``k`` rows)."""
    counts = df.where(ref(key).isNotNull()).groupBy(ref(key)).agg(n_rows().alias("cnt"))
    return counts.orderBy(*_ranking([key])).limit(k).select(ref(key))


def rows_in_top(df: DataFrame, key: str, k: int) -> DataFrame:
    """The rows whose key is among the ``k`` most frequent, kept whole.

    The broadcast side holds at most ``k`` rows because of its own limit.
    """
    return df.join(F.broadcast(top_keys(df, key, k)), key, "left_semi")


def coverage(df: DataFrame, key: str, k: int = 10, weight: str | None = None) -> DataFrame:
    """``rank, key, cnt, pct, n_groups``: the ranked top-k and how many groups there are."""
    counts = group_counts(df, [key], weight).drop("keyed")
    total = totals(counts)
    top = (counts.select(ref(key), "cnt",
                         pct(F.col("cnt"), total.getField("all")).alias("pct"),
                         total.getField("groups").alias("n_groups"))
           .orderBy(*_ranking([key])).limit(k))
    rank = F.row_number().over(Window.orderBy(*_ranking([key])))  # over k rows
    return top.select(rank.cast("bigint").alias("rank"), ref(key), "cnt", "pct", "n_groups")


def cumulative_share(df: DataFrame, key: str, k: int) -> DataFrame:
    """``rank, key, cnt, cum_pct``: share of all rows covered by the first 1..k groups."""
    counts = group_counts(df, [key]).drop("keyed")
    total = totals(counts).getField("all")
    order = Window.orderBy(*_ranking([key]))  # over k rows
    top = counts.select(ref(key), "cnt", total.alias("total")).orderBy(*_ranking([key])).limit(k)
    running = F.sum("cnt").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return top.select(F.row_number().over(order).cast("bigint").alias("rank"), ref(key), "cnt",
                      pct(running, F.col("total")).alias("cum_pct"))


def top_values(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The ``k`` highest distinct values of a column and how often each occurs.

    A first scan takes the highest value of each of ``4 k`` hash buckets. Equal values share a
    bucket, so the ``k``-th highest of these maxima is reached by ``k`` distinct values and bounds
    the result from below; a second scan groups only the rows that reach it. Without ``k`` maxima
    there is no bound and every row is grouped.
    """
    values = df.where(ref(column).isNotNull())
    maxima = (values.groupBy(F.pmod(F.xxhash64(ref(column)), F.lit(4 * k)).alias("bucket"))
              .agg(F.max(ref(column)).alias("top")).select("top").distinct()
              .orderBy(F.desc("top")).limit(k))
    bound = maxima.agg(F.when(n_rows() == k, F.min("top"))).scalar()
    return (values.where(F.coalesce(ref(column) >= bound, F.lit(True)))
            .groupBy(ref(column)).agg(n_rows().alias("cnt"))
            .orderBy(ref(column).desc()).limit(k))
