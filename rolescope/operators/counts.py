"""Group counts and shares: the building block of most reports.

One aggregate serves the groups, both denominators and the number of groups. The totals are read
back from the *same* aggregate through a scalar subquery, so Spark reuses its shuffle: one scan of
the source, no join, and the value put back into the plan is a single row by construction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolescope.functions.columns import n_rows, n_where, none_null, pct, ref


def group_counts(df: DataFrame, keys: list[str], weight: str | None = None) -> DataFrame:
    """``keys, cnt, keyed``: rows per group and how many of them have no NULL key.

    ``weight`` names a count column when ``df`` is already a partial aggregate. Dropping the NULL
    group through ``keyed > 0`` instead of a key filter keeps it after the aggregate, so the total
    over all rows still comes from the same shuffle.
    """
    filled = none_null([ref(k) for k in keys])
    if weight is None:
        measures = [n_rows().alias("cnt"), n_where(filled).alias("keyed")]
    else:
        w = F.col(weight)
        measures = [F.sum(w).alias("cnt"), F.sum(F.when(filled, w).otherwise(0)).alias("keyed")]
    return df.groupBy(*[ref(k) for k in keys]).agg(*measures)


def totals(counts: DataFrame) -> Column:
    """Struct ``(all[, non_null], groups)`` over a :func:`group_counts` result, as a subquery.

    For the shuffle to be shared, the query around it has to use the same columns of ``counts``;
    drop ``keyed`` from ``counts`` first when it plays no part.
    """
    sums = [F.sum("cnt").alias("all"), n_rows().alias("groups")]
    if "keyed" in counts.columns:
        sums.append(F.sum("keyed").alias("non_null"))
    return counts.agg(F.struct(*sums).alias("totals")).scalar()


def shares(counts: DataFrame, *, denominator: str = "all", keep_null: bool = True,
           digits: int = 2) -> DataFrame:
    """Add ``pct`` to group counts.

    ``denominator`` says what shares divide by: ``all`` rows, or only the ``non_null`` ones whose
    key is known (the NULL group then has no share).
    """
    if denominator not in ("all", "non_null"):
        raise ValueError(f"denominator must be 'all' or 'non_null', not {denominator!r}")
    keys = [c for c in counts.columns if c not in ("cnt", "keyed")]
    if denominator == "all" and keep_null:
        counts = counts.drop("keyed")
    share = pct(F.col("cnt"), totals(counts).getField(denominator), digits)
    if denominator == "non_null":
        share = F.when(F.col("keyed") > 0, share)
    rows = counts if keep_null else counts.where(F.col("keyed") > 0)
    return rows.select(*[ref(k) for k in keys], "cnt", share.alias("pct"))


def distribution(df: DataFrame, column: str, *, digits: int = 2, keep_null: bool = True,
                 weight: str | None = None) -> DataFrame:
    """Count and share of every value of a column, NULL last."""
    counts = group_counts(df, [column], weight)
    return shares(counts, digits=digits, keep_null=keep_null).orderBy(ref(column).asc_nulls_last())


def complete_domain(agg: DataFrame, key: str, domain: tuple, fill: dict) -> DataFrame:
    """One row per value of a fixed domain; values the aggregate lacks get ``fill``.

    The domain is a literal list and the other side an aggregate keyed by it, so neither side of
    the join can outgrow the list.
    """
    field = agg.schema[key]
    listed = agg.sparkSession.createDataFrame(
        [(i, v) for i, v in enumerate(domain)],
        f"ord int, `{key}` {field.dataType.simpleString()}")
    joined = listed.join(agg, key, "left")
    return joined.select("ord", *[
        F.coalesce(ref(c), F.lit(fill[c])).alias(c) if c in fill else ref(c) for c in agg.columns])
