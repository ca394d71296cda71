"""Group-by-class tables.

A class list is always given, so a crosstab is one hash aggregate with a counter per class: a
single shuffle, no discovery job, no pivot stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rolescope.functions.columns import n_rows, n_where, pct, ref, rows_from


def class_columns(classes: tuple[int, ...], prefix: str = "class_") -> list[str]:
    return [f"{prefix}{c}" for c in classes]


def _counters(label: str, classes: tuple[int, ...], weight: str | None) -> list[Column]:
    names = class_columns(classes)
    if weight is None:
        return [n_where(ref(label) == c).alias(n) for c, n in zip(classes, names)]
    return [F.sum(F.when(ref(label) == c, F.col(weight)).otherwise(0)).alias(n)
            for c, n in zip(classes, names)]


def _total(label: str, classes: tuple[int, ...], weight: str | None) -> list[Column]:
    """Rows outside the class list (NULL or another value), and all rows."""
    listed = F.coalesce(ref(label).isin(*classes), F.lit(False))
    if weight is None:
        return [n_where(~listed).alias("class_other"), n_rows().alias("total")]
    return [F.sum(F.when(listed, 0).otherwise(F.col(weight))).alias("class_other"),
            F.sum(F.col(weight)).alias("total")]


def crosstab_long(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """``keys, label, cnt`` for combinations that occur."""
    cols = [ref(k) for k in (*keys, label)]
    return df.groupBy(*cols).agg(n_rows().alias("cnt")).orderBy(*cols)


def crosstab(df: DataFrame, key: str, label: str, classes: tuple[int, ...], *,
             top: int | None = None, weight: str | None = None,
             with_total: bool = True) -> DataFrame:
    """``key, class_1.., class_other, total``: zero-filled, largest total first, or the first rows.

    ``total`` counts every row of the key; those without a listed class are ``class_other``.
    """
    counters = _counters(label, classes, weight)
    if not with_total:
        return df.groupBy(ref(key)).agg(*counters).orderBy(ref(key).asc_nulls_last())
    ranked = (df.groupBy(ref(key)).agg(*counters, *_total(label, classes, weight))
              .orderBy(F.desc("total"), ref(key).asc_nulls_last()))
    return ranked.limit(top) if top else ranked


def top_crosstab(df: DataFrame, key: str, label: str, classes: tuple[int, ...],
                 k: int) -> DataFrame:
    """Crosstab of the ``k`` most frequent non-null keys.

    Ranking and class counts come from the same aggregate, so the rows are read once and no
    membership test against an earlier result is needed.
    """
    wide = (df.where(ref(key).isNotNull()).groupBy(ref(key))
            .agg(*_counters(label, classes, None), *_total(label, classes, None)))
    return wide.orderBy(F.desc("total"), ref(key)).limit(k)


def row_percent(table: DataFrame, key: str, classes: tuple[int, ...], *,
                digits: int = 2) -> DataFrame:
    """``key, pct_1.., pct_other``: each crosstab row as percentages of its own total."""
    named = [*zip(classes, class_columns(classes)), ("other", "class_other")]
    return table.select(ref(key), *[
        pct(F.col(n), F.col("total"), digits).alias(f"pct_{c}") for c, n in named])


def class_within_flags(df: DataFrame, flags: tuple[str, ...], label: str) -> DataFrame:
    """``flag, class, cnt, flag_total, pct``: classes of the rows on which each flag is true.

    All flags are counted in one pass grouped by class; the long form is made from those few
    rows, so no input row is multiplied by the number of flags.
    """
    per_class = df.groupBy(ref(label).alias("class")).agg(
        *[n_where(ref(f)).alias(f"f{i}") for i, f in enumerate(flags)])
    long = per_class.select("class", rows_from([
        F.struct(F.lit(f).alias("flag"), F.col(f"f{i}").alias("cnt"))
        for i, f in enumerate(flags)])).where(F.col("cnt") > 0)
    total = F.sum("cnt").over(Window.partitionBy("flag"))
    return (long.withColumn("flag_total", total)
            .select("flag", "class", "cnt", "flag_total",
                    pct(F.col("cnt"), F.col("flag_total")).alias("pct"))
            .orderBy("flag", F.col("class").asc_nulls_last()))
