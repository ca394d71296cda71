"""Numeric and flag summaries: any number of columns in one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolescope.functions.columns import n_rows, n_where, pct, ref, rows_from
from rolescope.operators.quantiles import approx_median, exact_summary


def _measures(column: Column, i: int) -> list[Column]:
    return [F.count(column).alias(f"cnt{i}"), F.avg(column).alias(f"mean{i}"),
            approx_median(column).cast("double").alias(f"median{i}"),
            F.min(column).cast("double").alias(f"min{i}"),
            F.max(column).cast("double").alias(f"max{i}")]


def _exact_measures(digits: int) -> list[Column]:
    return [F.round(F.col(c).cast("double"), digits).alias(name) for c, name in (
        ("mean", "mean"), ("value", "median"), ("min", "min"), ("max", "max"))]


def numeric_summary(df: DataFrame, columns: tuple[str, ...], *, exact: bool = False,
                    digits: int = 2) -> DataFrame:
    """``variable, cnt, missing, missing_pct, mean, median, min, max`` per column.

    The default median is the bounded sketch, computed in the same single scan; ``exact`` selects
    the true median, and takes the other measures on the way, in two scans for all columns.
    """
    if exact:
        missing = F.col("total") - F.col("n")
        return exact_summary(df, {c: ref(c) for c in columns}).select(
            F.col("series").alias("variable"), F.col("n").alias("cnt"), missing.alias("missing"),
            pct(missing, F.col("total")).alias("missing_pct"), *_exact_measures(digits))
    one = df.agg(n_rows().alias("total"),
                 *[m for i, c in enumerate(columns) for m in _measures(ref(c), i)])
    missing = [F.col("total") - F.col(f"cnt{i}") for i in range(len(columns))]
    return one.select(rows_from([
        F.struct(F.lit(c).alias("variable"), F.col(f"cnt{i}").alias("cnt"),
                 missing[i].alias("missing"),
                 pct(missing[i], F.col("total")).alias("missing_pct"),
                 *[F.round(F.col(f"{m}{i}"), digits).alias(m)
                   for m in ("mean", "median", "min", "max")])
        for i, c in enumerate(columns)]))


def summary_by_class(df: DataFrame, column: str, label: str, classes: tuple[int, ...], *,
                     exact: bool = False, digits: int = 4) -> DataFrame:
    """``class, cnt, mean, median, min, max`` of a column within each class.

    Exact medians of all classes come from the same two scans. Classes off the list are rows too,
    so the label must not have unbounded values.
    """
    if exact:
        return exact_summary(df, {column: ref(column)}, ref(label)).select(
            F.col("group").alias("class"), F.col("n").alias("cnt"), *_exact_measures(digits)) \
            .orderBy(F.col("class").asc_nulls_last())
    grouped = df.groupBy(ref(label).alias("class")).agg(*_measures(ref(column), 0))
    return grouped.select(
        "class", F.col("cnt0").alias("cnt"), F.round("mean0", digits).alias("mean"),
        F.round("median0", digits).alias("median"), F.round("min0", digits).alias("min"),
        F.round("max0", digits).alias("max")).orderBy(F.col("class").asc_nulls_last())


def flag_prevalence(df: DataFrame, flags: tuple[str, ...], *, digits: int = 3) -> DataFrame:
    """``flag, true_cnt, false_cnt, true_pct`` for all flags, most common first."""
    one = df.agg(n_rows().alias("total"),
                 *[n_where(ref(f)).alias(f"t{i}") for i, f in enumerate(flags)],
                 *[n_where(~ref(f)).alias(f"f{i}") for i, f in enumerate(flags)])
    return one.select(rows_from([
        F.struct(F.lit(f).alias("flag"), F.col(f"t{i}").alias("true_cnt"),
                 F.col(f"f{i}").alias("false_cnt"),
                 pct(F.col(f"t{i}"), F.col("total"), digits).alias("true_pct"))
        for i, f in enumerate(flags)])).orderBy(F.desc("true_cnt"), "flag")


def numeric_ranges(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``column, min, max`` as doubles."""
    one = df.agg(*[f(ref(c)).cast("double").alias(f"{p}{i}") for i, c in enumerate(columns)
                   for p, f in (("min", F.min), ("max", F.max))])
    return one.select(rows_from([
        F.struct(F.lit(c).alias("column"), F.col(f"min{i}").alias("min"),
                 F.col(f"max{i}").alias("max")) for i, c in enumerate(columns)]))
