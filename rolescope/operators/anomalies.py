"""Threshold ladders, paired missing values and the context of extreme values."""

from __future__ import annotations

import operator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rolescope.functions.columns import any_of, n_rows, n_where, pct, ref, rows_from

_COMPARE = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le,
            "=": operator.eq}


@dataclass(frozen=True)
class Rule:
    """A comparison of one column with a constant, e.g. ``Rule("wind", ">", 200)``."""

    column: str
    op: str
    value: float

    def __str__(self) -> str:
        return f"{self.column} {self.short}"

    @property
    def short(self) -> str:
        return f"{self.op} {self.value:g}"

    def test(self) -> Column:
        return _COMPARE[self.op](ref(self.column), F.lit(float(self.value)))


def threshold_ladder(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """``column, rule, value``: NULLs, rows past each threshold, and the extremes of each column.

    All columns and thresholds are counters of one aggregate, so the table is read once.
    """
    measures: dict[tuple[str, str], Column] = {}
    for c in dict.fromkeys(r.column for r in rules):
        measures[c, "null"] = n_where(ref(c).isNull())
        measures |= {(c, r.short): n_where(r.test()) for r in rules if r.column == c}
        measures[c, "min"], measures[c, "max"] = F.min(ref(c)), F.max(ref(c))
    one = df.agg(*[m.cast("double").alias(f"m{i}") for i, m in enumerate(measures.values())])
    return one.select(rows_from([
        F.struct(F.lit(c).alias("column"), F.lit(rule).alias("rule"), F.col(f"m{i}").alias("value"))
        for i, (c, rule) in enumerate(measures)]))


def paired_missingness(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """``pair, state, cnt, pct``: both NULL, only one NULL, or both present, per named pair."""
    states = {}
    for name, (a, b) in pairs.items():
        no_a, no_b = ref(a).isNull(), ref(b).isNull()
        states[name, "both_null"] = no_a & no_b
        states[name, "only_first_null"] = no_a & ~no_b
        states[name, "only_second_null"] = ~no_a & no_b
        states[name, "both_present"] = ~no_a & ~no_b
    one = df.agg(n_rows().alias("total"),
                 *[n_where(t).alias(f"n{i}") for i, t in enumerate(states.values())])
    return one.select(rows_from([
        F.struct(F.lit(pair).alias("pair"), F.lit(state).alias("state"),
                 F.col(f"n{i}").alias("cnt"), pct(F.col(f"n{i}"), F.col("total"), 6).alias("pct"))
        for i, (pair, state) in enumerate(states)]))


def extreme_rows(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows past at least one threshold; the disjunction is pushed to the scan."""
    return df.where(any_of([r.test() for r in rules]))


def extreme_counts(df: DataFrame, rules: list[Rule], *, prefilter: bool = True) -> DataFrame:
    """``rule, cnt``: rows past each threshold.

    ``prefilter`` lets the scan skip what no rule matches; without it the counters can share a
    pass over the whole table with other reports.
    """
    one = (extreme_rows(df, rules) if prefilter else df).agg(*[n_where(r.test()).alias(f"n{i}")
                                        for i, r in enumerate(rules)])
    return one.select(rows_from([F.struct(F.lit(str(r)).alias("rule"), F.col(f"n{i}").alias("cnt"))
                                 for i, r in enumerate(rules)]))


def extreme_context(df: DataFrame, rules: list[Rule], dims: tuple[str, ...],
                    n: int = 5) -> DataFrame:
    """``rule, dim, value, cnt, rank``: the ``n`` most frequent values inside each extreme subset.

    Only rows that break a rule are expanded, once per broken rule and dimension, and they are
    counted map-side before the shuffle. The rank filter becomes a per-task group limit, so the
    window never receives a whole dimension.
    """
    hits = F.array_compact(F.array(*[F.when(r.test(), F.lit(str(r))) for r in rules]))
    views = F.array(*[F.struct(F.lit(d).alias("dim"), ref(d).cast("string").alias("value"))
                      for d in dims])
    long = (extreme_rows(df, rules)
            .select(hits.alias("rules"), views.alias("views"))
            .select(F.explode("rules").alias("rule"), "views")
            .select("rule", F.inline("views")))
    counts = long.groupBy("rule", "dim", "value").agg(n_rows().alias("cnt"))
    order = Window.partitionBy("rule", "dim").orderBy(F.desc("cnt"),
                                                      F.col("value").asc_nulls_last())
    return (counts.withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= n)
            .withColumn("rank", F.col("rank").cast("bigint"))
            .orderBy("rule", "dim", "rank"))
