"""Counts by calendar part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rolescope.functions import timeparts
from rolescope.functions.columns import n_rows, pct, ratio, ref, rows_from
from rolescope.operators.counts import group_counts, shares, totals


def time_parts(df: DataFrame, time: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns plus year, month, dow (1 = Sunday) and hour, in one projection."""
    columns = timeparts.parts(ref(time))
    return df.select(*[ref(k) for k in keep], *[c.alias(n) for n, c in columns.items()])


def time_cube(df: DataFrame, time: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Rows per (year, month, dow, hour[, by...]): one scan from which every calendar report
    is derived. Its size is bounded by the calendar, not by the data.
    """
    parts = time_parts(df, time, by)
    return parts.groupBy(*[ref(b) for b in by], *timeparts.PARTS).agg(n_rows().alias("cnt"))


def by_part(df: DataFrame, part: str, *, time: str | None = None, weight: str | None = None,
            denominator: str = "all", keep_null: bool = False) -> DataFrame:
    """``part[, name], cnt, pct`` for one calendar part.

    Give ``time`` to read raw rows, or ``weight`` to roll up a :func:`time_cube`. NULL times are
    left out unless ``keep_null``; what the shares divide by is a separate, explicit choice.
    """
    source = df if time is None else df.select(timeparts.part(part, ref(time)).alias(part))
    result = shares(group_counts(source, [part], weight), denominator=denominator,
                    keep_null=keep_null)
    if part in timeparts.NAMES:
        result = result.select(part, timeparts.part_name(part, F.col(part)).alias("name"),
                               "cnt", "pct")
    return result.orderBy(F.col(part).asc_nulls_last())


def by_part_both_shares(df: DataFrame, part: str, time: str) -> DataFrame:
    """As :func:`by_part` with both denominators side by side; NULL times are 'unknown'."""
    counts = group_counts(df.select(timeparts.part(part, ref(time)).alias(part)), [part])
    total = totals(counts)
    return counts.orderBy(F.col(part).asc_nulls_last()).select(
        F.coalesce(F.col(part).cast("string"), F.lit("unknown")).alias(part), "cnt",
        pct(F.col("cnt"), total.getField("all")).alias("pct_all"),
        F.when(F.col("keyed") > 0, pct(F.col("cnt"), total.getField("non_null")))
        .alias("pct_non_null"))


def all_parts(cube: DataFrame) -> DataFrame:
    """``level, key, cnt`` for all four parts of a time cube in one aggregate."""
    long = cube.select("cnt", rows_from([
        F.struct(F.lit(p).alias("level"), F.col(p).alias("key")) for p in timeparts.PARTS]))
    return long.groupBy("level", "key").agg(F.sum("cnt").alias("cnt")).orderBy("level", "key")


def weekday_weekend(df: DataFrame, time: str) -> DataFrame:
    """Rows on weekdays and at weekends; rows without a time belong to neither."""
    kinds = df.select(timeparts.day_kind(timeparts.part("dow", ref(time))).alias("day_kind"))
    return shares(group_counts(kinds, ["day_kind"]), keep_null=False).orderBy("day_kind")


def peak(parts: DataFrame, part: str) -> DataFrame:
    """The busiest value of a calendar part; ties go to the earliest."""
    return parts.orderBy(F.desc("cnt"), part).limit(1)


def _growth(cnt: Column, prev: Column) -> Column:
    return F.round(ratio((cnt - prev) * 100, prev), 2)


def year_over_year(df: DataFrame, time: str | None = None, *,
                   weight: str | None = None) -> DataFrame:
    """``year, cnt, prev, growth_pct``; a year whose predecessor is absent has no growth.

    Reads raw rows by ``time`` or rolls up a :func:`time_cube` by ``weight``. The window runs
    over one row per calendar year.
    """
    source = df if time is None else df.select(timeparts.part("year", ref(time)).alias("year"))
    cnt = n_rows() if weight is None else F.sum(weight)
    years = (source.where(F.col("year").isNotNull()).groupBy("year").agg(cnt.alias("cnt")))
    order = Window.orderBy("year")
    prev = F.when(F.lag("year").over(order) == F.col("year") - 1, F.lag("cnt").over(order))
    return (years.withColumn("prev", prev.cast("double"))
            .withColumn("growth_pct", _growth(F.col("cnt"), F.col("prev")))
            .orderBy("year"))
