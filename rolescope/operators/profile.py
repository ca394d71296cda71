"""Whole-table profile: size, keys, missing values, ranges, constants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolescope.functions.columns import is_blank, n_rows, n_where, pct, ref, rows_from
from rolescope.roles import Roles

TIME_TEXT = "yyyy-MM-dd HH:mm:ss"


def row_count(df: DataFrame) -> DataFrame:
    """``n``: over plain Parquet this reads file footers only."""
    return df.agg(n_rows().alias("n"))


def overview(df: DataFrame, roles: Roles, *, approx: bool = False) -> DataFrame:
    """One wide row: rows, columns, time range, distinct ids and places.

    The table is first reduced to one row per place (state, county, city), so the distinct counts
    of places run over that small result instead of copying every input row once per column. The
    ids, which cannot be reduced, are counted in a subquery that reads only them; ``approx``
    sketches them in the main pass instead.
    """
    (start,) = roles.need("start_time")
    places = {n: c for n, c in (("n_state", roles.state), ("n_county", roles.county),
                                ("n_city", roles.city)) if c}
    measures = [n_rows().alias("c"), F.min(ref(start)).alias("lo"), F.max(ref(start)).alias("hi")]
    ids = F.struct(*map(ref, roles.id))
    if approx:
        per_place = df.agg(F.approx_count_distinct(ids).alias("distinct_ids"), *measures,
                           *[F.approx_count_distinct(ref(c)).alias(n) for n, c in places.items()])
        counted = [F.first(n).alias(n) for n in ("distinct_ids", *places)]
    else:
        per_place = df.groupBy(*map(ref, places.values())).agg(*measures)
        counted = [F.count_distinct(ref(c)).alias(n) for n, c in places.items()]
    one = per_place.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("total_rows"),
                        F.date_format(F.min("lo"), TIME_TEXT).alias("min_time"),
                        F.date_format(F.max("hi"), TIME_TEXT).alias("max_time"), *counted)
    found = F.col("distinct_ids") if approx else distinct_count(df, list(roles.id)).scalar()
    return one.select("total_rows", F.lit(len(df.columns)).cast("bigint").alias("total_columns"),
                      found.alias("distinct_ids"), "min_time", "max_time", *places)


def overview_long(wide: DataFrame) -> DataFrame:
    """The overview as ``metric, value`` text rows."""
    return wide.select(rows_from([
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("value"))
        for c in wide.columns]))


def distinct_count(df: DataFrame, columns: list[str]) -> DataFrame:
    """``n``: distinct combinations, ignoring those with a NULL part."""
    return df.agg(F.count_distinct(*map(ref, columns)).alias("n"))


def duplicate_keys(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``total_rows, distinct_keys, duplicate_rows, repeated_keys, most_copies``.

    Copies are counted map-side first, so a key that holds much of the table is one small row per
    task by the time it is shuffled.
    """
    copies = df.groupBy(*map(ref, keys)).agg(n_rows().alias("c"))
    return copies.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("total_rows"),
                      n_rows().alias("distinct_keys"),
                      F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("duplicate_rows"),
                      n_where(F.col("c") > 1).alias("repeated_keys"),
                      F.max("c").alias("most_copies"))


def repeated_keys(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The keys that occur more than once and how often."""
    copies = df.groupBy(*map(ref, keys)).agg(n_rows().alias("cnt"))
    return copies.where(F.col("cnt") > 1)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values with their counts, NULL last."""
    return (df.groupBy(ref(column)).agg(n_rows().alias("n"))
            .orderBy(ref(column).asc_nulls_last()))


def distinct_summary(df: DataFrame, column: str) -> DataFrame:
    """``n_values, min_value, max_value`` of the non-null values."""
    return df.agg(F.count_distinct(ref(column)).alias("n_values"),
                  F.min(ref(column)).alias("min_value"), F.max(ref(column)).alias("max_value"))


def schema_report(df: DataFrame) -> DataFrame:
    """``position, column, type, non_null, min_value, max_value``: the schema and what it holds.

    One aggregate over all columns; ranges are shown as text.
    """
    one = df.agg(*column_contents(df.columns))
    return one.select(rows_from([
        F.struct(F.lit(i + 1).alias("position"), F.lit(name).alias("column"),
                 F.lit(kind).alias("type"), *content_fields(i))
        for i, (name, kind) in enumerate(df.dtypes)]))


def column_contents(columns: list[str]) -> list[Column]:
    """Aggregates: present values, smallest and largest, of each column by position."""
    return [a for i, c in enumerate(columns) for a in (
        F.count(ref(c)).alias(f"n{i}"), F.min(ref(c)).cast("string").alias(f"lo{i}"),
        F.max(ref(c)).cast("string").alias(f"hi{i}"))]


def content_fields(i: int) -> list[Column]:
    return [F.col(f"n{i}").alias("non_null"), F.col(f"lo{i}").alias("min_value"),
            F.col(f"hi{i}").alias("max_value")]


def _per_column(df: DataFrame, tests: dict[str, Column], count: str) -> DataFrame:
    one = df.agg(n_rows().alias("total"),
                 *[n_where(t).alias(f"n{i}") for i, t in enumerate(tests.values())])
    return one.select(rows_from([
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias(count),
                 pct(F.col(f"n{i}"), F.col("total"), 4).alias("pct"))
        for i, c in enumerate(tests)])).orderBy(F.desc(count), "column")


def null_profile(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``column, nulls, pct`` for all columns in one scan, most missing first."""
    return _per_column(df, {c: ref(c).isNull() for c in columns}, "nulls")


def null_profile_summary(profile: DataFrame) -> DataFrame:
    """How many profiled columns are complete and how many are not."""
    return profile.agg(n_where(F.col("nulls") == 0).alias("zero_null_cols"),
                       n_where(F.col("nulls") > 0).alias("some_null_cols"))


def blank_profile(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``column, blanks, pct``: text that is present but empty."""
    return _per_column(df, {c: is_blank(ref(c)) for c in columns}, "blanks")


def null_filter_counts(df: DataFrame, column: str) -> DataFrame:
    """``null_cnt, non_null_cnt`` of one column."""
    return df.agg(n_where(ref(column).isNull()).alias("null_cnt"),
                  F.count(ref(column)).alias("non_null_cnt"))


def time_range(df: DataFrame, roles: Roles) -> DataFrame:
    """Earliest and latest start and end."""
    start, end = roles.need("start_time", "end_time")
    return df.agg(*[F.date_format(f(ref(c)), TIME_TEXT).alias(f"{n}_{side}")
                    for side, c in (("start", start), ("end", end))
                    for n, f in (("min", F.min), ("max", F.max))])


def order_violations(df: DataFrame, roles: Roles) -> DataFrame:
    """``total, end_before_start, pct``; a row with a missing side is not a violation."""
    start, end = roles.need("start_time", "end_time")
    bad = n_where(ref(end) < ref(start))
    return df.agg(n_rows().alias("total"), bad.alias("end_before_start")) \
             .withColumn("pct", pct(F.col("end_before_start"), F.col("total"), 4))


def constant_columns(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``column, non_null, is_constant``: at most one distinct non-null value.

    Comparing the smallest with the largest value decides that in one scan, where a distinct
    count per column would shuffle every column.
    """
    one = df.agg(*[a for i, c in enumerate(columns) for a in (
        F.count(ref(c)).alias(f"n{i}"),
        F.coalesce(F.min(ref(c)) == F.max(ref(c)), F.lit(True)).alias(f"k{i}"))])
    return one.select(rows_from([
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("non_null"),
                 F.col(f"k{i}").alias("is_constant")) for i, c in enumerate(columns)]))


def preview(df: DataFrame, columns: tuple[str, ...], order: tuple[str, ...],
            n: int = 5) -> DataFrame:
    """The first ``n`` rows by a key; the order makes the sample repeatable."""
    return df.select(*map(ref, columns)).orderBy(*map(ref, order)).limit(n)


def content_fingerprint(df: DataFrame) -> DataFrame:
    """``n, hash_sum``: equal for equal row multisets however they are partitioned.

    Hashes are summed rather than xor-ed so that pairs of duplicates do not cancel out.
    """
    return df.agg(n_rows().alias("n"), F.coalesce(
        F.sum(F.xxhash64(*map(ref, df.columns)).cast("decimal(38,0)")),
        F.lit(0).cast("decimal(38,0)")).alias("hash_sum"))


def table_fingerprint(df: DataFrame, key: str, columns: tuple[str, ...]) -> DataFrame:
    """``n, key_sum`` and the range of each listed column, in one row."""
    return df.agg(n_rows().alias("n"), F.sum(ref(key)).alias("key_sum"),
                  *[f(ref(c)).cast("double").alias(f"{p}_{c}") for c in columns
                    for p, f in (("min", F.min), ("max", F.max))])
