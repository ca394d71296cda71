"""Quality gates as data: expectations are evaluated together and returned as rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rolescope.functions.columns import n_rows, n_where, ref, rows_from


@dataclass(frozen=True)
class Check:
    """``actual`` is an aggregate of the table (or a constant) that must equal ``expected``."""

    name: str
    expected: Column
    actual: Column


def expect_rows(n: int) -> Check:
    return Check("row_count", F.lit(n), n_rows())


def expect_rows_like(other: DataFrame) -> Check:
    """As many rows as another table has."""
    return Check("row_count", other.agg(n_rows()).scalar(), n_rows())


def expect_columns(df: DataFrame, n: int) -> Check:
    return Check("column_count", F.lit(n), F.lit(len(df.columns)))


def expect_type(df: DataFrame, column: str, kind: str) -> Check:
    return Check(f"type:{column}", F.lit(kind), F.lit(df.schema[column].dataType.simpleString()))


def expect_unique(df: DataFrame, keys: tuple[str, ...]) -> Check:
    """No repeated key. The distinct count is its own one-row subquery."""
    distinct = df.select(*map(ref, keys)).distinct().agg(n_rows()).scalar()
    return Check(f"unique:{','.join(keys)}", distinct, n_rows())


def expect_no_nulls(column: str) -> Check:
    return Check(f"no_nulls:{column}", F.lit(0), n_where(ref(column).isNull()))


def expect_some_values(column: str) -> Check:
    return Check(f"some_values:{column}", F.lit(True), F.count(ref(column)) > 0)


def expect_both_flags(column: str) -> Check:
    """A boolean column shows true as well as false, i.e. it was parsed and not defaulted."""
    both = F.coalesce(F.bool_or(ref(column)) & ~F.bool_and(ref(column)), F.lit(False))
    return Check(f"both_flags:{column}", F.lit(True), both)


def expect_classes_cover(label: str, classes: tuple[int, ...]) -> Check:
    """Rows of the listed classes add up to all rows."""
    return Check(f"classes_cover:{label}", n_rows(), n_where(ref(label).isin(*classes)))


def quality_report(df: DataFrame, checks: list[Check]) -> DataFrame:
    """``check, expected, actual, passed``: every check in one aggregate of the table."""
    sides = [side for i, c in enumerate(checks) for side in (
        _text(c.expected).alias(f"e{i}"), _text(c.actual).alias(f"a{i}"))]
    return df.agg(*sides).select(rows_from([
        F.struct(F.lit(c.name).alias("check"), F.col(f"e{i}").alias("expected"),
                 F.col(f"a{i}").alias("actual"),
                 F.col(f"e{i}").eqNullSafe(F.col(f"a{i}")).alias("passed"))
        for i, c in enumerate(checks)]))


def _text(column: Column) -> Column:
    return column.cast("string")


def require(report: DataFrame) -> None:
    """Run a report (one row per check) and raise when any check failed."""
    failed = report.where(~F.col("passed")).collect()
    if failed:
        raise AssertionError("; ".join(
            f"{r['check']}: expected {r['expected']}, got {r['actual']}" for r in failed))


def parse_audit(raw: DataFrame, schema: StructType, timestamp_formats: tuple[str, ...],
                ) -> DataFrame:
    """``column, raw_values, parsed, lost``: text that is present but does not become its type.

    ``raw`` holds the same columns as ``schema``, all read as text. A permissive typed read turns
    such values into NULL without a trace; here they are counted, all columns in one scan. Each
    text goes through the CSV reader's own parser, so what counts as lost is what the reader
    loses, padded numbers and words such as "yes" included. A timestamp counts as parsed when any
    of the formats reads it.
    """
    present = {f.name: F.trim(ref(f.name)) != "" for f in schema}
    typed = {f.name: _parse(ref(f.name), f.dataType.simpleString(), timestamp_formats)
             for f in schema}
    one = raw.agg(*[n_where(present[f.name]).alias(f"r{i}") for i, f in enumerate(schema)],
                  *[n_where(present[f.name] & typed[f.name].isNotNull()).alias(f"p{i}")
                    for i, f in enumerate(schema)])
    return one.select(rows_from([
        F.struct(F.lit(f.name).alias("column"), F.col(f"r{i}").alias("raw_values"),
                 F.col(f"p{i}").alias("parsed"), (F.col(f"r{i}") - F.col(f"p{i}")).alias("lost"))
        for i, f in enumerate(schema)]))


def _parse(text: Column, kind: str, timestamp_formats: tuple[str, ...]) -> Column:
    """The text as the CSV reader would type it, NULL where the reader gives NULL."""
    if kind == "string":
        return text
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    field = F.concat(F.lit('"'), escaped, F.lit('"'))
    formats = timestamp_formats if kind.startswith("timestamp") else timestamp_formats[:1]
    return F.coalesce(*[F.from_csv(field, f"v {kind}", {
        "mode": "PERMISSIVE", "timestampFormat": f, "timestampNTZFormat": f})["v"]
        for f in formats])
