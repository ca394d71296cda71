"""Histograms over fixed, ordered, half-open ``(low, high]`` buckets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolescope.functions.columns import n_rows, n_where, pct, ref, rows_from


@dataclass(frozen=True)
class Buckets:
    """Zero has a bucket of its own, then ``(edge, next edge]``, then above the last edge.

    ``edges`` starts at 0 and ascends. Negative and missing values come last, each in a row of
    their own, so that shares reach 100.
    """

    edges: tuple[float, ...]

    def labels(self) -> list[str]:
        pairs = zip(self.edges, self.edges[1:])
        return ["0", *[f"{_text(a)} - {_text(b)}" for a, b in pairs], f"{self.edges[-1]:g}+"]

    def tests(self, value: Column) -> list[Column]:
        """One predicate per bucket, in label order."""
        pairs = zip(self.edges, self.edges[1:])
        return [value == 0, *[(value > a) & (value <= b) for a, b in pairs],
                value > self.edges[-1]]

    def label_of(self, value: Column, unknown: str | None = "Unknown") -> Column:
        """Row-wise bucket label."""
        named = list(zip(self.tests(value), self.labels()))
        chain = F.when(*named[0])
        for test, label in named[1:]:
            chain = chain.when(test, label)
        return chain.otherwise(unknown)


def _text(edge: float) -> str:
    return "0" if edge == 0 else str(float(edge))


# The distance histogram's edges in miles.
DISTANCE_MILES = Buckets((0, 0.1, 0.5, 1.0, 5.0, 10.0, 25.0))


def bucket_counts(df: DataFrame, column: str, buckets: Buckets) -> DataFrame:
    """``ord, bucket, cnt, pct``: every bucket has a row, also an empty one.

    One counter per bucket in a global aggregate, so the fixed order and the zero fill need no
    join against the list of buckets.
    """
    tests, labels = buckets.tests(ref(column)), buckets.labels()
    tests = [*tests, ref(column) < 0, ref(column).isNull()]
    labels = [*labels, "negative", "missing"]
    one = df.agg(n_rows().alias("total"),
                 *[n_where(t).alias(f"n{i}") for i, t in enumerate(tests)])
    return one.select(rows_from([
        F.struct(F.lit(i).cast("bigint").alias("ord"), F.lit(label).alias("bucket"),
                 F.col(f"n{i}").alias("cnt"), pct(F.col(f"n{i}"), F.col("total")).alias("pct"))
        for i, label in enumerate(labels)]))
