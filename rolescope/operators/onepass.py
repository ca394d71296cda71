"""Several reports of global aggregates from one scan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Report = Callable[[DataFrame], DataFrame]


class _Asked:
    """Stands for a table and notes the aggregates that a report asks of it."""

    def __init__(self, df: DataFrame):
        self.df = df
        self.asked: list[tuple[list[str], tuple[Column, ...]]] = []

    def __getattr__(self, name: str):
        return getattr(self.df, name)

    def agg(self, *columns: Column) -> DataFrame:
        result = self.df.agg(*columns)  # only its schema is used
        self.asked.append((result.columns, columns))
        return result


class _Answered:
    """Stands for the table and answers the same requests from the one row computed for all."""

    def __init__(self, df: DataFrame, row: DataFrame, names: list[list[str]]):
        self.df, self.row, self.names, self.next = df, row, names, 0

    def __getattr__(self, name: str):
        return getattr(self.df, name)

    def agg(self, *columns: Column) -> DataFrame:
        i = self.next
        self.next += 1
        return self.row.select(*[F.col(f"a{i}_{j}").alias(n)
                                 for j, n in enumerate(self.names[i])])


def one_pass(df: DataFrame, reports: dict[str, Report]) -> dict[str, DataFrame]:
    """Each report of ``df``, all from a single aggregate that runs here.

    A report is a function of the table that calls ``agg`` on it directly and shapes the one row
    it gets; what else it does with the table is unaffected. The combined row (as many values as
    the reports have aggregates) is small and kept as a literal.
    """
    probe = _Asked(df)
    for report in reports.values():
        report(probe)
    combined = df.agg(*[c.alias(f"a{i}_{j}") for i, (_, columns) in enumerate(probe.asked)
                        for j, c in enumerate(columns)])
    row = df.sparkSession.createDataFrame([combined.first()], combined.schema)
    answered = _Answered(df, row, [names for names, _ in probe.asked])
    return {name: report(answered) for name, report in reports.items()}
