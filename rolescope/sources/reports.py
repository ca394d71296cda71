"""Small result tables as CSV, and their way back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def write_report(df: DataFrame, path: str) -> None:
    """One header CSV file in ``path``. Reports are aggregates, so one writer task suffices.

    The rows are numbered in their order and shuffled to that task, so everything before it keeps
    its own parallelism.
    """
    numbered = df.withColumn("__row", F.monotonically_increasing_id())
    numbered.repartition(1).sortWithinPartitions("__row").drop("__row").write.mode("overwrite").option("header", True).csv(path)


def read_report(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def union_reports(reports: dict[str, DataFrame]) -> DataFrame:
    """``report`` plus the columns of same-shaped reports, as one UNION ALL."""
    result = None
    for name, df in reports.items():
        named = df.select(F.lit(name).alias("report"), *df.columns)
        result = named if result is None else result.unionByName(named)
    return result
