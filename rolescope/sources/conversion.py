"""Incremental conversion: each source file becomes Parquet once, behind a log of commits."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rolescope.functions.columns import n_rows
from rolescope.sources.tables import is_missing, manifest, readable

LOG = ("commit bigint, file string, bytes bigint, modified timestamp, batch string, source bigint, "
       "rows bigint")
SOURCE = "source_file_id"

Reader = Callable[[list[str]], DataFrame]


@dataclass(frozen=True)
class Commit:
    """What a run did: its number (0: nothing to do), files converted and dropped, rows written."""

    number: int
    converted: int
    dropped: int
    rows: int


def _source_id(file, size, modified):
    """One number for one version of a file: a rewritten file is another source."""
    return F.xxhash64(file, size, modified)


def commits(spark: SparkSession, path: str) -> DataFrame:
    """Every entry of the log; no rows if nothing was ever committed."""
    try:
        return spark.read.schema(LOG).parquet(f"{path}/commits")
    except Exception as error:
        if is_missing(error):
            return spark.createDataFrame([], LOG)
        raise


def live_files(spark: SparkSession, path: str) -> DataFrame:
    """The last entry of each source file that the table still holds (a dropped one has no batch)."""
    entry = F.struct("commit", "bytes", "modified", "batch", "source", "rows")
    return (commits(spark, path).groupBy("file").agg(F.max_by(entry, "commit").alias("e"))
            .select("file", "e.*").where(F.col("batch").isNotNull()))


def convert_files(spark: SparkSession, sources: str, path: str, read: Reader) -> Commit:
    """Bring the table at ``path`` up to date with the files below ``sources``.

    Only files that are new or were rewritten (another size or modification time) are read, by
    ``read(paths)``; rows of rewritten and vanished files leave the table. A run without changes
    reads listings and the log, no data. ``read`` must return a plain scan of the files, so that
    each row knows its file.

    Rows are written to a folder of the run's own, split by source file without a shuffle, and
    counted again from the written footers. One small append to the log then makes them part of
    the table. A run that fails before that leaves the table as it was, and what it wrote is
    named by no entry. Runs on one table must follow one another.
    """
    seen = manifest(spark, sources).select(
        "file", "bytes", "modified", _source_id("file", "bytes", "modified").alias("source"))
    known = live_files(spark, path)
    changed = (seen.join(known.select("file", F.col("source").alias("was")), "file", "full")
               .where(~F.col("source").eqNullSafe(F.col("was")))
               .orderBy("file").collect())  # one small row for each changed file, as in a listing
    if not changed:
        return Commit(0, 0, 0, 0)
    number = 1 + (commits(spark, path).agg(F.max("commit")).first()[0] or 0)
    new = [r for r in changed if r["source"] is not None]
    batch, rows = uuid4().hex, {}
    if new:
        rows = _write(read([readable(r["file"]) for r in new]), f"{path}/data/{batch}",
                      [r["source"] for r in new])
    entries = [(number, r["file"], r["bytes"], r["modified"],
                batch if r["source"] is not None else None, r["source"],
                rows.get(r["source"], 0)) for r in changed]
    # one task, one file: the append shows whole or not at all
    spark.createDataFrame(entries, LOG).coalesce(1).write.mode("append").parquet(f"{path}/commits")
    return Commit(number, len(new), len(changed) - len(new), sum(rows.values()))


def _write(rows: DataFrame, folder: str, expected: list[int]) -> dict[int, int]:
    """Write rows below their source's number; rows for each source as read back."""
    spark = rows.sparkSession
    meta = F.col("_metadata")
    tagged = rows.withColumn(SOURCE, _source_id(
        meta["file_path"], meta["file_size"], meta["file_modification_time"]))
    tagged.write.partitionBy(SOURCE).parquet(folder)
    try:
        back = spark.read.parquet(folder)
    except Exception as error:
        if is_missing(error):  # header lines alone: nothing was written
            return {}
        raise
    found = {int(r[SOURCE]): r["n"] for r in
             back.groupBy(SOURCE).agg(n_rows().alias("n")).collect()}
    if not set(found) <= set(expected):
        raise RuntimeError(f"a source file changed while it was converted; {folder} stays unused")
    return found


def read_converted(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table as of the last commit: the folders of the live files, and no other file."""
    live = live_files(spark, path).where("rows > 0").select("batch", "source").collect()
    if not live:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(
        *[f"{path}/data/{r['batch']}/{SOURCE}={r['source']}" for r in live])
