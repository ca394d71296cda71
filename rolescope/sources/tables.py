"""CSV and Parquet tables: scans, writes, conversion, verification."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rolescope.functions.columns import n_rows, ref
from rolescope.operators.profile import content_fingerprint
from rolescope.operators.quality import (Check, expect_columns, expect_rows, expect_type,
                                         parse_audit, quality_report, require)
from rolescope.session import scratch_path

# Timestamp text, with and without fractional seconds.
STRICT_TIME = "yyyy-MM-dd HH:mm:ss"
TIME_WITH_FRACTION = "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS]"

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: StructType, *,
             time_format: str = TIME_WITH_FRACTION, keep_corrupt: bool = False,
             multiline: bool = False, blank_as_null: bool = True, escape: str = "\\") -> DataFrame:
    """Header CSV with an explicit schema; a malformed value becomes NULL.

    The default time format takes optional fractions of a second: with a strict format a value
    such as ``05:46:00.000000000`` turns into NULL unnoticed. ``keep_corrupt`` adds the raw text
    of malformed rows. With ``blank_as_null=False`` a quoted empty value stays an empty string.
    Give ``escape='"'`` for files that double their quotes instead of using a backslash.
    """
    reader = (spark.read.option("header", True).option("mode", "PERMISSIVE")
              .option("timestampFormat", time_format).option("timestampNTZFormat", time_format)
              .option("multiLine", multiline).option("escape", escape))
    if not blank_as_null:
        reader = reader.option("nullValue", "\u0000").option("emptyValue", "")
    if keep_corrupt:
        schema = StructType([*schema.fields, StructField(CORRUPT, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(path)


def as_text(schema: StructType) -> StructType:
    """The same columns, all as strings."""
    return StructType([StructField(f.name, StringType()) for f in schema])


def audit_csv(spark: SparkSession, path: str, schema: StructType,
              time_formats: tuple[str, ...] = (TIME_WITH_FRACTION,)) -> DataFrame:
    """How many present values of each column a typed read would lose (see ``parse_audit``)."""
    raw = read_csv(spark, path, as_text(schema), blank_as_null=False)
    return parse_audit(raw, schema, time_formats)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Overwrite ``path``.

    With partition columns the rows are rebalanced on them first: adaptive execution splits a
    partition value that holds a large part of the table over several tasks and merges small
    ones, so there is neither one giant file nor a file per task and value.
    """
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode("overwrite") \
          .partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, escape: str = "\\") -> None:
    """Overwrite ``path`` with header CSV files, one per partition.

    Empty strings are quoted and NULLs are bare, so the two stay apart when read back; padding
    around text is kept.
    """
    df.write.mode("overwrite").option("header", True).option("emptyValue", '""') \
      .option("escape", escape).option("ignoreLeadingWhiteSpace", False) \
      .option("ignoreTrailingWhiteSpace", False) \
      .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS") \
      .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)


def head_rows(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of a file scan: files by path, rows as they stand in their file.

    ``limit`` returns whichever rows come first, which depends on how files are cut and dealt to
    tasks; here rows are ordered by file, start of the block and place in it. Files are added,
    twice as many each time, until they hold ``n`` rows, so the rest is never opened; of those read,
    a task keeps ``n`` rows.
    """
    spark = df.sparkSession
    paths = df.inputFiles()
    if not paths or n <= 0:
        return df.limit(0)
    where = F.col("_metadata.file_path")
    folders = sorted({f.rsplit("/", 1)[0] for f in paths})
    listed = manifest(spark, *[readable(f) for f in folders]).select("file")
    files, look = sorted(r["file"] for r in listed.collect()), 1
    while look < len(files) and df.where(where.isin(files[:look])).limit(n).count() < n:
        look *= 2
    order = ["__file", "__block", "__place"]
    return (df.where(where.isin(files[:look]))
            .withColumns({"__file": where, "__block": F.col("_metadata.file_block_start"),
                          "__place": F.monotonically_increasing_id()})
            .orderBy(*order).limit(n).drop(*order))


def head_sample(df: DataFrame, path: str, n: int) -> None:
    """Header plus the first ``n`` rows of a file scan, in file order, as one CSV file."""
    head_rows(df, n).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def readable(uri: str) -> str:
    """A listed file's URI as a path to read: decoded, with what a glob would expand escaped."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(uri))


def footprint(spark: SparkSession, path: str) -> DataFrame:
    """``files, bytes`` under a path, on any file system; file contents are not read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path))
    return files.agg(n_rows().alias("files"),
                     F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def manifest(spark: SparkSession, *paths: str) -> DataFrame:
    """``file, bytes, modified`` of every file under the paths, on any file system.

    The values are Spark's hidden file metadata, which come from listing: no file is opened, so it
    costs the same whatever the files hold.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return files.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"),
        F.col("_metadata.file_modification_time").alias("modified"))


def manifest_digest(files: DataFrame) -> DataFrame:
    """``files, bytes, digest``: one row that differs if a file came, went or was written again.

    A file rewritten with the same size has another modification time. Hashes are summed, so files
    may be listed in any order.
    """
    return files.agg(
        n_rows().alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum(F.xxhash64("file", "bytes", "modified").cast("decimal(38,0)")),
                   F.lit(0).cast("decimal(38,0)")).alias("digest"))


@contextmanager
def unchanged(spark: SparkSession, *paths: str) -> Iterator[DataFrame]:
    """Raise if a file under the paths is added, removed or rewritten inside the ``with``.

    Gives the manifest of before, kept in the shared scratch folder, so that the error can name the
    files that differ.
    """
    kept = scratch_path(spark, "manifest")
    manifest(spark, *paths).write.parquet(kept)
    before = read_parquet(spark, kept)
    yield before
    after = manifest(spark, *paths)
    if manifest_digest(after).first() != manifest_digest(before).first():
        odd = changed_files(before, after)
        named = ", ".join(f"{r['file']} ({r['change']})" for r in odd.orderBy("file").head(5))
        raise RuntimeError(f"input changed meanwhile: {named}")


def changed_files(before: DataFrame, after: DataFrame) -> DataFrame:
    """``file, change``: what differs between two manifests (added, removed or rewritten)."""
    old = before.select("file", F.struct("bytes", "modified").alias("was"))
    new = after.select("file", F.struct("bytes", "modified").alias("is"))
    change = (F.when(F.col("was").isNull(), "added").when(F.col("is").isNull(), "removed")
              .when(F.col("was") != F.col("is"), "rewritten"))
    return old.join(new, "file", "full").select("file", change.alias("change")) \
        .where(F.col("change").isNotNull())


def line_reconciliation(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """``parsed_rows, data_lines, difference``.

    Every non-empty file directly below ``path`` has one header line. A difference means embedded line breaks or blank
    lines: the parsed count is then the authoritative one.
    """
    parsed = read_csv(spark, path, schema).agg(n_rows()).scalar()
    headers = (spark.read.format("binaryFile").load(path)
               .where("length > 0").agg(n_rows()).scalar())
    lines = spark.read.text(path).agg(n_rows().alias("lines"))
    return (lines.select((F.col("lines") - headers).alias("data_lines"),
                         parsed.alias("parsed_rows"))
            .select("parsed_rows", "data_lines",
                    (F.col("parsed_rows") - F.col("data_lines")).alias("difference")))


def convert(spark: SparkSession, source: DataFrame, path: str, *,
            expected_rows: int | None = None, partition_by: tuple[str, ...] = ()) -> bool:
    """Write ``source`` as Parquet unless ``path`` already holds it. True when it wrote.

    A target that is missing or cannot be read as Parquet is written, and so is one whose columns,
    row count or content fingerprint differ; any other error (a passing read failure, say) is
    raised and leaves the target alone. Rows are counted while they are written. The result is
    verified before returning: rows, columns and, except for partition columns, whose types a
    reader infers from folder names, types.
    """
    if _holds(spark, path, source, expected_rows):
        return False
    seen = Observation()
    write_parquet(source.observe(seen, n_rows().alias("n")), path, partition_by)
    rows = seen.get["n"] if expected_rows is None else expected_rows
    written = read_parquet(spark, path)
    require(quality_report(written, [
        expect_rows(rows), expect_columns(written, len(source.columns)),
        *[expect_type(written, f.name, f.dataType.simpleString()) for f in source.schema
          if f.name not in partition_by]]))
    return True


# Conditions of a target that is not there or is not Parquet.
_NO_TABLE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "CANNOT_READ_FILE_FOOTER",
             "is not a Parquet file")


def is_missing(error: Exception) -> bool:
    """Whether a read failed because there is no Parquet table, and not for a passing reason."""
    return (isinstance(error, (PySparkException, Py4JJavaError))
            and any(c in str(error) for c in _NO_TABLE))


def _holds(spark: SparkSession, path: str, source: DataFrame, rows: int | None) -> bool:
    try:
        there = read_parquet(spark, path)
    except (PySparkException, Py4JJavaError) as error:
        if is_missing(error):
            return False
        raise
    if sorted(there.columns) != sorted(source.columns):
        return False
    found = content_fingerprint(there.select(*[
        ref(f.name).cast(f.dataType).alias(f.name) for f in source.schema])).first()
    return (rows is None or found["n"] == rows) and found == content_fingerprint(source).first()


def verify_copy(original: DataFrame, copy: DataFrame, *, content: bool = False) -> DataFrame:
    """Quality rows comparing a written copy with its original: rows, columns, types, content."""
    types = {f.name: f.dataType.simpleString() for f in original.schema}
    copied = {f.name: f.dataType.simpleString() for f in copy.schema}
    checks = [Check("row_count", original.agg(n_rows()).scalar(), n_rows()),
              expect_columns(copy, len(original.columns)),
              Check("column_types", F.lit(str(sorted(types.items()))),
                    F.lit(str(sorted(copied.items()))))]
    if content:
        same_order = copy.select(*original.columns) if set(types) == set(copied) else copy
        checks.append(Check(
            "content", content_fingerprint(original).select(F.col("hash_sum")).scalar(),
            F.sum(F.xxhash64(*same_order.columns).cast("decimal(38,0)"))))
    return quality_report(copy, checks)


def unchanged_since(before: DataFrame, after: DataFrame) -> bool:
    """Whether two footprints or fingerprints (one row each) are equal."""
    return before.first() == after.first()
