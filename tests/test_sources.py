"""CSV parsing, Parquet conversion, verification and the audit of lost values."""

from __future__ import annotations

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rolescope.operators import quality
from rolescope.plans import sqlreports
from rolescope.sources import reports, tables
from rolescope.sources.schemas import schema_of

SCHEMA = schema_of({"id": "string", "cls": "int", "start": "timestamp", "Humidity(%)": "double",
                    "flag": "boolean", "note": "string"})
LINES = """id,cls,start,Humidity(%),flag,note
a,1,2016-02-08 05:46:00,50.5,True,plain
b,2,2016-02-08 05:46:00.000000000,60,False,""
c,x,2016-02-08 05:46:00.5,,True,
d,3,,abc,,"  "
e,4,2016-02-08
"""


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(LINES)
    return str(path)


def test_fractional_times_are_parsed(spark, csv):
    df = tables.read_csv(spark, csv, SCHEMA)
    got = {r["id"]: r["start"] for r in df.collect()}
    assert got["a"] == got["b"] and got["a"] is not None
    assert got["d"] is None


def test_strict_pattern_loses_them_and_the_audit_says_so(spark, csv):
    strict = tables.read_csv(spark, csv, SCHEMA, time_format=tables.STRICT_TIME)
    assert strict.where("id = 'b'").first()["start"] is None
    audit = {r["column"]: r for r in tables.audit_csv(spark, csv, SCHEMA,
                                                      (tables.STRICT_TIME,)).collect()}
    assert audit["start"]["raw_values"] == 4
    assert audit["start"]["lost"] == 3
    assert audit["cls"]["lost"] == 1
    assert audit["Humidity(%)"]["lost"] == 1
    assert audit["id"]["lost"] == 0


def test_audit_of_the_default_pattern(spark, csv):
    audit = {r["column"]: r["lost"] for r in tables.audit_csv(spark, csv, SCHEMA).collect()}
    typed = tables.read_csv(spark, csv, SCHEMA)
    for name in ("start", "cls", "Humidity(%)"):
        present = tables.read_csv(spark, csv, tables.as_text(SCHEMA)).where(
            F.col(f"`{name}`").isNotNull()).count()
        assert present - typed.where(F.col(f"`{name}`").isNotNull()).count() == audit[name]


def test_audit_counts_what_the_reader_loses(spark, tmp_path):
    """Padded numbers, words for booleans, quotes and backslashes."""
    path = tmp_path / "odd.csv"
    path.write_text('n,b,d\n 12,yes,1.5\n7,1,"1,5"\n8,TRUE,\\\\\n,false,NaN\n9,,"a""b"\n')
    schema = schema_of({"n": "int", "b": "boolean", "d": "double"})
    typed = tables.read_csv(spark, str(path), schema, blank_as_null=False)
    raw = tables.read_csv(spark, str(path), tables.as_text(schema), blank_as_null=False)
    audit = {r["column"]: r["lost"] for r in tables.audit_csv(spark, str(path), schema).collect()}
    for c in ("n", "b", "d"):
        present = raw.where(F.trim(c) != "").count()
        assert audit[c] == present - typed.where(F.col(c).isNotNull()).count(), c
    assert audit["n"] == 1 and audit["b"] == 2


def test_corrupt_rows_are_kept(spark, csv):
    df = tables.read_csv(spark, csv, SCHEMA, keep_corrupt=True).cache()
    bad = {r["id"] for r in df.where(F.col(tables.CORRUPT).isNotNull()).collect()}
    df.unpersist()
    assert {"c", "d", "e"} <= bad and "a" not in bad


def test_blank_text_can_be_told_from_null(spark, csv):
    df = tables.read_csv(spark, csv, SCHEMA, blank_as_null=False)
    notes = {r["id"]: r["note"] for r in df.collect()}
    assert notes["b"] == ""
    assert notes["d"].strip() == ""


def test_line_reconciliation_and_footprint(spark, csv):
    assert rows(tables.line_reconciliation(spark, csv, SCHEMA)) == [(5, 5, 0)]
    assert rows(tables.footprint(spark, csv)) == [(1, len(LINES))]


def test_embedded_newline_shows_as_difference(spark, tmp_path):
    path = tmp_path / "two.csv"
    path.write_text('id,note\n1,"x\ny"\n2,z\n')
    schema = schema_of({"id": "int", "note": "string"})
    assert tables.read_csv(spark, str(path), schema, multiline=True).count() == 2
    lines = tables.line_reconciliation(spark, str(path), schema).first()
    assert lines["data_lines"] == 3


def test_awkward_text_survives_csv(spark, tmp_path):
    texts = ["plain", 'say ""hi""', '"', "a,b", "two\nlines", "", None, " padded ", "ends\\"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, note string")
    schema = schema_of({"id": "int", "note": "string"})
    tables.write_csv(df, str(tmp_path / "out"), escape='"')
    back = tables.read_csv(spark, str(tmp_path / "out"), schema, multiline=True, escape='"',
                           blank_as_null=False)
    got = dict(rows(back))
    assert {i: t for i, t in enumerate(texts) if t is not None} == {
        i: t for i, t in got.items() if texts[i] is not None}


def test_doubled_quotes(spark, tmp_path):
    path = tmp_path / "rfc.csv"
    path.write_text('id,note\n1,"he said ""stop"", then left"\n2,x\n')
    schema = schema_of({"id": "int", "note": "string"})
    assert rows(tables.read_csv(spark, str(path), schema, escape='"')) == [
        (1, 'he said "stop", then left'), (2, "x")]


def test_convert_reuses_only_a_matching_target(spark, csv, tmp_path):
    source = tables.read_csv(spark, csv, SCHEMA)
    out = str(tmp_path / "out")
    assert tables.convert(spark, source, out, expected_rows=5) is True
    assert tables.convert(spark, source, out, expected_rows=5) is False
    tables.write_parquet(source.limit(2), out)
    assert tables.convert(spark, source, out, expected_rows=5) is True
    changed = source.withColumn("cls", F.lit(1))
    assert tables.convert(spark, changed, out) is True
    assert tables.convert(spark, changed, out) is False
    with pytest.raises(AssertionError, match="row_count"):
        tables.convert(spark, source, str(tmp_path / "other"), expected_rows=6)


def test_unreadable_target_is_rebuilt(spark, csv, tmp_path):
    out = tmp_path / "broken"
    out.mkdir()
    (out / "part-0.parquet").write_text("not parquet")
    source = tables.read_csv(spark, csv, SCHEMA)
    assert tables.convert(spark, source, str(out), expected_rows=5) is True
    assert tables.read_parquet(spark, str(out)).count() == 5


def test_verify_copy_sees_changed_content(spark, csv, tmp_path):
    source = tables.read_csv(spark, csv, SCHEMA)
    out = str(tmp_path / "copy")
    tables.write_parquet(source, out, ("cls",))
    copy = tables.read_parquet(spark, out)
    assert all(r["passed"] for r in tables.verify_copy(source, copy, content=True).collect())
    altered = copy.withColumn("note", F.coalesce("note", F.lit("?")))
    failed = [r["check"] for r in tables.verify_copy(source, altered, content=True).collect()
              if not r["passed"]]
    assert failed == ["content"]


def test_hot_partition_value_is_split_over_files(spark, tmp_path):
    """Three quarters of the rows share one partition value; no single task writes them all."""
    df = spark.range(40_000).select(
        F.when(F.col("id") % 4 == 0, "cold").otherwise("hot").alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    out = tmp_path / "skewed"
    try:
        spark.conf.set(size, "256KB")
        tables.write_parquet(df.repartition(16), str(out), ("k",))
    finally:
        spark.conf.set(size, before)
    assert len(list((out / "k=hot").glob("*.parquet"))) > 1
    assert tables.read_parquet(spark, str(out)).count() == 40_000


def test_registered_view_answers_sql(spark, csv):
    sqlreports.register(tables.read_csv(spark, csv, SCHEMA), "incidents_view")
    got = spark.sql("SELECT flag, COUNT(*) AS n FROM incidents_view GROUP BY flag ORDER BY flag")
    assert rows(got) == [(None, 2), (False, 1), (True, 2)]


def test_head_sample(spark, csv, tmp_path):
    out = str(tmp_path / "head")
    tables.head_sample(tables.read_csv(spark, csv, SCHEMA), out, 2)
    assert tables.read_csv(spark, out, SCHEMA).count() == 2


def test_report_roundtrip_keeps_order_and_values(spark, tmp_path):
    df = spark.range(50).select((50 - F.col("id")).alias("n"), F.lit("x,y").alias("t"))
    out = str(tmp_path / "report")
    reports.write_report(df.orderBy("n"), out)
    back = reports.read_report(spark, out, "n bigint, t string")
    assert rows(back) == [(i, "x,y") for i in range(1, 51)]


def test_unchanged_since(spark, csv):
    a, b = tables.footprint(spark, csv), tables.footprint(spark, csv)
    assert tables.unchanged_since(a, b)


def test_ingest_smoke_expectations(spark, csv):
    df = tables.read_csv(spark, csv, SCHEMA)
    report = quality.quality_report(df, [
        quality.expect_columns(df, 6), quality.expect_type(df, "start", "timestamp"),
        quality.expect_some_values("Humidity(%)"), quality.expect_both_flags("flag"),
        quality.expect_no_nulls("start")])
    assert [r["passed"] for r in report.collect()] == [True, True, True, True, False]


def test_manifest_reads_no_file(spark, tmp_path):
    """A file that cannot be read as anything is listed all the same."""
    (tmp_path / "a.parquet").write_bytes(b"not parquet")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b").write_bytes(b"12345")
    files = tables.manifest(spark, str(tmp_path))
    assert sorted((r["file"].rsplit("/", 1)[1], r["bytes"]) for r in files.collect()) == [
        ("a.parquet", 11), ("b", 5)]
    assert "content" not in files._jdf.queryExecution().executedPlan().toString().split(
        "ReadSchema")[1]


@pytest.mark.parametrize("change", ["rewritten", "added", "removed"])
def test_guard_names_what_changed(spark, tmp_path, change):
    paths = [tmp_path / n for n in ("x.csv", "y.csv")]
    for p in paths:
        p.write_text("id\n1\n")
        os.utime(p, (1_600_000_000, 1_600_000_000))
    with tables.unchanged(spark, str(tmp_path)):
        assert spark.read.csv(str(tmp_path)).count() == 4
    with pytest.raises(RuntimeError, match=rf"y\d?.csv \({change}\)"):
        with tables.unchanged(spark, str(tmp_path)):
            if change == "rewritten":
                paths[1].write_text("id\n2\n")  # of the same size
            elif change == "added":
                (tmp_path / "y2.csv").write_text("id\n")
            else:
                paths[1].unlink()
