"""The batch jobs end to end on a small table with the incident schema."""

from __future__ import annotations

import csv
import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rolescope.__main__ import main
from rolescope.operators import anomalies, profile, ranking
from rolescope.operators.features import guard_leakage, role_audit
from rolescope.plans import jobs
from rolescope.presets import incidents as p
from rolescope.sources import tables

N = 600


def _value(name: str, kind: str, i: int, rng: random.Random) -> str:
    if name == "ID":
        return f"A-{i}"
    if name == "Severity":
        return str(rng.choices((1, 2, 3, 4), (1, 6, 2, 1))[0])
    if kind == "timestamp":
        stamp = dt.datetime(2019, 1, 1) + dt.timedelta(hours=rng.randrange(30_000))
        return str(stamp) + (".000000000" if i % 10 == 0 else "")
    if kind == "double":
        return "" if rng.random() < 0.1 else f"{rng.uniform(0, 60):.2f}"
    if kind == "boolean":
        return "False" if name == "Turning_Loop" else str(rng.random() < 0.2)
    return "" if rng.random() < 0.05 else f"{name}_{rng.randrange(6)}"


@pytest.fixture(scope="module")
def workdir(tmp_path_factory):
    return tmp_path_factory.mktemp("jobs")


@pytest.fixture(scope="module")
def parquet(spark, workdir):
    rng = random.Random(7)
    path = workdir / "incidents.csv"
    with path.open("w", newline="") as f:
        out = csv.writer(f)
        out.writerow(x.name for x in p.SCHEMA)
        for i in range(N):
            out.writerow(_value(x.name, x.dataType.simpleString(), i, rng) for x in p.SCHEMA)
    target = str(workdir / "parquet")
    main(["ingest", "--input", str(path), "--output", target, "--expected-rows", str(N)])
    return target


def test_schema_has_46_columns():
    assert len(p.SCHEMA) == 46 and len(p.FLAGS) == 13
    kinds = [f.dataType.simpleString() for f in p.SCHEMA]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "string": 17, "int": 1, "double": 12, "timestamp": 3, "boolean": 13}


def test_ingest_loses_no_time(spark, parquet, workdir):
    df = tables.read_parquet(spark, parquet)
    assert df.count() == N
    assert df.where("Start_Time IS NULL").count() == 0
    lost = jobs.ingest_reports(spark, str(workdir / "incidents.csv"), p.SCHEMA)["parse_audit"]
    assert lost.agg(F.sum("lost")).first()[0] == 0
    assert jobs.ingest(spark, str(workdir / "incidents.csv"), parquet, p.SCHEMA) is False


def test_model_features_do_not_leak(spark, parquet):
    guard_leakage(p.MODEL)
    assert len(p.MODEL.candidates) == 32
    audit = role_audit(tables.read_parquet(spark, parquet), p.MODEL).collect()
    assert [r["column"] for r in audit if r["status"] == "unassigned"] == [
        "Wind_Chill(F)", "Wind_Direction"]


def test_analytics_reports(spark, parquet, workdir):
    out = workdir / "analytics"
    main(["analytics", "--input", parquet, "--output", str(out)])
    made = {d.name for d in out.iterdir()}
    assert len(made) == 27 and {"overview", "by_hour", "sql_class_by_state"} <= made
    by_class = spark.read.csv(f"{out}/class_distribution", header=True, inferSchema=True)
    by_sql = spark.read.csv(f"{out}/sql_class_share", header=True, inferSchema=True)
    assert rows(by_class) == rows(by_sql)
    assert by_class.agg(F.sum("cnt")).first()[0] == N
    hours = spark.read.csv(f"{out}/by_hour", header=True, inferSchema=True)
    assert hours.agg(F.sum("cnt")).first()[0] == N
    states = spark.read.csv(f"{out}/class_by_state", header=True, inferSchema=True)
    assert states.agg(F.sum("total")).first()[0] == N
    flags = spark.read.csv(f"{out}/flag_prevalence", header=True, inferSchema=True)
    assert flags.count() == 13
    assert rows(flags)[-1] == ("Turning_Loop", 0, N, 0.0)


def test_analytics_refuses_repeated_ids(spark, parquet, workdir):
    df = tables.read_parquet(spark, parquet)
    with pytest.raises(AssertionError, match="unique_ids"):
        jobs.analytics(df.unionAll(df.limit(1)), p.REPORT, p.BUCKETS, p.FOCUS_FLAGS,
                       str(workdir / "refused"))


def test_profile_and_anomalies(spark, parquet, workdir):
    for job, reports in (("profile", 12), ("anomalies", 5)):
        out = workdir / job
        main([job, "--input", parquet, "--output", str(out)])
        assert len(list(out.iterdir())) == reports
    ladder = spark.read.csv(f"{workdir}/anomalies/threshold_ladder", header=True,
                            inferSchema=True)
    assert ladder.count() == len(p.LADDER) + 3 * 5
    constant = spark.read.csv(f"{workdir}/profile/constant_columns", header=True,
                              inferSchema=True)
    assert [r["column"] for r in constant.collect() if r["is_constant"]] == ["Turning_Loop"]


def test_jobs_scan_their_table_three_times(spark, parquet, monkeypatch):
    """Scans that start: one in the shared pass, one for each other source of reports."""
    df = tables.read_parquet(spark, parquet)
    passes = []
    real = type(df).first
    monkeypatch.setattr(type(df), "first", lambda self: passes.append(self) or real(self))
    made = jobs.profile_reports(df, p.REPORT, p.PROFILED, p.TEXT, p.RANGED)
    assert len(passes) == 1
    files = {name: t._jdf.queryExecution().executedPlan().toString().count("FileScan")
             for name, t in made.items()}
    assert [n for n, c in files.items() if c and "InMemoryTableScan" not in
            made[n]._jdf.queryExecution().executedPlan().toString()] == ["duplicate_keys"]
    made = jobs.anomaly_reports(df, p.LADDER, p.PAIRS, p.EXTREMES, p.CONTEXT)
    assert len(passes) == 2
    assert [n for n, t in made.items() if "FileScan" in
            t._jdf.queryExecution().executedPlan().toString()] == ["top_values", "extreme_context"]


def test_one_pass_equals_separate_reports(spark, parquet):
    df = tables.read_parquet(spark, parquet)
    made = jobs.profile_reports(df, p.REPORT, p.PROFILED, p.TEXT, p.RANGED)
    assert rows(made["null_profile"]) == rows(profile.null_profile(df, p.PROFILED))
    assert rows(made["blank_profile"]) == rows(profile.blank_profile(df, p.TEXT))
    assert rows(made["time_range"]) == rows(profile.time_range(df, p.REPORT))
    assert rows(made["coverage"]) == rows(ranking.coverage(df, p.REPORT.state))
    made = jobs.anomaly_reports(df, p.LADDER, p.PAIRS, p.EXTREMES, p.CONTEXT)
    assert rows(made["threshold_ladder"]) == rows(anomalies.threshold_ladder(df, p.LADDER))
    assert rows(made["extreme_counts"]) == rows(anomalies.extreme_counts(df, p.EXTREMES))


def test_train_then_score(spark, parquet, workdir):
    df = tables.read_parquet(spark, parquet)
    out = str(workdir / "models")
    jobs.training(df, p.MODEL, p.REPORT.id, out, {"Decision Tree": {"maxDepth": 3}})
    scored = str(workdir / "scored")
    main(["score", "--input", parquet, "--output", scored,
          "--model", jobs.model_path(out, "Decision Tree")])
    got = tables.read_parquet(spark, scored)
    assert got.count() == N
    assert got.where("description IS NULL").count() == 0
