"""Exact results on small tables with NULLs, ties, empty input and odd names."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rolescope.functions.columns import pct, ref, safe_alias
from rolescope.operators import (anomalies, buckets, crosstab, profile, quality, quantiles,
                                 ranking, summary, temporal)
from rolescope.operators.anomalies import Rule
from rolescope.operators.counts import complete_domain, distribution
from rolescope.roles import Roles


@pytest.fixture(scope="module")
def incidents(spark):
    t = dt.datetime
    data = [
        (1, "CA", 2, t(2020, 1, 5, 7), 0.0, True, None),
        (2, "CA", 2, t(2020, 1, 6, 7), 0.1, False, 1.0),
        (3, "FL", 3, t(2021, 2, 1, 23), 0.5, True, None),
        (4, "FL", 2, None, 25.0, None, 4.0),
        (5, None, 1, t(2023, 12, 31, 0), 25.01, False, 2.0),
        (6, "TX", None, t(2021, 2, 6, 12), -1.0, False, None),
        (7, "NY", 4, None, None, False, 3.0),
    ]
    return spark.createDataFrame(
        data, "id int, state string, cls int, start timestamp, `Distance(mi)` double, "
              "flag boolean, `Humidity(%)` double")


@pytest.fixture(scope="module")
def empty(incidents):
    return incidents.where("id < 0")


CLASSES = (1, 2, 3, 4)


def test_distribution_keeps_null_class_last(incidents):
    assert rows(distribution(incidents, "cls")) == [
        (1, 1, 14.29), (2, 3, 42.86), (3, 1, 14.29), (4, 1, 14.29), (None, 1, 14.29)]


def test_distribution_of_nothing(empty):
    assert rows(distribution(empty, "cls")) == []


def test_by_part_denominators(incidents):
    assert rows(temporal.by_part(incidents, "year", time="start")) == [
        (2020, 2, 28.57), (2021, 2, 28.57), (2023, 1, 14.29)]
    assert rows(temporal.by_part(incidents, "year", time="start", denominator="non_null",
                                 keep_null=True)) == [
        (2020, 2, 40.0), (2021, 2, 40.0), (2023, 1, 20.0), (None, 2, None)]
    with pytest.raises(ValueError):
        temporal.by_part(incidents, "year", time="start", denominator="some")


def test_cube_rolls_up_to_the_same_reports(incidents):
    cube = temporal.time_cube(incidents, "start", ("cls",))
    for part in ("year", "month", "dow", "hour"):
        assert rows(temporal.by_part(cube, part, weight="cnt")) == rows(
            temporal.by_part(incidents, part, time="start"))
    assert cube.agg(F.sum("cnt")).first()[0] == 7


def test_names_of_days_and_months(incidents):
    assert rows(temporal.by_part(incidents, "dow", time="start").select("dow", "name")) == [
        (1, "Sunday"), (2, "Monday"), (7, "Saturday")]
    assert [r[1] for r in rows(temporal.by_part(incidents, "month", time="start"))] == [
        "Jan", "Feb", "Dec"]
    kept = temporal.by_part(incidents, "month", time="start", keep_null=True)
    assert rows(kept)[-1] == (None, None, 2, 28.57)


def test_weekday_weekend_ignores_missing_times(incidents):
    assert rows(temporal.weekday_weekend(incidents, "start")) == [
        ("weekday", 2, 28.57), ("weekend", 3, 42.86)]


def test_growth_needs_the_year_before(incidents):
    assert rows(temporal.year_over_year(incidents, "start")) == [
        (2020, 2, None, None), (2021, 2, 2.0, 0.0), (2023, 1, None, None)]


def test_ties_are_cut_by_key(incidents):
    assert rows(ranking.top_groups(incidents, ["state"], 3)) == [
        ("CA", 2, 28.57), ("FL", 2, 28.57), ("NY", 1, 14.29)]
    assert rows(ranking.top_groups(incidents, ["state"], 9, keep_null=False))[-1] == (
        "TX", 1, 14.29)
    assert rows(ranking.top_groups(incidents, ["state"], 9))[-1][0] is None


def test_rows_in_top_keeps_whole_rows(incidents):
    kept = ranking.rows_in_top(incidents, "state", 2)
    assert sorted(r["id"] for r in kept.collect()) == [1, 2, 3, 4]


def test_coverage_and_running_share(incidents):
    assert rows(ranking.coverage(incidents, "state", 2)) == [
        (1, "CA", 2, 28.57, 5), (2, "FL", 2, 28.57, 5)]
    assert rows(ranking.cumulative_share(incidents, "state", 3)) == [
        (1, "CA", 2, 28.57), (2, "FL", 2, 57.14), (3, "NY", 1, 71.43)]


def test_top_values_descend_and_skip_null(incidents):
    assert rows(ranking.top_values(incidents, "Distance(mi)", 2)) == [(25.01, 1), (25.0, 1)]


def test_crosstab_is_zero_filled_and_totalled(incidents):
    table = crosstab.crosstab(incidents, "state", "cls", CLASSES)
    got = {r["state"]: tuple(r)[1:] for r in table.collect()}
    assert got == {"CA": (0, 2, 0, 0, 0, 2), "FL": (0, 1, 1, 0, 0, 2), "NY": (0, 0, 0, 1, 0, 1),
                   None: (1, 0, 0, 0, 0, 1), "TX": (0, 0, 0, 0, 1, 1)}
    share = {r["state"]: tuple(r)[1:] for r in
             crosstab.row_percent(table, "state", CLASSES).collect()}
    assert share["FL"] == (0.0, 50.0, 50.0, 0.0, 0.0)
    assert share["TX"] == (0.0, 0.0, 0.0, 0.0, 100.0)


def test_crosstab_totals_count_rows_off_the_list(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("a", 9), ("b", 2)], "k string, c int")
    assert rows(crosstab.crosstab(df, "k", "c", (1, 2))) == [("a", 1, 0, 2, 3), ("b", 0, 1, 0, 1)]
    counted = df.groupBy("k", "c").agg(F.count(F.lit(1)).alias("n"))
    assert rows(crosstab.crosstab(counted, "k", "c", (1, 2), weight="n")) == [
        ("a", 1, 0, 2, 3), ("b", 0, 1, 0, 1)]
    assert rows(crosstab.top_crosstab(df, "k", "c", (1, 2), 1)) == [("a", 1, 0, 2, 3)]


def test_top_crosstab_equals_semi_join_form(incidents):
    one_pass = rows(crosstab.top_crosstab(incidents, "state", "cls", CLASSES, 2))
    two_pass = rows(crosstab.crosstab(ranking.rows_in_top(incidents, "state", 2), "state", "cls",
                                      CLASSES))
    assert one_pass == two_pass


def test_class_within_flags(incidents):
    assert rows(crosstab.class_within_flags(incidents, ("flag",), "cls")) == [
        ("flag", 2, 1, 2, 50.0), ("flag", 3, 1, 2, 50.0)]


def test_flag_prevalence_counts_null_as_neither(incidents):
    assert rows(summary.flag_prevalence(incidents, ("flag",))) == [("flag", 2, 4, 28.571)]


def test_numeric_summary_with_odd_names(incidents):
    exact = rows(summary.numeric_summary(incidents, ("Humidity(%)", "Distance(mi)"), exact=True))
    assert exact == [("Humidity(%)", 4, 3, 42.86, 2.5, 2.0, 1.0, 4.0),
                     ("Distance(mi)", 6, 1, 14.29, 8.27, 0.1, -1.0, 25.01)]
    assert rows(summary.numeric_summary(incidents, ("Humidity(%)", "Distance(mi)"))) == exact


def test_numeric_summary_of_nothing(empty, incidents):
    assert rows(summary.numeric_summary(empty, ("Humidity(%)",), exact=True)) == [
        ("Humidity(%)", 0, 0, 0.0, None, None, None, None)]
    all_null = incidents.withColumn("n", F.lit(None).cast("double"))
    assert rows(summary.numeric_summary(all_null, ("n",), exact=True)) == [
        ("n", 0, 7, 100.0, None, None, None, None)]


def test_summary_by_class(incidents):
    for exact in (True, False):
        got = rows(summary.summary_by_class(incidents, "Distance(mi)", "cls", CLASSES,
                                            exact=exact))
        assert got[:2] == [(1, 1, 25.01, 25.01, 25.01, 25.01),
                           (2, 3, 8.3667, 0.1, 0.0, 25.0)]
        assert got[3] == (4, 0, None, None, None, None)


def test_buckets_are_half_open_and_zero_filled(incidents):
    got = rows(buckets.bucket_counts(incidents, "Distance(mi)", buckets.DISTANCE_MILES))
    assert [r[1] for r in got] == ["0", "0 - 0.1", "0.1 - 0.5", "0.5 - 1.0", "1.0 - 5.0",
                                   "5.0 - 10.0", "10.0 - 25.0", "25+", "negative", "missing"]
    assert [r[2] for r in got] == [1, 1, 1, 0, 0, 0, 1, 1, 1, 1]
    assert abs(sum(r[3] for r in got) - 100) < 0.1
    labels = incidents.select("id", buckets.DISTANCE_MILES.label_of(ref("Distance(mi)")))
    assert dict(rows(labels))[6] == dict(rows(labels))[7] == "Unknown"


def test_ladder(incidents):
    got = rows(anomalies.threshold_ladder(incidents, [
        Rule("Distance(mi)", "=", 0), Rule("Distance(mi)", ">", 25), Rule("Humidity(%)", "<", 2)]))
    assert got == [("Distance(mi)", "null", 1.0), ("Distance(mi)", "= 0", 1.0),
                   ("Distance(mi)", "> 25", 1.0), ("Distance(mi)", "min", -1.0),
                   ("Distance(mi)", "max", 25.01), ("Humidity(%)", "null", 3.0),
                   ("Humidity(%)", "< 2", 1.0), ("Humidity(%)", "min", 1.0),
                   ("Humidity(%)", "max", 4.0)]


def test_paired_missingness_adds_up(incidents):
    got = rows(anomalies.paired_missingness(incidents, {"p": ("start", "Humidity(%)")}))
    assert [r[2] for r in got] == [0, 2, 3, 2]
    assert sum(r[2] for r in got) == 7


def test_extreme_context_ranks_inside_each_rule(incidents):
    rules = [Rule("Distance(mi)", ">", 0.2), Rule("Humidity(%)", ">", 2.5)]
    got = rows(anomalies.extreme_context(incidents, rules, ("state",), 2))
    assert got == [("Distance(mi) > 0.2", "state", "FL", 2, 1),
                   ("Distance(mi) > 0.2", "state", None, 1, 2),
                   ("Humidity(%) > 2.5", "state", "FL", 1, 1),
                   ("Humidity(%) > 2.5", "state", "NY", 1, 2)]
    assert rows(anomalies.extreme_counts(incidents, rules)) == [
        ("Distance(mi) > 0.2", 3), ("Humidity(%) > 2.5", 2)]


def test_profiles(incidents, empty):
    assert rows(profile.null_profile(incidents, ("id", "start", "Humidity(%)"))) == [
        ("Humidity(%)", 3, 42.8571), ("start", 2, 28.5714), ("id", 0, 0.0)]
    assert rows(profile.null_profile(empty, ("id",))) == [("id", 0, 0.0)]
    assert rows(profile.constant_columns(
        incidents.withColumn("same", F.lit(1)), ("same", "state", "flag"))) == [
        ("same", 7, True), ("state", 6, False), ("flag", 6, False)]


def test_duplicates_and_overview(spark, incidents):
    twice = incidents.unionAll(incidents.where("id <= 2"))
    assert rows(profile.duplicate_keys(twice, ("id",))) == [(9, 7, 2, 2, 2)]
    assert sorted(rows(profile.repeated_keys(twice, ("id",)))) == [(1, 2), (2, 2)]
    roles = Roles(id=("id",), start_time="start", state="state")
    exact = profile.overview(twice, roles)
    assert rows(exact) == [(9, 7, 7, "2020-01-05 07:00:00", "2023-12-31 00:00:00", 4)]
    assert rows(profile.overview(twice, roles, approx=True)) == rows(exact)


def test_order_violations_ignore_missing_sides(spark):
    df = spark.createDataFrame([(1, 2), (2, 1), (None, 1), (3, None)], "a int, b int")
    roles = Roles(start_time="a", end_time="b")
    assert rows(profile.order_violations(df, roles)) == [(4, 1, 25.0)]


def test_fingerprint_ignores_order_but_not_copies(incidents):
    base = profile.content_fingerprint(incidents).first()
    assert base == profile.content_fingerprint(incidents.repartition(5)).first()
    assert base != profile.content_fingerprint(incidents.unionAll(incidents)).first()


def test_complete_domain_keeps_the_given_order(incidents):
    counts = incidents.groupBy("state").agg(F.count("*").alias("n"))
    got = complete_domain(counts, "state", ("TX", "WA", "CA"), {"n": 0}).orderBy("ord")
    assert rows(got) == [(0, "TX", 1), (1, "WA", 0), (2, "CA", 2)]


def test_quality_report_and_require(incidents):
    good = [quality.expect_rows(7), quality.expect_unique(incidents, ("id",)),
            quality.expect_both_flags("flag"), quality.expect_type(incidents, "id", "int")]
    report = quality.quality_report(incidents, good)
    assert all(r["passed"] for r in report.collect())
    quality.require(report)
    bad = quality.quality_report(incidents, [quality.expect_no_nulls("start"),
                                             quality.expect_classes_cover("cls", CLASSES)])
    with pytest.raises(AssertionError, match="no_nulls:start: expected 0, got 2"):
        quality.require(bad)


def test_percent_of_nothing_is_zero(spark):
    got = spark.range(1).select(pct(F.lit(0), F.lit(0)), pct(F.lit(1), F.lit(8), 1),
                                pct(F.lit(201), F.lit(20000))).first()
    assert tuple(got) == (0.0, 12.5, 1.01)


def test_safe_alias():
    assert safe_alias("min", "Humidity(%)") == "min_Humidity_pct"
    assert safe_alias("null", "a b") == "null_a_b"


def test_roles_must_be_set():
    with pytest.raises(ValueError, match="end_time"):
        Roles(start_time="s").need("start_time", "end_time")


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.one_of(st.none(), st.integers(-3, 3).map(float),
                                 st.floats(-1e9, 1e9)), max_size=60),
       q=st.sampled_from([0.0, 0.25, 0.5, 0.9, 1.0]))
def test_exact_quantile_is_exact(spark, values, q):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = quantiles.exact_quantile(df, {"q": F.col("v")}, q).first()["q"]
    known = sorted(v for v in values if v is not None)
    rank = max(-(-len(known) * int(q * 100) // 100), 1)
    assert got == (known[rank - 1] if known else None)


def test_exact_quantile_on_skewed_values(spark):
    """A third of the rows share one value; the rest are spread over many magnitudes."""
    df = spark.range(30_000).select(
        F.when(F.col("id") < 10_000, 1.0).otherwise(F.exp(F.col("id") / 400)).alias("v"))
    values = sorted(r[0] for r in df.collect())
    got = quantiles.exact_quantile(df, {"a": F.col("v"), "b": -F.col("v")}).first()
    assert got["a"] == values[14_999]
    assert got["b"] == sorted(-v for v in values)[14_999]


def test_exact_quantile_keeps_wide_integers(spark):
    base = 2 ** 60
    df = spark.range(1001).select((F.lit(base) + F.col("id")).alias("v"))
    got = quantiles.exact_quantile(df, {"q": F.col("v")}).first()["q"]
    assert got == base + 500


def _rank(values, q):
    known = sorted((v for v in values if v is not None),
                   key=lambda v: (math.isnan(v), 0 if math.isnan(v) else v))
    return known[max(math.ceil(len(known) * q), 1) - 1] if known else None


@pytest.mark.parametrize("kind", ["string", "int", "date", "boolean"])
def test_exact_summary_of_groups(spark, kind):
    rng = random.Random(kind)
    groups = {"string": ["it's", "b`", "", None], "int": [1, -2, None],
              "date": [dt.date(2020, 1, 2), None], "boolean": [True, False, None]}[kind]
    odd = [None, 0.0, -0.0, 5e-324, -1e308, 1e308, float("inf"), float("-inf"), float("nan"), 0.1]
    data = [(rng.choice(groups), rng.choice([rng.choice(odd), rng.gauss(0, 1e3), rng.random()]),
             rng.choice([None, rng.gauss(5, 1e-9)])) for _ in range(900)]
    df = spark.createDataFrame(data, f"g {kind}, a double, b double").repartition(5)
    for q in (0.5, 0.9):
        got = {(r["series"], r["group"]): r for r in quantiles.exact_summary(
            df, {"a": F.col("a"), "b": F.col("b")}, F.col("g"), q).collect()}
        assert len(got) == 2 * len(groups)
        for i, name in enumerate("ab", 1):
            for g in groups:
                mine = [r[i] for r in data if r[0] == g and type(r[0]) is type(g)]
                r = got[name, g]
                want = _rank(mine, q)
                assert r["value"] == want or math.isnan(want) and math.isnan(r["value"])
                assert (r["total"], r["n"]) == (len(mine), sum(v is not None for v in mine))
    b = [r[2] for r in data if r[2] is not None]
    every = quantiles.exact_summary(df, {"b": F.col("b")}).first()
    assert (every["min"], every["max"], every["value"]) == (min(b), max(b), _rank(b, 0.5))
    assert every["mean"] == pytest.approx(sum(b) / len(b))


def test_exact_quantile_takes_as_many_rounds_as_it_needs(spark):
    """Neighbouring doubles of one bucket: 65,536 slots hold several values each."""
    step = 2.0 ** -52
    df = spark.range(300_000).select((1 + F.col("id") * F.lit(step)).alias("v"), F.lit("x").alias("g"))
    got = quantiles.exact_summary(df.unionByName(df.select((F.col("v") * 1e-200).alias("v"),
                                                          F.lit("y").alias("g"))),
                                  {"v": F.col("v")}, F.col("g")).collect()
    assert {r["group"]: r["value"] for r in got} == {
        "x": 1 + 149_999 * step, "y": (1 + 149_999 * step) * 1e-200}


def test_exact_summary_of_nothing(spark):
    df = spark.createDataFrame([], "g int, v double")
    assert rows(quantiles.exact_summary(df, {"v": F.col("v")}, F.col("g"))) == []
    assert rows(quantiles.exact_summary(df, {"v": F.col("v")})) == [
        ("v", None, 0, 0, None, None, None, None)]
    df = spark.createDataFrame([(1, None), (2, 3.0)], "g int, v double")
    got = rows(quantiles.exact_summary(df, {"v": F.col("v")}, F.col("g")).orderBy("group"))
    assert got == [("v", 1, 1, 0, None, None, None, None), ("v", 2, 1, 1, 3.0, 3.0, 3.0, 3.0)]


def test_sketches_merge_without_the_rows(spark, tmp_path):
    df = spark.range(60_000).select(
        (F.col("id") * 7919 % 60_000).cast("double").alias("v"), (F.col("id") % 3).alias("day"),
        F.when(F.col("id") % 2 == 0, "a").alias("g"), F.lit(None).cast("double").alias("none"))
    columns = {"v": F.col("v"), "none": F.col("none")}
    path = str(tmp_path / "stored")
    quantiles.sketches(df, columns, {"day": F.col("day"), "g": F.col("g")}).write.parquet(path)
    stored = spark.read.parquet(path)
    assert stored.count() == 2 * 3 * 2
    got = {(r["g"], r["column"]): (r["cnt"], r["value"])
           for r in quantiles.sketched_quantile(stored, ("g",), 0.9).collect()}
    assert got["a", "none"] == (0, None) == got[None, "none"]
    for g, odd in (("a", 0), (None, 1)):
        mine = sorted(i * 7919 % 60_000 for i in range(odd, 60_000, 2))
        n, value = got[g, "v"]
        assert n == 30_000
        assert abs(sum(v <= value for v in mine) / n - 0.9) <= quantiles.SKETCH_ERROR
    total = quantiles.sketched_quantile(stored.where("day < 2")).collect()
    assert {r["column"]: r["cnt"] for r in total} == {"v": 40_000, "none": 0}
    assert quantiles.sketched_quantile(stored.limit(0)).count() == 0
