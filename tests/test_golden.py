"""Published results of the incident table, re-derived from its published counts."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rolescope.functions.columns import pct, ratio
from rolescope.operators import ranking, temporal
from rolescope.operators.counts import distribution

TOTAL = 7_728_394
NO_TIME = 743_166

# Published (key, count, percentage) rows.
CLASSES = [(1, 67366, 0.87), (2, 6156981, 79.67), (3, 1299337, 16.81), (4, 204710, 2.65)]
YEARS = [(2016, 410821, 5.32), (2017, 717290, 9.28), (2018, 893426, 11.56), (2019, 954302, 12.35),
         (2020, 1161598, 15.03), (2021, 1412433, 18.28), (2022, 1268806, 16.42),
         (2023, 166552, 2.16)]
MONTHS = [(1, "Jan", 652682, 8.45), (2, "Feb", 585606, 7.58), (3, "Mar", 501362, 6.49),
          (4, "Apr", 526210, 6.81), (5, "May", 505614, 6.54), (6, "Jun", 524750, 6.79),
          (7, "Jul", 463263, 5.99), (8, "Aug", 547206, 7.08), (9, "Sep", 593815, 7.68),
          (10, "Oct", 630325, 8.16), (11, "Nov", 695612, 9.0), (12, "Dec", 758783, 9.82)]
DAYS = [(1, "Sunday", 490115, 6.34), (2, "Monday", 1108807, 14.35), (3, "Tuesday", 1177923, 15.24),
        (4, "Wednesday", 1195864, 15.47), (5, "Thursday", 1196137, 15.48),
        (6, "Friday", 1237229, 16.01), (7, "Saturday", 579153, 7.49)]
BUCKETS = [("0", 3302161, 42.73), ("0 - 0.1", 1185298, 15.34), ("0.1 - 0.5", 1389805, 17.98),
           ("0.5 - 1.0", 740906, 9.59), ("1.0 - 5.0", 965010, 12.49),
           ("5.0 - 10.0", 109696, 1.42), ("10.0 - 25.0", 30833, 0.4), ("25+", 4685, 0.06)]
FLAGS = [("Traffic_Signal", 1143772, 14.8), ("Crossing", 873763, 11.306),
         ("Junction", 571342, 7.393), ("Stop", 214371, 2.774), ("Station", 201901, 2.612),
         ("Amenity", 96334, 1.246), ("Railway", 66979, 0.867), ("Give_Way", 36582, 0.473),
         ("No_Exit", 19545, 0.253), ("Traffic_Calming", 7598, 0.098), ("Bump", 3514, 0.045),
         ("Roundabout", 249, 0.003), ("Turning_Loop", 0, 0.0)]
JUNCTION = [(2, 415139, 72.66), (4, 20580, 3.6), (3, 132496, 23.19), (1, 3127, 0.55)]
# (model, precision, recall, F1, support) per class, and accuracy and macro F1 per model.
PER_CLASS = [
    ("LR", 0.0348, 0.805, 0.0667, 13357), ("LR", 0.9161, 0.3826, 0.5398, 1231876),
    ("LR", 0.3633, 0.5617, 0.4413, 259571), ("LR", 0.0699, 0.5508, 0.124, 40674),
    ("DT", 0.1394, 0.9357, 0.2426, 13357), ("DT", 0.9631, 0.405, 0.5702, 1231876),
    ("DT", 0.3986, 0.7148, 0.5118, 259571), ("DT", 0.0748, 0.8685, 0.1377, 40674),
    ("RF", 0.0573, 0.8873, 0.1076, 13357), ("RF", 0.9589, 0.319, 0.4787, 1231876),
    ("RF", 0.3666, 0.6101, 0.458, 259571), ("RF", 0.0699, 0.8537, 0.1293, 40674)]
SUMMARY = {"LR": (0.4208, 0.293), "DT": (0.4738, 0.3656), "RF": (0.3869, 0.2934)}


def test_class_shares(spark):
    df = spark.createDataFrame([r[:2] for r in CLASSES], "c int, n bigint")
    assert rows(distribution(df, "c", weight="n")) == CLASSES


@pytest.mark.parametrize("part,published", [("year", YEARS), ("month", MONTHS), ("dow", DAYS)])
def test_calendar_shares_divide_by_all_rows(spark, part, published):
    counts = [(r[0], r[-2]) for r in published] + [(None, NO_TIME)]
    df = spark.createDataFrame(counts, f"{part} bigint, n bigint")
    assert rows(temporal.by_part(df, part, weight="n")) == published
    known = temporal.by_part(df, part, weight="n", denominator="non_null")
    assert abs(known.agg(F.sum("pct")).first()[0] - 100) < 0.05


@pytest.mark.parametrize("published,total,digits", [
    (BUCKETS, TOTAL, 2), (FLAGS, TOTAL, 3), (JUNCTION, 571342, 2)])
def test_other_shares(spark, published, total, digits):
    df = spark.createDataFrame([(str(r[0]), r[1]) for r in published], "k string, n bigint")
    got = rows(df.select("k", "n", pct(F.col("n"), F.lit(total), digits)))
    assert got == [(str(k), n, p) for k, n, p in published]


def test_growth_from_published_years(spark):
    df = spark.createDataFrame([r[:2] for r in YEARS], "year bigint, n bigint")
    growth = [r["growth_pct"] for r in temporal.year_over_year(df, weight="n").collect()]
    counts = [r[1] for r in YEARS]
    assert growth == [None] + [round((b - a) / a * 100, 2) for a, b in zip(counts, counts[1:])]


def test_top_groups_from_published_counts(spark):
    df = spark.createDataFrame([("CA", 1741433), ("FL", 880192), ("TX", 582837),
                                ("rest", TOTAL - 3_204_462)], "s string, n bigint")
    assert rows(ranking.top_groups(df, ["s"], 4, weight="n"))[1:3] == [
        ("CA", 1741433, 22.53), ("FL", 880192, 11.39)]


def test_model_metrics_are_consistent(spark):
    """F1 follows from precision and recall; weighted recall is the accuracy."""
    df = spark.createDataFrame(PER_CLASS, "m string, p double, r double, f double, n bigint")
    f1 = ratio(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r"))
    assert df.where(F.abs(f1 - F.col("f")) > 3e-4).count() == 0
    per_model = df.groupBy("m").agg(
        ratio(F.sum(F.col("r") * F.col("n")), F.sum("n")).alias("accuracy"),
        F.avg("f").alias("macro"))
    for r in per_model.collect():
        assert abs(r["accuracy"] - SUMMARY[r["m"]][0]) < 2e-4
        assert abs(r["macro"] - SUMMARY[r["m"]][1]) < 2e-4
