"""The batch jobs: ingest, profile, anomalies, analytics, training, scoring.

Each job is given a table and its description and writes small report tables. Reports that share
grouping columns are rolled up from one persisted aggregate, and global counters are folded into
one (``one_pass``): profile and anomalies scan their table three times each.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rolescope.functions.columns import n_rows, ref
from rolescope.operators import (anomalies, buckets, crosstab, profile, quality, ranking, score,
                                 summary, temporal)
from rolescope.operators.anomalies import Rule
from rolescope.operators.buckets import Buckets
from rolescope.operators.counts import distribution
from rolescope.operators.features import FeatureSpec
from rolescope.operators.onepass import one_pass
from rolescope.operators.quality import Check
from rolescope.operators.train import Trained, train_and_evaluate
from rolescope.plans import sqlreports
from rolescope.roles import Roles
from rolescope.sources import models, reports, tables

Reports = dict[str, DataFrame]


def write_all(tables_by_name: Reports, out: str) -> None:
    """One CSV folder per report below ``out``."""
    for name, df in tables_by_name.items():
        reports.write_report(df, f"{out.rstrip('/')}/{name}")


def ingest(spark: SparkSession, csv: str, parquet: str, schema: StructType, *,
           expected_rows: int | None = None, partition_by: tuple[str, ...] = ()) -> bool:
    """Convert a CSV to verified Parquet, reusing a target that already matches.

    The input's files are compared before and after. Rows are counted while they are written.
    """
    with tables.unchanged(spark, csv):
        source = tables.read_csv(spark, csv, schema)
        return tables.convert(spark, source, parquet, expected_rows=expected_rows,
                              partition_by=partition_by)


def ingest_reports(spark: SparkSession, csv: str, schema: StructType) -> Reports:
    """What the raw file holds: size, schema, line reconciliation, values lost to parsing."""
    typed = tables.read_csv(spark, csv, schema)
    return {"footprint": tables.footprint(spark, csv), "schema": profile.schema_report(typed),
            "line_reconciliation": tables.line_reconciliation(spark, csv, schema),
            "parse_audit": tables.audit_csv(spark, csv, schema)}


def profile_reports(df: DataFrame, roles: Roles, profiled: tuple[str, ...],
                    text: tuple[str, ...], ranged: tuple[str, ...]) -> Reports:
    """Twelve reports from three scans: all global counters, groups, and keys."""
    made = one_pass(df, {
        "row_count": profile.row_count,
        "null_profile": lambda t: profile.null_profile(t, profiled),
        "blank_profile": lambda t: profile.blank_profile(t, text),
        "time_range": lambda t: profile.time_range(t, roles),
        "order_violations": lambda t: profile.order_violations(t, roles),
        "numeric_ranges": lambda t: summary.numeric_ranges(t, ranged),
        "constant_columns": lambda t: profile.constant_columns(t, roles.flags),
    })
    groups = df.groupBy(ref(roles.label), ref(roles.state)).agg(n_rows().alias("cnt")).persist(
        StorageLevel.MEMORY_AND_DISK)
    return made | {
        "null_profile_summary": profile.null_profile_summary(made["null_profile"]),
        "class_distribution": distribution(groups, roles.label, weight="cnt"),
        "class_values": profile.distinct_summary(groups, roles.label),
        "coverage": ranking.coverage(groups, roles.state, weight="cnt"),
        "duplicate_keys": profile.duplicate_keys(df, roles.id),
    }


def anomaly_reports(df: DataFrame, ladder: list[Rule], pairs: dict[str, tuple[str, str]],
                    extremes: list[Rule], context: tuple[str, ...]) -> Reports:
    """Five reports from three scans: all counters, the highest values, the extremes' context."""
    return one_pass(df, {
        "threshold_ladder": lambda t: anomalies.threshold_ladder(t, ladder),
        "paired_missingness": lambda t: anomalies.paired_missingness(t, pairs),
        "extreme_counts": lambda t: anomalies.extreme_counts(t, extremes, prefilter=False),
    }) | {
        "top_values": ranking.top_values(df, ladder[0].column),
        "extreme_context": anomalies.extreme_context(df, extremes, context),
    }


@contextmanager
def analytics_reports(df: DataFrame, roles: Roles, histogram: Buckets,
                      focus_flags: tuple[str, ...]) -> Iterator[Reports]:
    """All distribution reports of a table; the shared aggregates live inside the ``with``.

    Three aggregates feed fourteen reports: rows per calendar slot and class (bounded by the
    calendar), per place and class, per condition and class. They are persisted, not collected;
    losing an executor only recomputes its part of them.
    """
    label, classes = roles.label, roles.label_values
    slots = temporal.time_cube(df, roles.start_time, (label,)).persist(
        StorageLevel.MEMORY_AND_DISK)
    places = (df.groupBy(*map(ref, (roles.state, roles.county, roles.city, label)))
              .agg(n_rows().alias("cnt")).persist(StorageLevel.MEMORY_AND_DISK))
    conditions = (df.groupBy(ref(roles.condition), ref(label)).agg(n_rows().alias("cnt"))
                  .persist(StorageLevel.MEMORY_AND_DISK))
    top_conditions = ranking.top_groups(conditions, [roles.condition], 15, keep_null=False,
                                        weight="cnt")
    condition_classes = crosstab.crosstab(
        conditions.where(ref(roles.condition).isNotNull()), roles.condition, label, classes,
        weight="cnt", top=10)
    wide = profile.overview(df, roles).persist()
    made = {
        "quality": quality.quality_report(wide, [
            Check("unique_ids", F.max("total_rows"), F.max("distinct_ids"))]).unionByName(
            quality.quality_report(slots, [
                Check("classes_cover", F.sum("cnt"),
                      F.sum(F.when(ref(label).isin(*classes), F.col("cnt"))))])),
        "overview": profile.overview_long(wide),
        "class_distribution": distribution(slots, label, weight="cnt"),
        "class_by_state": crosstab.crosstab(places, roles.state, label, classes, weight="cnt"),
        "by_year": temporal.by_part(slots, "year", weight="cnt"),
        "year_over_year": temporal.year_over_year(slots, weight="cnt"),
        "by_month": temporal.by_part(slots, "month", weight="cnt"),
        "by_day_of_week": temporal.by_part(slots, "dow", weight="cnt"),
        "by_hour": temporal.by_part(slots, "hour", weight="cnt"),
        "year_by_class": crosstab.crosstab(slots, "year", label, classes, weight="cnt",
                                           with_total=False),
        "top_states": ranking.top_groups(places, [roles.state], 10, weight="cnt"),
        "top_cities": ranking.top_groups(places, [roles.city, roles.state], 20, weight="cnt"),
        "top_counties": ranking.top_groups(places, [roles.county, roles.state], 20, weight="cnt"),
        "top_conditions": top_conditions,
        "condition_by_class": condition_classes,
        "condition_class_percent": crosstab.row_percent(condition_classes, roles.condition,
                                                        classes),
        "flag_by_class": crosstab.class_within_flags(df, focus_flags, label),
        "extent_by_class": summary.summary_by_class(df, roles.extent, label, classes),
    } | one_pass(df, {
        "numeric_summary": lambda t: summary.numeric_summary(t, roles.numeric),
        "flag_prevalence": lambda t: summary.flag_prevalence(t, roles.flags),
        "extent_summary": lambda t: summary.numeric_summary(t, (roles.extent,), digits=4),
        "extent_buckets": lambda t: buckets.bucket_counts(t, roles.extent, histogram),
    })
    try:
        yield made
    finally:
        for shared in (slots, places, conditions, wide):
            shared.unpersist()


def sql_reports(df: DataFrame, roles: Roles) -> Reports:
    return {
        "sql_state": sqlreports.rows_by_state(df, roles),
        "sql_class_share": sqlreports.class_share(df, roles),
        "sql_top_cities": sqlreports.top_cities(df, roles),
        "sql_year": sqlreports.rows_by_year(df, roles),
        "sql_class_by_state": sqlreports.class_by_state(df, roles),
    }


def analytics(df: DataFrame, roles: Roles, histogram: Buckets, focus_flags: tuple[str, ...],
              out: str) -> None:
    """Check the table (unique ids, listed classes), then write all distribution reports.

    The checks read the overview and the calendar aggregate, which the reports need anyway. The
    files of the input are compared before and after; no column is read for it.
    """
    with tables.unchanged(df.sparkSession, *inputs(df)):
        with analytics_reports(df, roles, histogram, focus_flags) as made:
            quality.require(made["quality"])
            write_all(made, out)
        write_all(sql_reports(df, roles), out)


def inputs(df: DataFrame) -> list[str]:
    """The folders that hold the files a table is read from (the files' parents, once each)."""
    return sorted({f.rsplit("/", 1)[0] for f in df.inputFiles()})


def training(df: DataFrame, spec: FeatureSpec, ids: tuple[str, ...], out: str,
             models_by_name: dict[str, dict] | None = None,
             partitions: int | None = None) -> Trained:
    """Fit and compare the classifiers; write their metrics and save every pipeline.

    The files of the input are compared before and after.
    """
    with tables.unchanged(df.sparkSession, *inputs(df)):
        trained = train_and_evaluate(df, spec, ids, models_by_name, partitions=partitions)
    write_all({"gates": trained.gate_report(), "model_comparison": trained.comparison(),
               "per_class_metrics": trained.per_class(), "confusion_matrix": trained.confusion}, out)
    for name, model in trained.models.items():
        models.save_model(model, model_path(out, name))
    trained.release()
    return trained


def model_path(out: str, name: str) -> str:
    return f"{out.rstrip('/')}/models/{name.lower().replace(' ', '_')}"


def scoring(df: DataFrame, model_dir: str, spec: FeatureSpec, ids: tuple[str, ...], out: str,
            descriptions: dict[int, str] | None = None) -> None:
    """Score a table with a saved pipeline and write the result as Parquet."""
    model = models.load_model(model_dir)
    tables.write_parquet(score.score(df, model, spec, ids, descriptions), out)
