"""Every query over the test tables, by name."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolescope.functions.columns import n_rows
from rolescope.operators import (anomalies, buckets, crosstab, evaluate, features, profile,
                                 quality, quantiles, ranking, score, split, summary, temporal,
                                 train)
from rolescope.operators.anomalies import Rule
from rolescope.operators.counts import distribution
from rolescope.plans import sqlreports, views
from rolescope.plans.views import CLASSES, LINES, MODEL, ORDERS
from rolescope.session import scratch_path
from rolescope.sources import conversion, models, reports, tables
from rolescope.sources.schemas import schema_of

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

VALUE_BUCKETS = buckets.Buckets((0, 1.0, 5.0, 10.0, 50.0, 100.0, 250.0, 400.0, 1000.0))
LADDER = [Rule("l_quantity", "=", 0), Rule("l_quantity", "<", 5), Rule("l_quantity", ">", 25),
          Rule("l_quantity", ">", 45), Rule("l_extendedprice", "<", 1000),
          Rule("l_extendedprice", ">", 50000), Rule("l_extendedprice", ">", 100000),
          Rule("discount", "<", 0.05), Rule("discount", ">", 0.08), Rule("tax", "=", 0),
          Rule("tax", ">", 0.05)]
EXTREMES = [Rule("l_quantity", ">", 48), Rule("l_extendedprice", ">", 100000),
            Rule("l_discount", ">", 0.09)]
STATES = ("NATION_0", "NATION_1", "NATION_2", "NATION_3", "NATION_4")
DESCRIPTIONS = {1: "urgent", 2: "high", 3: "medium", 4: "not specified", 5: "low"}
SCORED_AS = "Decision Tree"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# ---- size, schema, values -------------------------------------------------------------------

@query
def row_count(spark, d):
    return profile.row_count(views.orders(spark, d))


@query
def overview(spark, d):
    return profile.overview(views.orders_geo(spark, d), ORDERS)


@query
def overview_approx(spark, d):
    return profile.overview(views.orders_geo(spark, d), ORDERS, approx=True)


@query
def overview_long(spark, d):
    return profile.overview_long(profile.overview(views.orders_geo(spark, d), ORDERS))


@query
def duplicate_keys(spark, d):
    return profile.duplicate_keys(views.lines(spark, d), LINES.id)


@query
def repeated_keys(spark, d):
    return profile.repeated_keys(views.lines(spark, d), LINES.id)


@query
def schema_report(spark, d):
    return profile.schema_report(views.orders(spark, d))


@query
def distinct_values(spark, d):
    return profile.distinct_values(views.events(spark, d), "event_type")


@query
def distinct_summary(spark, d):
    return profile.distinct_summary(views.orders(spark, d), "class")


@query
def preview(spark, d):
    return profile.preview(views.orders(spark, d),
                           ("o_orderkey", "o_orderstatus", "o_totalprice", "class"),
                           ("o_orderkey",))


@query
def table_fingerprint(spark, d):
    return profile.table_fingerprint(views.lines(spark, d), "l_orderkey",
                                     ("l_quantity", "l_extendedprice", "l_tax"))


@query
def content_fingerprint(spark, d):
    return profile.content_fingerprint(views.table(spark, d, "lineitem"))


# ---- classes and crosstabs ------------------------------------------------------------------

@query
def class_distribution(spark, d):
    return distribution(views.orders(spark, d), "class")


def _odd_geo(spark, d):
    """Orders with places, some without a class and some with one off the list."""
    return views.odd_labels(views.orders_geo(spark, d), "o_orderkey")


@query
def class_by_geo_long(spark, d):
    return crosstab.crosstab_long(views.orders_geo(spark, d), ["n_name"], "class")


@query
def class_by_geo(spark, d):
    return crosstab.crosstab(_odd_geo(spark, d), "n_name", "class", CLASSES)


@query
def class_by_geo_top(spark, d):
    return crosstab.crosstab(_odd_geo(spark, d), "n_name", "class", CLASSES, top=15)


@query
def crosstab_row_pct(spark, d):
    table = crosstab.crosstab(views.odd_labels(views.orders(spark, d), "o_orderkey"),
                              "o_orderstatus", "class", CLASSES)
    return crosstab.row_percent(table, "o_orderstatus", CLASSES)


@query
def year_by_class(spark, d):
    cube = temporal.time_cube(views.orders(spark, d), "o_orderdate", ("class",))
    return crosstab.crosstab(cube, "year", "class", CLASSES, weight="cnt", with_total=False)


@query
def topk_then_crosstab(spark, d):
    return crosstab.top_crosstab(_odd_geo(spark, d), "n_name", "class", CLASSES, 10)


@query
def topk_members_long(spark, d):
    lines = ranking.rows_in_top(views.events(spark, d), "action", 3)
    return crosstab.crosstab_long(lines, ["action"], "class")


@query
def flag_class_share(spark, d):
    return crosstab.class_within_flags(views.lines_orders(spark, d), LINES.flags, "class")


# ---- calendar -------------------------------------------------------------------------------

@query
def time_parts(spark, d):
    return temporal.time_parts(views.events(spark, d), "ts", ("event_id",))


@query
def by_year(spark, d):
    return temporal.by_part(views.orders(spark, d), "year", time="o_orderdate")


@query
def by_month(spark, d):
    return temporal.by_part(views.orders(spark, d), "month", time="o_orderdate")


@query
def by_dow(spark, d):
    return temporal.by_part(views.events(spark, d), "dow", time="ts")


@query
def by_hour(spark, d):
    return temporal.by_part(views.events(spark, d), "hour", time="ts")


@query
def by_hour_known(spark, d):
    return temporal.by_part(views.events(spark, d), "hour", time="trusted_ts",
                            denominator="non_null")


@query
def by_hour_nulls(spark, d):
    return temporal.by_part_both_shares(views.events(spark, d), "hour", "trusted_ts")


@query
def time_grouping_sets(spark, d):
    return temporal.all_parts(temporal.time_cube(views.events(spark, d), "ts"))


@query
def weekday_weekend(spark, d):
    return temporal.weekday_weekend(views.events(spark, d), "ts")


@query
def peak_hour(spark, d):
    return temporal.peak(temporal.by_part(views.events(spark, d), "hour", time="ts"), "hour")


@query
def yoy_growth(spark, d):
    return temporal.year_over_year(views.orders(spark, d), "o_orderdate")


# ---- ranking --------------------------------------------------------------------------------

@query
def topk_state(spark, d):
    return ranking.top_groups(views.orders_geo(spark, d), ["n_name"], 10)


@query
def topk_city(spark, d):
    return ranking.top_groups(views.orders_geo(spark, d), ["c_mktsegment", "n_name"], 20)


@query
def topk_county(spark, d):
    return ranking.top_groups(views.orders_geo(spark, d), ["r_name", "n_name"], 20)


@query
def topk_condition(spark, d):
    return ranking.top_groups(views.events(spark, d), ["action"], 3, keep_null=False)


@query
def group_coverage(spark, d):
    return ranking.coverage(views.orders_geo(spark, d), "n_name")


@query
def cumulative_share(spark, d):
    return ranking.cumulative_share(views.orders_geo(spark, d), "n_name", 10)


@query
def top_values(spark, d):
    return ranking.top_values(views.lines(spark, d), "l_quantity")


# ---- SQL reports ----------------------------------------------------------------------------

@query
def sql_state(spark, d):
    return sqlreports.rows_by_state(views.orders_geo(spark, d), ORDERS)


@query
def sql_class_share(spark, d):
    return sqlreports.class_share(views.orders(spark, d), ORDERS)


@query
def sql_top_cities(spark, d):
    return sqlreports.top_cities(views.orders_geo(spark, d), ORDERS)


@query
def sql_year(spark, d):
    return sqlreports.rows_by_year(views.orders(spark, d), ORDERS)


@query
def sql_class_by_geo(spark, d):
    return sqlreports.class_by_state(_odd_geo(spark, d), ORDERS)


@query
def sql_in_list_crosstab(spark, d):
    return sqlreports.class_in_states(views.orders_geo(spark, d), ORDERS, STATES)


# ---- numeric and flag summaries -------------------------------------------------------------

@query
def flag_prevalence(spark, d):
    return summary.flag_prevalence(views.lines(spark, d), LINES.flags)


@query
def numeric_summary(spark, d):
    return summary.numeric_summary(views.lines(spark, d), LINES.numeric, exact=True)


@query
def numeric_summary_approx(spark, d):
    return summary.numeric_summary(views.lines(spark, d), LINES.numeric)


@query
def extent_summary(spark, d):
    return summary.numeric_summary(views.orders(spark, d), ("o_totalprice",), exact=True, digits=4)


@query
def extent_by_class(spark, d):
    return summary.summary_by_class(views.orders(spark, d), "o_totalprice", "class", CLASSES,
                                    exact=True)


@query
def extent_by_class_approx(spark, d):
    return summary.summary_by_class(views.orders(spark, d), "o_totalprice", "class", CLASSES)


@query
def extent_buckets(spark, d):
    return buckets.bucket_counts(views.events(spark, d), "value", VALUE_BUCKETS)


@query
def numeric_ranges(spark, d):
    return summary.numeric_ranges(views.lines(spark, d), LINES.numeric)


# ---- missing values, ranges, anomalies ------------------------------------------------------

@query
def null_profile(spark, d):
    return profile.null_profile(views.lines(spark, d),
                                ("l_orderkey", "l_quantity", "discount", "tax", "shipped"))


@query
def null_profile_documents(spark, d):
    return profile.null_profile(views.documents(spark, d),
                                ("doc_id", "text", "lang", "source", "quality", "toxic"))


@query
def null_profile_summary(spark, d):
    return profile.null_profile_summary(null_profile_documents(spark, d))


@query
def blank_profile(spark, d):
    return profile.blank_profile(views.documents(spark, d),
                                 ("text", "lang", "source", "lang_other"))


@query
def null_filter_counts(spark, d):
    return profile.null_filter_counts(views.documents(spark, d), "quality")


@query
def time_range(spark, d):
    return profile.time_range(views.lines_orders(spark, d), LINES)


@query
def order_violations(spark, d):
    return profile.order_violations(views.lines_orders(spark, d), LINES)


@query
def constant_columns(spark, d):
    return profile.constant_columns(views.lines(spark, d),
                                    ("l_quantity", "l_returnflag", "l_linestatus", "never"))


@query
def threshold_ladder(spark, d):
    return anomalies.threshold_ladder(views.lines(spark, d), LADDER)


@query
def sketched_medians(spark, d):
    """Medians by class and of all rows from stored sketches, held against the rows' true ranks."""
    price = F.col("o_totalprice")
    df = views.orders(spark, d)
    path = scratch_path(spark, "sketches")
    quantiles.sketches(df, {"o_totalprice": price}, {
        "class": F.col("class"), "status": F.col("o_orderstatus")}).write.parquet(path)
    stored = spark.read.parquet(path)
    by_class = quantiles.sketched_quantile(stored, ("class",))
    every = quantiles.sketched_quantile(stored).select(F.lit(0).alias("class"), "column", "cnt",
                                                       "value")
    # A row for every class: an array of them travels with the rows, which no join deals by class.
    found = every.unionByName(by_class).agg(F.collect_list(F.struct(
        F.col("class").alias("of"), "value"))).scalar()
    rows = df.select(F.explode(F.array(F.lit(0), F.col("class"))).alias("class"),
                     price.alias("price"), found.alias("found"))
    value = F.element_at(F.filter("found", lambda x: x["of"].eqNullSafe(F.col("class"))), 1)["value"]
    low, high = (F.count_if(c) / F.count("price") for c in (
        F.col("price") < F.col("value"), F.col("price") <= F.col("value")))
    error = quantiles.SKETCH_ERROR
    return rows.select("class", "price", value.alias("value")).groupBy("class").agg(
        F.count("price").alias("cnt"),
        ((low <= 0.5 + error) & (high >= 0.5 - error)).alias("within_error"))


@query
def paired_missingness(spark, d):
    return anomalies.paired_missingness(views.lines(spark, d), {
        "discount_tax": ("discount", "tax"), "tax_shipped": ("tax", "shipped")})


@query
def paired_missingness_labels(spark, d):
    return anomalies.paired_missingness(views.documents(spark, d), {
        "quality_toxic": ("quality", "toxic")})


@query
def extreme_subset(spark, d):
    return anomalies.extreme_counts(views.lines(spark, d), EXTREMES)


@query
def extreme_context(spark, d):
    return anomalies.extreme_context(views.lines(spark, d), EXTREMES,
                                     ("l_returnflag", "l_linenumber"))


# ---- reading, writing, gates ----------------------------------------------------------------

@query
def csv_roundtrip(spark, d):
    source = views.table(spark, d, "orders")
    path = scratch_path(spark, "orders-csv")
    tables.write_csv(source, path)
    return tables.read_csv(spark, path, source.schema)


@query
def parquet_roundtrip(spark, d):
    source = views.table(spark, d, "orders")
    path = scratch_path(spark, "orders-parquet")
    tables.write_parquet(source, path)
    return tables.read_parquet(spark, path)


@query
def partitioned_roundtrip(spark, d):
    source = views.table(spark, d, "events")
    path = scratch_path(spark, "events-parquet")
    tables.write_parquet(source, path, ("event_type",))
    return tables.read_parquet(spark, path).select(*source.columns)


@query
def copy_check(spark, d):
    source = views.table(spark, d, "orders")
    path = scratch_path(spark, "orders-copy")
    tables.convert(spark, source, path, expected_rows=source.count())
    return tables.verify_copy(source, tables.read_parquet(spark, path),
                              content=True).select("check", "passed")


@query
def report_roundtrip(spark, d):
    path = scratch_path(spark, "report")
    reports.write_report(class_by_geo(spark, d), path)
    counters = ", ".join(f"class_{c} bigint" for c in CLASSES)
    return reports.read_report(
        spark, path, f"n_name string, {counters}, class_other bigint, total bigint")


@query
def footprint(spark, d):
    return tables.footprint(spark, f"{d.rstrip('/')}/lineitem.parquet")


@query
def incremental_conversion(spark, d):
    """Four runs on a growing folder: first files, no change, a second lot, the first gone."""
    orders = views.table(spark, d, "orders")
    source, path = scratch_path(spark, "orders-in"), scratch_path(spark, "orders-converted")
    steps = []

    def run(step):
        done = conversion.convert_files(
            spark, source, path, lambda files: spark.read.schema(orders.schema).parquet(*files))
        steps.append(conversion.read_converted(spark, path, orders.schema).agg(
            F.lit(step).alias("step"), F.lit(done.rows).cast("bigint").alias("converted"),
            n_rows().alias("table_rows"), F.sum("o_orderkey").alias("key_sum")))

    tables.write_parquet(orders.where("o_orderkey % 3 = 0"), f"{source}/a")
    run(1)
    run(2)
    tables.write_parquet(orders.where("o_orderkey % 3 = 1"), f"{source}/b")
    run(3)
    tables.write_parquet(orders.limit(0), f"{source}/a")
    run(4)
    return reduce(DataFrame.unionByName, steps)


@query
def head_in_file_order(spark, d):
    """The first rows as they stand in a table of many files, written in key order."""
    path = scratch_path(spark, "orders-sorted")
    orders = views.table(spark, d, "orders")
    tables.write_parquet(orders.repartitionByRange(12, "o_orderkey")
                         .sortWithinPartitions("o_orderkey"), path)
    return tables.head_rows(tables.read_parquet(spark, path), 200).select(
        "o_orderkey", "o_orderstatus")


@query
def input_guard(spark, d):
    """A report on a guarded copy, and whether a second copy beside it is noticed."""
    path = scratch_path(spark, "guarded")
    tables.write_parquet(views.table(spark, d, "orders"), path)
    with tables.unchanged(spark, path) as before:
        found = distribution(tables.read_parquet(spark, path), "o_orderstatus").select(
            "o_orderstatus", "cnt")
        same = tables.changed_files(before, tables.manifest(spark, path)).count()
    tables.write_parquet(views.table(spark, d, "orders"), path + "-again")
    moved = tables.changed_files(before, tables.manifest(spark, path, path + "-again")).count()
    return views.orders(spark, d).groupBy("o_orderstatus").count().join(
        found, "o_orderstatus").select("o_orderstatus", "cnt", F.lit(same == 0).alias("unchanged"),
                                       F.lit(moved > 0).alias("noticed"))


@query
def line_reconciliation(spark, d):
    source = views.table(spark, d, "lineitem")
    path = scratch_path(spark, "lines-csv")
    tables.write_csv(source, path)
    return tables.line_reconciliation(spark, path, source.schema)


@query
def parse_audit(spark, d):
    """Orders as text, read back with the strict time pattern: fractions, padding, odd flags."""
    source = views.table(spark, d, "orders")
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    text = source.select(
        F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("string"),
        F.when(F.col("o_orderstatus") == "P", F.concat(stamp, F.lit(".000000000")))
        .otherwise(stamp).alias("strict_time"), stamp.alias("plain_time"),
        F.col("o_orderpriority").alias("priority_number"),
        F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit(" "), "o_custkey"))
        .otherwise(F.col("o_custkey").cast("string")).alias("padded_number"),
        F.when(F.col("o_orderstatus") == "F", "yes").when(F.col("o_orderstatus") == "O", "1")
        .otherwise("true").alias("word_flag"))
    path = scratch_path(spark, "orders-text")
    tables.write_csv(text, path)
    schema = schema_of({"o_orderkey": "bigint", "o_totalprice": "double",
                        "strict_time": "timestamp", "plain_time": "timestamp",
                        "priority_number": "int", "padded_number": "bigint",
                        "word_flag": "boolean"})
    return tables.audit_csv(spark, path, schema, (tables.STRICT_TIME,))


@query
def quality_report(spark, d):
    df = views.orders(spark, d)
    return quality.quality_report(df, [
        quality.expect_rows_like(views.table(spark, d, "orders")),
        quality.expect_columns(df, 7),
        quality.expect_type(df, "o_orderdate", "timestamp_ntz"),
        quality.expect_unique(df, ORDERS.id),
        quality.expect_no_nulls("o_orderdate"),
        quality.expect_some_values("o_totalprice"),
        quality.expect_classes_cover("class", CLASSES),
        quality.expect_classes_cover("class", CLASSES[:4])])


@query
def flag_quality(spark, d):
    """Which flags show true as well as false, all from one aggregate."""
    return quality.quality_report(views.lines(spark, d), [
        quality.expect_both_flags(f) for f in ("is_returned", "is_open", "bulk", "never")])


@query
def union_all_reports(spark, d):
    def keyed(df, key):
        return df.select(F.col(key).cast("string").alias("key"), "cnt")
    return reports.union_reports({
        "order_class": keyed(distribution(views.orders(spark, d), "class"), "class"),
        "event_type": keyed(distribution(views.events(spark, d), "event_type"), "event_type")})


# ---- features and splits --------------------------------------------------------------------

@query
def role_audit(spark, d):
    df = views.model_rows(spark, d)
    return features.role_audit(df, MODEL).drop("min_value", "max_value")


@query
def feature_frame(spark, d):
    spec = features.FeatureSpec(LINES.but(numeric=("l_quantity", "discount", "tax"),
                                          start_time="shipped", categorical=("returned_as",)))
    df = views.lines_orders(spark, d).withColumn(
        "returned_as", F.nullif(F.col("l_returnflag"), F.lit("N")))
    return features.feature_frame(df, spec, LINES.id)


@query
def split_counts(spark, d):
    return split.split_counts(split.with_split(views.orders(spark, d), ORDERS.id))


@query
def split_class_distribution(spark, d):
    return split.split_class_distribution(
        split.with_split(views.orders(spark, d), ORDERS.id), "class")


def _train_side(spark, d):
    return split.with_split(views.orders(spark, d), ORDERS.id).where(F.col("split") == "train")


@query
def class_weights(spark, d):
    return split.class_weights(_train_side(spark, d), "class", CLASSES)


@query
def weighted_rows(spark, d):
    train_side = _train_side(spark, d)
    weights = split.class_weights(train_side, "class", CLASSES)
    return split.with_class_weight(train_side, weights, "class").select(
        "o_orderkey", "class", "class_weight")


@query
def impute_median(spark, d):
    lines = views.lines(spark, d)
    train_side = split.with_split(lines, ("l_orderkey",)).where(F.col("split") == "train")
    return features.impute_median(lines, "tax", train_side,
                                  ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))


@query
def category_index(spark, d):
    return features.category_index(views.events(spark, d), "event_type")


@query
def category_index_wide(spark, d):
    """A key column with as many categories as parts: no limit, no single task."""
    parts = views.lines(spark, d).withColumn("part", F.col("l_partkey").cast("string"))
    return features.category_index(parts, "part")


# ---- evaluation of rule models --------------------------------------------------------------

def _rule_predictions(spark, d):
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    return views.orders(spark, d).select(
        "class",
        F.when(price <= 100000, 1).when(price <= 200000, 2).when(price <= 300000, 3)
        .when(price <= 400000, 4).otherwise(5).alias("by_price"),
        F.when(status == "F", 1).when(status == "O", 3).otherwise(5).alias("by_status"))


def _rule_confusion(spark, d, *names):
    return evaluate.confusion_matrix(_rule_predictions(spark, d), "class",
                                     {n: n for n in names}, CLASSES)


@query
def confusion_matrix(spark, d):
    return _rule_confusion(spark, d, "by_price", "by_status")


@query
def per_class_metrics(spark, d):
    return evaluate.per_class_metrics(_rule_confusion(spark, d, "by_price", "by_status"))


@query
def summary_metrics(spark, d):
    return evaluate.summary_metrics(_rule_confusion(spark, d, "by_status"))


@query
def model_comparison(spark, d):
    return evaluate.summary_metrics(_rule_confusion(spark, d, "by_price", "by_status"))


@query
def best_model(spark, d):
    return evaluate.best_model(model_comparison(spark, d))


# ---- trained models -------------------------------------------------------------------------

def _metrics(spark, d, name):
    """What a fit must satisfy whatever it has learned: sizes, class supports, gates, ranges."""
    trained = train.train_and_evaluate(views.model_rows(spark, d), MODEL, MODEL.roles.id,
                                       {name: {}})
    m = trained.comparison().first()
    classes = {r["class"]: r for r in trained.per_class().collect()}
    row = (name, trained.train_rows, trained.test_rows, trained.unlabelled,
           *[classes[c]["support"] for c in CLASSES],
           all(expected == actual for _, expected, actual in trained.gates),
           abs(m["weighted_recall"] - m["accuracy"]) < 1e-9,
           all(0 <= m[k] <= 1 for k in ("accuracy", "weighted_precision", "weighted_f1",
                                        "macro_f1")),
           len(trained.models[name].stages) > 1)
    trained.release()
    supports = ", ".join(f"support_{c} bigint" for c in CLASSES)
    return spark.createDataFrame([row], (
        f"model string, train_rows bigint, test_rows bigint, unlabelled bigint, {supports}, "
        "gates_passed boolean, recall_is_accuracy boolean, metrics_in_range boolean, "
        "has_preprocessing boolean"))


@query
def ml_logistic(spark, d):
    return _metrics(spark, d, "Logistic Regression")


@query
def ml_tree(spark, d):
    return _metrics(spark, d, "Decision Tree")


@query
def ml_forest(spark, d):
    return _metrics(spark, d, "Random Forest")


def _scored(spark, d):
    """All rows scored by a model that went through its saved form."""
    fitted = train.train_only(views.model_rows(spark, d), MODEL, MODEL.roles.id, {SCORED_AS: {}})
    path = scratch_path(spark, "model")
    models.save_model(fitted[SCORED_AS], path)
    return score.score(views.model_rows(spark, d), models.load_model(path), MODEL,
                       MODEL.roles.id, DESCRIPTIONS)


def _score_checks(scored):
    """Whether each row's probabilities add up to one and its class is listed and most likely."""
    p = [F.col(f"p_{c}") for c in CLASSES]
    return {
        "sums_to_one": F.bool_and(F.abs(sum(p[1:], p[0]) - 1) < 0.001),
        "class_listed": F.bool_and(F.col("predicted_class").isin(*CLASSES)),
        "most_likely": F.bool_and(F.abs(F.greatest(*p) * 100 - F.col("confidence_pct")) <= 0.011),
        "described": F.bool_and(F.col("description").isNotNull())}


@query
def score_batch(spark, d):
    scored = _scored(spark, d)
    return scored.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("key_sum"),
        *[c.alias(n) for n, c in _score_checks(scored).items()])


@query
def scored_sample(spark, d):
    sample = score.sample(_scored(spark, d), MODEL.roles.id)
    listed = F.col("predicted_class").isin(*CLASSES)
    return sample.select(*MODEL.roles.id, listed.alias("class_listed"))
