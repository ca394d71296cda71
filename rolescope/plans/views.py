"""Role views over the star-schema test tables.

Each view selects only what its roles need and keeps every fact row, also one without a dimension
row; joins to the dimension tables are left to Spark, which
broadcasts a side only when its size is below the configured threshold and otherwise merges
sorted partitions, splitting skewed ones adaptively.

The test tables hold almost no NULLs, so views derive them from the meaning of the data: a zero
discount is "none recorded", an open line has neither a final tax nor a shipping time, the clock
of an error event is not trusted, and most documents have no labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolescope.operators.features import FeatureSpec
from rolescope.roles import Roles
from rolescope.session import pin_utc

CLASSES = (1, 2, 3, 4, 5)
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")

ORDERS = Roles(id=("o_orderkey",), label="class", label_values=CLASSES, start_time="o_orderdate",
               state="n_name", county="r_name", city="c_mktsegment", condition="o_orderstatus",
               extent="o_totalprice", numeric=("o_totalprice", "c_acctbal"))

LINES = Roles(id=("l_orderkey", "l_linenumber"), label="class", label_values=CLASSES,
              start_time="o_orderdate", end_time="l_shipdate", condition="l_returnflag",
              extent="l_extendedprice",
              numeric=("l_quantity", "l_extendedprice", "discount", "tax"),
              flags=("is_returned", "is_open", "full_price", "bulk", "never"),
              categorical=("l_returnflag", "l_linestatus"))

EVENTS = Roles(id=("event_id",), label="class", label_values=CLASSES, start_time="ts",
               condition="event_type", extent="value", numeric=("value",))

# What a model of the order class may and may not see.
MODEL = FeatureSpec(Roles(
    id=("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), label="class",
    label_values=CLASSES, start_time="o_orderdate",
    numeric=("l_quantity", "l_extendedprice", "discount", "tax", "p_retailprice"),
    categorical=("l_returnflag", "l_linestatus", "p_brand", "p_type"),
    flags=("is_returned", "is_open", "full_price", "bulk"),
    forbidden=("class", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_orderdate",
               "l_shipdate", "shipped", "l_discount", "l_tax", "never")))


# The same with about as many one-hot slots as the incident model has, for timing fits.
WIDE_MODEL = FeatureSpec(MODEL.roles.but(
    categorical=("l_returnflag", "l_linestatus", "p_brand", "p_type", "p_name", "p_size",
                 "n_name", "r_name", "c_mktsegment", "o_orderstatus"),
    forbidden=(*MODEL.roles.forbidden, "o_orderpriority")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.substring("o_orderpriority", 1, 1).cast("int")
    return table(spark, sf_dir, "orders").withColumn("class", priority)


def odd_labels(df: DataFrame, key: str) -> DataFrame:
    """The same rows, some without a class and some with one that is not listed."""
    odd = F.when(F.col(key) % 7 == 0, F.lit(None)).when(F.col(key) % 11 == 0, 99)
    return df.withColumn("class", odd.otherwise(F.col("class")).cast("int"))


def orders_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the customer's nation, region and market segment."""
    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    place = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left") \
                  .select("n_nationkey", "n_name", "r_name")
    who = customer.join(place, F.col("c_nationkey") == F.col("n_nationkey"), "left") \
                  .select("c_custkey", "c_acctbal", "c_mktsegment", "n_name", "r_name")
    return (orders(spark, sf_dir).join(who, F.col("o_custkey") == F.col("c_custkey"), "left")
            .drop("c_custkey"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = F.col("l_linestatus") == "F"
    return table(spark, sf_dir, "lineitem").withColumns({
        "discount": F.nullif(F.col("l_discount"), F.lit(0.0)),
        "tax": F.when(closed, F.col("l_tax")),
        "shipped": F.when(closed, F.col("l_shipdate")),
        "is_returned": F.col("l_returnflag") == "R",
        "is_open": ~closed,
        "full_price": F.col("l_discount") == 0,
        "bulk": F.col("l_quantity") > 40,
        "never": F.col("l_quantity") < 0,
    })


def lines_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with the class and date of their order."""
    header = orders(spark, sf_dir).select("o_orderkey", "o_orderdate", "class")
    return lines(spark, sf_dir).join(header, F.col("l_orderkey") == F.col("o_orderkey"), "left") \
                               .drop("o_orderkey")


def model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with order class and part attributes."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_retailprice")
    return lines_orders(spark, sf_dir).join(parts, F.col("l_partkey") == F.col("p_partkey"), "left") \
                                      .drop("p_partkey")


def wide_model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with order, customer and part attributes."""
    parts = table(spark, sf_dir, "part").withColumn("p_size", F.col("p_size").cast("string"))
    header = orders_geo(spark, sf_dir).drop("o_custkey", "o_totalprice", "c_acctbal")
    return (lines(spark, sf_dir)
            .join(header, F.col("l_orderkey") == F.col("o_orderkey"), "left").drop("o_orderkey")
            .join(parts, F.col("l_partkey") == F.col("p_partkey"), "left").drop("p_partkey"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array(*[F.lit(t) for t in EVENT_TYPES])
    return table(spark, sf_dir, "events").withColumns({
        "class": F.array_position(kinds, F.col("event_type")).cast("int"),
        "trusted_ts": F.when(F.col("event_type") != "error", F.col("ts")),
        "action": F.nullif(F.col("event_type"), F.lit("view")),
    })


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels where they have any."""
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "labelled_id")
    return (table(spark, sf_dir, "documents")
            .join(labels, F.col("doc_id") == F.col("labelled_id"), "left").drop("labelled_id")
            .withColumn("lang_other", F.when(F.col("lang") == "en", "").otherwise(F.col("lang"))))
