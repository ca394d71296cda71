"""Plans must scale: pruned, filtered scans, one pass per report, no cross products or Python."""

from __future__ import annotations

import re

import pytest
from pyspark.sql.classic.dataframe import DataFrame

from rolescope.operators import quantiles, ranking
from rolescope.plans import views
from rolescope.plans.catalog import QUERIES

FITTED = {"ml_logistic", "ml_tree", "ml_forest", "score_batch", "scored_sample"}
EXACT_MEDIANS = {"numeric_summary", "extent_summary", "extent_by_class", "impute_median"}


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df) -> str:
    """The final adaptive plan of the query and of its subqueries."""
    df.collect()
    kept, skipping, depth = [], False, 0
    for line in planned(df).splitlines():
        indent = len(line) - len(line.lstrip(" :+-"))
        if "== Initial Plan ==" in line:
            skipping, depth = True, line.index("==")
        elif skipping and indent < depth:
            skipping = False
        if not skipping:
            kept.append(line)
    return "\n".join(kept)


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    return {n: planned(q(spark, sf_dir)) for n, q in QUERIES.items() if n not in FITTED}


def test_no_cross_products_and_no_python(plans):
    for name, plan in plans.items():
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "InPandas",
                     "BatchEvalPython", "ArrowEvalPython", "collect_set"):
            assert word not in plan, (name, word)


@pytest.mark.parametrize("name", [
    "flag_prevalence", "numeric_summary_approx", "threshold_ladder", "paired_missingness",
    "null_profile", "numeric_ranges", "constant_columns", "extent_buckets"])
def test_single_scan_per_report(plans, name):
    assert plans[name].count("FileScan") == 1


def test_single_shuffle_crosstab(plans):
    """One exchange for the groups and one for the final order."""
    assert plans["crosstab_row_pct"].count("Exchange") == 2


def test_scans_read_only_what_they_need(plans):
    assert "ReadSchema: struct<o_orderpriority:string>" in plans["class_distribution"]
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plans["by_hour"]
    assert re.search(r"ReadSchema: struct<>", plans["row_count"])


def test_filters_reach_the_scan(plans):
    assert "PushedFilters: [Or(Or(GreaterThan(l_quantity,48.0)" in plans["extreme_context"]
    assert "PushedFilters: [IsNotNull(l_quantity)]" in plans["top_values"]
    assert "In(n_name, [NATION_0" in plans["sql_in_list_crosstab"]


def test_rank_filter_limits_groups_before_the_shuffle(plans):
    assert plans["extreme_context"].count("WindowGroupLimit") == 2


def test_top_k_does_not_sort_everything(plans):
    for name in ("topk_state", "group_coverage", "topk_condition", "sql_top_cities"):
        assert "TakeOrderedAndProject" in plans[name], name


def test_shares_reuse_the_group_shuffle(spark, sf_dir):
    """The total is a subquery over the same exchange, also when NULL groups are dropped."""
    for name in ("class_distribution", "topk_state", "topk_condition", "by_hour_nulls",
                 "by_hour_known", "group_coverage", "cumulative_share", "sql_class_share"):
        assert "ReusedExchange" in executed(QUERIES[name](spark, sf_dir)), name


def test_broadcast_side_is_limited(spark, sf_dir):
    plan = planned(ranking.rows_in_top(views.events(spark, sf_dir), "action", 3))
    broadcast = plan[plan.index("BroadcastExchange"):]
    assert "TakeOrderedAndProject(limit=3" in broadcast


def test_exact_quantiles_scan_their_table_twice(spark, sf_dir, monkeypatch):
    """One scan for the histograms, one for the left-overs; later rounds read these alone."""
    ran, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda df: (r := collect(df), ran.append(planned(df)))[0])
    df = views.lines(spark, sf_dir)
    quantiles.exact_summary(df, {c: df[c] for c in ("l_quantity", "l_extendedprice")},
                            df["l_returnflag"])
    first, *later = ran
    assert "percentile" not in "".join(ran) and "InMemoryTableScan" not in first
    assert 1 <= len(later) <= 3 and all("InMemoryTableScan" in p for p in later)
    final = first.split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1
    # the window runs over cells: an aggregate stands below it
    assert final.index("Window") < final.index("HashAggregate(keys=[s#")


def test_sketched_medians_deal_no_rows_by_class(plans):
    """Half of all rows would meet in the task of class 0: only sketches and counts are shuffled."""
    plan = plans["sketched_medians"]
    rows = plan[:plan.index("Subquery")] if "Subquery" in plan else plan
    assert "Join" not in rows and rows.count("Exchange") == 1
    assert rows.index("Exchange") < rows.rindex("HashAggregate")
