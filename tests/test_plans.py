"""Shapes of the physical plans."""

import re

import pytest

from tidemark.plans.catalog import load

QUERIES, _ = load()

LAZY = ["class_distribution", "missing_counts", "describe_numeric", "exploration_summary", "validate_rows", "score_batch",
        "confusion_matrix", "auc_roc", "auc_roc_by_algorithm", "roc_curve", "supplier_runs", "category_index", "standardize",
        "split_counts", "request_rate", "latency_quantiles", "bucket_increase", "drift_report", "distribution_shift",
        "progress", "batch_summary", "error_rate", "label_index"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_products_and_no_python(spark, sf, name):
    plan = plan_of(QUERIES[name](spark, sf))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan


@pytest.mark.parametrize("name, columns", [
    ("class_distribution", {"l_returnflag"}), ("auc_roc", {"l_extendedprice", "l_returnflag"}),
    ("split_counts", {"l_orderkey", "l_linenumber"}), ("progress", {"event_id", "event_type", "props"}),
])
def test_scans_read_only_what_they_need(spark, sf, name, columns):
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(QUERIES[name](spark, sf)))
    assert read and all({c.split(":")[0] for c in r.split(",")} <= columns for r in read)


def test_filters_reach_the_files(spark, sf):
    assert "In(l_returnflag, [A,R])" in plan_of(QUERIES["auc_roc"](spark, sf))
    assert "IsNotNull(event_type)" in plan_of(QUERIES["request_rate"](spark, sf)) or (
        "event_type" in plan_of(QUERIES["request_rate"](spark, sf)).split("DataFilters")[1])


@pytest.mark.parametrize("name, scans", [("exploration_summary", 2), ("drift_report", 2), ("distribution_shift", 2),
                                         ("confusion_matrix", 1), ("bucket_increase", 1)])
def test_tables_are_read_once(spark, sf, name, scans):
    """Two scans are customers and orders."""
    assert plan_of(QUERIES[name](spark, sf)).count("FileScan parquet") == scans
