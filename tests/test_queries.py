"""Every registered query against its reference SQL, and what all plans have to keep to."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from verification import oracle, registry
from verification.clicks import clicks_raw
from verification.compare import connect, difference

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables here")

QUERIES, SQL = registry.queries(), oracle.oracle_sql()
WITHOUT_SQL = {
    "price_quantiles_approx",
    "purchase_model_metrics",
    "purchase_model_coefficients",
}
JOBS = WITHOUT_SQL | {
    "csv_corrupt_scan",
    "file_inventory",
    "file_sizes",
    "model_document",
    "model_round_trip",
    "model_stationary",
    "profile_overview",
    "silver_month_rerun",
    "source_names",
    "header_contract",
    "medallion_audit",
    "medallion_roundtrip",
}


@pytest.fixture(scope="module")
def tables():
    return connect(SF)


def test_only_three_queries_have_no_sql():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, tables, name):
    assert difference(spark, tables, SF, name) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - JOBS))
def test_plans(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for unwanted in (
        "CartesianProduct",
        "BroadcastNestedLoopJoin",
        "BatchEvalPython",
        "ArrowEvalPython",
        "MapInPandas",
    ):
        assert unwanted not in plan


SERVING = ("conversion_grid", "filter_domains", "funnel_stages", "slice_category_kpis", "slice_kpis",
           "slice_purchases_by_date", "slice_purchases_by_hour", "slice_top_categories")


@pytest.mark.parametrize("name", SERVING)
def test_slices_read_stored_gold_only(spark, name):
    """No look at events; months are picked by folder and the rest by file statistics."""
    frame = QUERIES[name](spark, SF)
    read = frame.inputFiles()
    assert read and all("/clickloom-gold-" in path for path in read)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan
    if name != "filter_domains":
        assert re.search(r"PartitionFilters: \[.*event_month#\d+ (IN|=)", plan)
    if name in ("slice_kpis", "slice_purchases_by_date", "slice_top_categories"):
        assert "GreaterThanOrEqual(purchase_date_utc" in plan
    if name == "slice_category_kpis":
        assert "EqualTo(category_code" in plan


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_adapter_reads_whole_tables(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    copies = events.where("event_id % 53 = 0").count()
    assert clicks_raw(spark, SF).count() == events.count() + copies


def test_sample_holds_whole_sessions(spark):
    sample = QUERIES["session_sample"](spark, SF)
    events = QUERIES["silver_events"](spark, SF).groupBy("user_session").agg(
        F.count(F.lit(1)).alias("all_events")
    )
    assert sample.join(events, "user_session").where("events <> all_events").count() == 0


def test_approximate_quantiles_are_near(spark):
    near = QUERIES["price_quantiles_approx"](spark, SF).first()
    exact = QUERIES["price_quantiles_exact"](spark, SF).first()
    assert near["valid_numeric_count"] == exact["valid_numeric_count"]
    assert (near["min"], near["max"]) == (exact["min"], exact["max"])
    assert near["q1"] <= near["median"] <= near["q3"]


def test_model_metrics_are_consistent_and_repeatable(spark):
    first = QUERIES["purchase_model_metrics"](spark, SF).first()
    cells = ("true_positive", "false_positive", "true_negative", "false_negative")
    tested = QUERIES["session_examples"](spark, SF).where("event_month = '2024-02'").count()
    assert sum(first[cell] for cell in cells) == tested
    assert 0 <= first["roc_auc"] <= 1 and 0 <= first["pr_auc"] <= 1
    assert QUERIES["purchase_model_metrics"](spark, SF).first() == first
