"""What the optimizer makes of the steps: pruned scans, pushed filters, no needless shuffles."""

import pytest
from pyspark.sql import functions as F

from meshfeed import catalog
from meshfeed.catalog import standins
from meshfeed.operators import rows
from meshfeed.plans import location_events, router_score, site_alert
from meshfeed.session import staged
from meshfeed.sinks.documents import _records, array_lines
from meshfeed.sinks.messages import delivery_check
from meshfeed.streaming.ingest import rebalanced
from tests.oracle import SF_DIR

QUERIES = catalog.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stream_twin(spark, name):
    """The batch plan of what a stream query does to its messages."""
    if "json" in name and name != "stream_decode_to_json":
        records = location_events.location_records(standins.location_messages(spark, SF_DIR))
        return rebalanced(records, location_events.PARTITION_BY)
    return router_score.score_records(standins.event_messages(spark, SF_DIR))


@pytest.mark.parametrize("name", sorted(set(QUERIES)))
def test_no_python_and_no_cross_join(spark, name):
    stream = name.startswith("stream_")
    text = plan(stream_twin(spark, name) if stream else QUERIES[name](spark, SF_DIR))
    for word in ("Python", "ArrowEval", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_filter_reaches_the_scan(spark):
    text = plan(QUERIES["filter_below"](spark, SF_DIR))
    assert "PushedFilters: [IsNotNull(value), LessThan(value,85.0)]" in text
    text = plan(QUERIES["filter_in_list"](spark, SF_DIR))
    assert "PushedFilters: [In(p_brand" in text
    text = plan(QUERIES["dated_input"](spark, SF_DIR))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text


def test_only_needed_columns_are_read(spark):
    text = plan(QUERIES["filter_then_project"](spark, SF_DIR))
    assert "ReadSchema: struct<doc_id:bigint,toxic:int>" in text
    text = plan(QUERIES["distinct_rows"](spark, SF_DIR))
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in text


@pytest.mark.parametrize(
    "name, shuffles",
    [
        ("router_score_feed", 1),
        ("router_score_feed_anon", 1),
        ("distinct_then_fill", 1),
        ("explode_nested", 0),
        ("alert_gated_features", 0),
        ("site_alert_report", 0),
        ("epoch_parts", 0),
        ("json_decode", 0),
    ],
)
def test_shuffles(spark, name, shuffles):
    assert plan(QUERIES[name](spark, SF_DIR)).count("Exchange") == shuffles


def test_texts_are_split_once(spark):
    assert plan(QUERIES["router_score_feed"](spark, SF_DIR)).count("transform(split(") == 1


def test_sample_keeps_only_a_few_rows_per_task(spark):
    text = plan(QUERIES["sample_feed"](spark, SF_DIR))
    assert "TakeOrderedAndProject" in text and "SortAggregate" not in text


def test_model_filter_is_below_the_distinct(spark):
    lines = plan(QUERIES["router_score_feed"](spark, SF_DIR)).splitlines()
    first_filter = next(i for i, line in enumerate(lines) if "IN (the,of" in line)
    assert sum("HashAggregate" in line for line in lines[:first_filter]) == 2


def test_site_flag_is_below_the_encoding(spark):
    df = site_alert.site_alert_report(standins.sites(spark, SF_DIR), "x")
    lines = plan(df).splitlines()
    flag = next(i for i, line in enumerate(lines) if "Filter" in line)
    assert any("evaluate" in line for line in lines[:flag])


def test_delivery_check_shuffles_counts_not_messages(spark):
    texts = spark.range(1000).select(F.repeat(F.lit("x"), 500).alias("value"))
    text = plan(delivery_check(texts, texts))
    assert "partial_count" in text
    exchange = next(line for line in text.splitlines() if "Exchange hashpartitioning" in line)
    assert "digest" in exchange and "value" not in exchange


def test_first_rows_has_no_full_sort(spark):
    df = rows.first_rows(spark.read.parquet(f"{SF_DIR}/events.parquet"), 5, ["event_id"])
    assert "TakeOrderedAndProject" in plan(df) and "rangepartitioning" not in plan(df)


def test_document_is_sorted_only_if_asked(spark):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    for order in ((), ("o_orderkey",)):
        with staged(_records(orders, order), "document") as records:
            text = plan(array_lines(records, bool(order)))
        assert ("rangepartitioning" in text) == bool(order)


def test_one_file_row_is_not_copied_by_a_projection(spark):
    """The row is as large as the report."""
    text = plan(QUERIES["json_document_one_file"](spark, SF_DIR))
    assert "Project" not in text and "Scan text" in text.replace("FileScan", "Scan")
