"""Queries for scans, filters, flattening and distinct."""

from __future__ import annotations

from pyspark.sql import functions as F

from meshfeed.catalog.registry import query, table
from meshfeed.catalog.standins import WORD_LISTS_SQL, word_lists
from meshfeed.operators import rows as ops
from meshfeed.operators.columns import fill_defaults
from meshfeed.sources.tables import read_parquet

_BRANDS = ("Brand#2", "Brand#17", "Brand#5")


@query("select * from customer")
def scan_parquet(spark, sf_dir):
    return read_parquet(spark, f"{sf_dir}/customer.parquet")


@query("select doc_id, cast(quality as varchar) as flag from labels where quality = 1")
def filter_flag(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").cast("string").alias("flag")
    )
    return ops.filter_flag(labels, "flag")


@query("select * from events where value < 85")
def filter_below(spark, sf_dir):
    return ops.filter_below(table(spark, sf_dir, "events"), "value", 85)


@query("select * from part where p_brand in ('Brand#2', 'Brand#17', 'Brand#5')")
def filter_in_list(spark, sf_dir):
    return ops.filter_in_list(table(spark, sf_dir, "part"), "p_brand", _BRANDS)


@query("select doc_id from labels where toxic = 1")
def filter_then_project(spark, sf_dir):
    return ops.flag_then_project(table(spark, sf_dir, "labels"), "toxic", ["doc_id"])


@query(f"""
    select conv_id, turn, unnest(words) as word from (
      select conv_id, turn, unnest({WORD_LISTS_SQL}) as words from conversations)""")
def explode_nested(spark, sf_dir):
    lists = word_lists(table(spark, sf_dir, "conversations"), "text", "lists")
    return ops.explode_nested(lists, "lists", "word").select("conv_id", "turn", "word")


@query("select distinct user_id, event_type from events")
def distinct_rows(spark, sf_dir):
    return ops.distinct_rows(table(spark, sf_dir, "events").select("user_id", "event_type"))


@query("""
    select user_id, coalesce(event_type, 'click') as event_type from (
      select distinct user_id, nullif(event_type, 'error') as event_type from events)""")
def distinct_then_fill(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "user_id", F.nullif(F.col("event_type"), F.lit("error")).alias("event_type")
    )
    return fill_defaults(ops.distinct_rows(events), {"event_type": "click"})
