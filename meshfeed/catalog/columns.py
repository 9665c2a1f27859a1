"""Queries for single projection and scalar operators."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshfeed.catalog.registry import query, table
from meshfeed.catalog.standins import SITES_SQL, gated_json_sql, sites
from meshfeed.functions.alerts import alerting_json
from meshfeed.functions.payload import json_object
from meshfeed.functions.values import map_value
from meshfeed.operators import columns as ops
from meshfeed.plans.site_alert import FEATURES


@query("select s_suppkey, s_acctbal from supplier")
def select_except(spark, sf_dir):
    unwanted = ["s_name", "s_nationkey", "S_ACCTBAL"]
    return ops.select_except(table(spark, sf_dir, "supplier"), unwanted)


@query(
    "select o_orderkey as order_id, o_custkey as customer_id, o_orderstatus, o_totalprice, "
    "o_orderdate, o_orderpriority from orders"
)
def rename_columns(spark, sf_dir):
    names = {"o_orderkey": "order_id", "o_custkey": "customer_id", "absent": "ignored"}
    return ops.rename_columns(table(spark, sf_dir, "orders"), names)


@query("select *, 'acme' as vendor from supplier")
def add_constant(spark, sf_dir):
    return ops.add_constant(table(spark, sf_dir, "supplier"), "vendor", "acme")


@query(
    "select o_orderkey, "
    "'https://reports.example.org/order?id=' || nullif(o_orderstatus, 'P') as link from orders"
)
def derive_link(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status")
    )
    return ops.derive_link(orders, "link", "https://reports.example.org/order?id=", "status").drop(
        "status"
    )


@query('select props as "value" from events')
def cast_payload(spark, sf_dir):
    payload = table(spark, sf_dir, "events").select(F.col("props").cast("binary").alias("value"))
    return ops.cast_payload(payload)


@query(
    "select event_id, coalesce(nullif(event_type, 'error'), 'unknown') as event_type, "
    "coalesce(nullif(user_id, 8), 0) as user_id from events"
)
def fill_defaults(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"),
        F.nullif(F.col("user_id"), F.lit(8)).alias("user_id"),
    )
    return ops.fill_defaults(events, {"event_type": "unknown", "user_id": 0})


@query('select cast(to_json(c) as varchar) as "value" from customer c')
def json_encode_row(spark, sf_dir):
    return ops.encode_rows(table(spark, sf_dir, "customer"))


@query("""
    select event_id, cast(json_merge_patch('{}', to_json(struct_pack(
      user_id := user_id, event_type := nullif(event_type, 'error'), value := value))) as varchar)
      as packed
    from events""")
def json_encode_columns(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn(
        "event_type", F.nullif(F.col("event_type"), F.lit("error"))
    )
    return events.select("event_id", json_object("user_id", "event_type", "value").alias("packed"))


_PROPS = T.StructType([T.StructField("k", T.IntegerType(), True)])


@query("select cast(json_extract_string(props, '$.k') as int) as k from events")
def json_decode(spark, sf_dir):
    return ops.decode_messages(table(spark, sf_dir, "events"), _PROPS, value="props")


@query("""
    select
      case when event_type <> 'error' then cast(json_extract_string(props, '$.k') as int) end as k,
      case when event_type = 'error' then 'bad ' || props end as corrupt
    from events""")
def json_decode_malformed(spark, sf_dir):
    messages = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "error", F.concat(F.lit("bad "), F.col("props")))
        .otherwise(F.col("props"))
        .alias("value")
    )
    return ops.decode_messages(messages, _PROPS, corrupt_column="corrupt")


@query("""
    select event_id, json_extract_string(props, '$.k') as present, cast(null as varchar) as absent
    from events""")
def map_lookup(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "map<string,string>").alias("m")
    )
    return events.select(
        "event_id", map_value("m", "k").alias("present"), map_value("m", "none").alias("absent")
    )


@query("""
    select event_id, epoch_us(ts) // 1000 as millis,
      strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') as date_parsed,
      cast(hour(ts) as int) as "hour", cast(ts as date) as "date"
    from events""")
def epoch_parts(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("millis")
    )
    return ops.epoch_parts(events, "millis")


@query(
    f"select enodeb, abnormal_kpi, cast({gated_json_sql(FEATURES)} as varchar) as features "
    f"from ({SITES_SQL})"
)
def alert_gated_features(spark, sf_dir):
    return sites(spark, sf_dir).select(
        "enodeb", "abnormal_kpi", alerting_json(FEATURES).alias("features")
    )
