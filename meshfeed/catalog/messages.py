"""Queries that publish, with a directory standing in for the topic."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshfeed.catalog.registry import query, table
from meshfeed.functions.payload import json_object
from meshfeed.operators.columns import encode_rows
from meshfeed.plans.job import Feed
from meshfeed.session import shared_folder, stage
from meshfeed.sinks.archive import move_to_archive
from meshfeed.sinks.documents import (
    array_messages,
    document_message,
    write_json_array,
    write_json_records,
)
from meshfeed.sinks.messages import delivery_check, message_counts, publish
from meshfeed.sources.tables import read_whole_files
from meshfeed.sources.topics import folder_topic, position, read_between, read_topic

_CUSTOMER_SQL = 'select cast(to_json(c) as varchar) as "value" from customer c'

_ORDERS_JSON = """
    cast(to_json(struct_pack(
      o_orderkey := o_orderkey, o_custkey := o_custkey, status := nullif(o_orderstatus, 'P'),
      o_totalprice := o_totalprice)) as varchar)"""
_DOCUMENT_SQL = f"""
    select {_ORDERS_JSON}
      || case when o_orderkey = (select max(o_orderkey) from orders) then '' else ',' end
      as "value"
    from orders
    union all select '['
    union all select ']'"""

RECORDS_PER_FILE = 1000


def _customers(sf_dir):
    return lambda spark: table(spark, sf_dir, "customer")


@query(_CUSTOMER_SQL)
def publish_messages(spark, sf_dir):
    topic = folder_topic(shared_folder(spark, "topic"))
    Feed(_customers(sf_dir), [encode_rows], [topic]).run(spark)
    return read_topic(spark, topic)


@query(f"""
    select 'prod' as target, "value" from ({_CUSTOMER_SQL})
    union all select 'nonprod' as target, "value" from ({_CUSTOMER_SQL})""")
def publish_fan_out(spark, sf_dir):
    topics = {name: folder_topic(shared_folder(spark, name)) for name in ("prod", "nonprod")}
    Feed(_customers(sf_dir), [encode_rows], list(topics.values())).run(spark)
    arrived = [
        read_topic(spark, topic).withColumn("target", F.lit(name)) for name, topic in topics.items()
    ]
    return reduce(DataFrame.unionByName, arrived)


@query("""
    select 0 as topic, count(*) as sent, count(*) as received, cast(0 as bigint) as missing,
      cast(0 as bigint) as unexpected, cast(0 as bigint) as unreadable
    from customer""")
def publish_readback_check(spark, sf_dir):
    topic = folder_topic(shared_folder(spark, "topic"))
    return Feed(_customers(sf_dir), [encode_rows], [topic]).run_checked(spark)


@query(f"""
    with m as (select count(*) as n, cast(sum(strlen("value")) as bigint) as bytes from ({_CUSTOMER_SQL}))
    select cast(t.topic as int) as topic, n as sent_messages, bytes as sent_bytes, cast(0 as bigint) as sent_nulls,
      n as received_messages, bytes as received_bytes, cast(0 as bigint) as received_nulls, 1 as delivered
    from m, range(2) as t(topic)""")
def publish_counted_check(spark, sf_dir):
    """Two topics that were used before: what the sending job counted, and what stands in each topic
    behind its former end."""
    topics = [folder_topic(shared_folder(spark, name)) for name in ("prod", "nonprod")]
    publish(encode_rows(table(spark, sf_dir, "supplier")), topics[0])
    counted = Feed(_customers(sf_dir), [encode_rows], topics).run_counted(spark)
    counted = counted.withColumn("delivered", F.col("delivered").cast("int"))
    return counted.drop("sent_checksum", "received_checksum")


@query(_CUSTOMER_SQL)
def topic_between_positions(spark, sf_dir):
    """Only what was added between two positions of a topic is read."""
    topic = folder_topic(shared_folder(spark, "topic"))
    other = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("value"))
    publish(other, topic)
    start = position(spark, topic)
    publish(encode_rows(table(spark, sf_dir, "customer")), topic)
    end = position(spark, topic)
    publish(other, topic)
    return read_between(spark, topic, start, end)


@query("""
    select count(*) as sent, count(*) filter (c_mktsegment <> 'BUILDING') as received,
      count(*) filter (c_mktsegment = 'BUILDING') as missing, cast(0 as bigint) as unexpected,
      cast(0 as bigint) as unreadable
    from customer""")
def delivery_on_used_topic(spark, sf_dir):
    """The topic held the same texts, and damaged ones, before; one segment of today's was lost."""
    customers = table(spark, sf_dir, "customer")
    topic = folder_topic(shared_folder(spark, "topic"))
    publish(encode_rows(customers), topic)
    publish(customers.select(F.lit("{").alias("value")), topic)
    before = stage(message_counts(read_topic(spark, topic)), "before")
    publish(encode_rows(customers.filter("c_mktsegment <> 'BUILDING'")), topic)
    return delivery_check(encode_rows(customers), read_topic(spark, topic), before)


@query("""
    select
      count(*) as sent,
      count(*) filter (c_mktsegment <> 'BUILDING') + count(*) filter (c_acctbal < 0) as received,
      count(*) filter (c_mktsegment in ('BUILDING', 'MACHINERY')) as missing,
      count(*) filter (c_mktsegment = 'MACHINERY') + count(*) filter (c_acctbal < 0) as unexpected,
      count(*) filter (c_mktsegment = 'MACHINERY') as unreadable
    from customer""")
def delivery_gaps(spark, sf_dir):
    """One segment was not delivered, one was damaged, and overdrawn accounts came with extra
    messages."""
    customers = table(spark, sf_dir, "customer")
    arrived = customers.filter("c_mktsegment <> 'BUILDING'").select(
        F.when(F.col("c_mktsegment") == "MACHINERY", "{").otherwise(json_object("*")).alias("value")
    )
    extra = customers.filter("c_acctbal < 0").select(F.lit("{}").alias("value"))
    topic = folder_topic(shared_folder(spark, "topic"))
    publish(arrived, topic)
    publish(extra, topic)
    return delivery_check(encode_rows(customers), read_topic(spark, topic))


@query("""
    select cast(to_json(struct_pack(event_id := event_id, event_type := event_type))
      as varchar) as line
    from events""")
def whole_file_messages(spark, sf_dir):
    """Files of records, each file sent as one message; the lines of all messages."""
    files = shared_folder(spark, "files")
    records = encode_rows(table(spark, sf_dir, "events").select("event_id", "event_type"))
    records.write.option("maxRecordsPerFile", RECORDS_PER_FILE).text(files)
    topic = folder_topic(shared_folder(spark, "topic"), "parquet")
    publish(read_whole_files(spark, files, glob="part-*"), topic)
    lines = F.explode(F.split("value", "\n"))
    return read_topic(spark, topic).select(lines.alias("line")).filter("line <> ''")


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", "nullif(o_orderstatus, 'P') as status", "o_totalprice"
    )


@query(_DOCUMENT_SQL)
def json_document(spark, sf_dir):
    folder = shared_folder(spark, "document")
    write_json_array(_orders(spark, sf_dir), folder, ["o_orderkey"])
    return spark.read.text(folder)


@query(f"""
    select {_ORDERS_JSON} as "value", count(*) over () + 2 as lines from orders""")
def json_document_unsorted(spark, sf_dir):
    """The document without a sort: its records, and how many lines it has."""
    folder = shared_folder(spark, "document")
    write_json_array(_orders(spark, sf_dir), folder)
    lines = spark.read.text(folder)
    count = lines.agg(F.count("*").alias("lines"))
    records = lines.filter("value not in ('[', ']')").select(
        F.regexp_replace("value", "^,", "").alias("value")
    )
    return records.withColumn("lines", count.scalar())


_PRETTY_ORDER = """'  {' || chr(10) || '    "o_orderkey": ' || o_orderkey || ',' || chr(10)
      || '    "o_custkey": ' || o_custkey || ',' || chr(10)
      || '    "status": ' || coalesce('"' || nullif(o_orderstatus, 'P') || '"', 'null') || ',' || chr(10)
      || '    "o_orderdate": "' || strftime(o_orderdate, '%Y-%m-%d') || '"' || chr(10) || '  }'"""


@query(f"""
    select '[' || chr(10) || string_agg({_PRETTY_ORDER}, ',' || chr(10) order by o_orderkey) || chr(10) || ']' || chr(10)
      as "value"
    from orders""")
def json_document_one_file(spark, sf_dir):
    """A report as one file in readable form, which replaced an older one: its whole text."""
    path = shared_folder(spark, "reports") + "/report.json"
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", "nullif(o_orderstatus, 'P') as status", "cast(o_orderdate as date) as o_orderdate"
    )
    write_json_array(table(spark, sf_dir, "nation"), path, one_file=True)
    write_json_array(orders, path, ["o_orderkey"], one_file=True, pretty=True)
    return spark.read.text(path, wholetext=True)  # the reader's own row: a projection of it would copy the text


@query(_DOCUMENT_SQL)
def json_document_replaced(spark, sf_dir):
    """Two writers of a report: the second fails in the middle of its rows, and leaves the first's."""
    path = shared_folder(spark, "reports") + "/report"
    orders = _orders(spark, sf_dir)
    write_json_array(orders, path, ["o_orderkey"])
    failing = F.when(F.col("status").isNull(), F.raise_error("no status").cast("string")).otherwise(F.col("status"))
    try:
        write_json_array(orders.withColumn("status", failing), path, ["o_orderkey"])
    except PySparkException:
        return spark.read.text(path)
    raise AssertionError("the second report was written")


@query(f'select {_ORDERS_JSON} as "value" from orders')
def json_records(spark, sf_dir):
    folder = shared_folder(spark, "records")
    write_json_records(_orders(spark, sf_dir), folder)
    return spark.read.text(folder)


@query(_DOCUMENT_SQL)
def archived_document(spark, sf_dir):
    """A document that was written and then moved to the archive, read there."""
    folder = shared_folder(spark, "reports") + "/document"
    write_json_array(_orders(spark, sf_dir), folder, ["o_orderkey"])
    return spark.read.text(move_to_archive(spark, folder))


@query(f"select {_ORDERS_JSON} as record from orders")
def document_messages(spark, sf_dir):
    """A document sent as array messages of bounded length; their records."""
    topic = folder_topic(shared_folder(spark, "topic"))
    with array_messages(_orders(spark, sf_dir), ["o_orderkey"]) as messages:
        publish(messages, topic)
    arrays = F.from_json("value", "array<string>")
    return read_topic(spark, topic).select(F.explode(arrays).alias("record"))


@query(f"""
    select '[' || string_agg(record, ',' order by n) || ']' as "value" from (
      select {_ORDERS_JSON} as record, row_number() over (order by o_orderkey) - 1 as n
      from orders)
    group by n // 700""")
def document_arrays(spark, sf_dir):
    """The array messages themselves: cut by the record's number over the whole table."""
    topic = folder_topic(shared_folder(spark, "topic"))
    with array_messages(_orders(spark, sf_dir), ["o_orderkey"], 700) as messages:
        publish(messages, topic)
    return read_topic(spark, topic)


@query(f"""
    select '[' || string_agg(record, ',' order by n_nationkey) || ']' as "value" from (
      select n_nationkey, cast(to_json(struct_pack(
        n_nationkey := n_nationkey, n_name := n_name, n_regionkey := n_regionkey)) as varchar) as record
      from nation)""")
def document_in_one_message(spark, sf_dir):
    topic = folder_topic(shared_folder(spark, "topic"))
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    with document_message(nations, ["n_nationkey"]) as message:
        publish(message, topic)
    return read_topic(spark, topic)
