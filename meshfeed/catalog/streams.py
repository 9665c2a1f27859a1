"""Queries that run a stream over what there is and read its output back."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshfeed import files
from meshfeed.catalog.registry import query, table
from meshfeed.catalog.standins import (
    EVENT_MESSAGES_SQL,
    LOCATION_SQL,
    event_messages,
    location_messages,
)
from meshfeed.functions.payload import json_object
from meshfeed.operators.columns import decode_messages, encode_rows
from meshfeed.plans import location_events, router_score
from meshfeed.session import shared_folder, stage
from meshfeed.sources.topics import MESSAGE_SCHEMA, Topic, folder_topic, read_topic, stream_topic
from meshfeed.streaming.commits import HOUR, REJECTED, Commits, compact, malformed, start_committed_batches
from meshfeed.streaming.fanout import start_fan_out
from meshfeed.streaming.ingest import (
    archive_options,
    run_available,
    start_json_batches,
    start_json_sink,
)


def _score_ingest(spark, topic, out, checkpoint, start=start_json_batches):
    stream = router_score.score_records(stream_topic(spark, topic))
    run_available(start(stream, out, checkpoint, interval=None))


@query(EVENT_MESSAGES_SQL)
def stream_decode_to_json(spark, sf_dir):
    topic = folder_topic(shared_folder(spark, "topic"))
    event_messages(spark, sf_dir).write.text(topic.options["path"])
    out = shared_folder(spark, "scores")
    _score_ingest(spark, topic, out, shared_folder(spark, "progress"), start_json_sink)
    return spark.read.schema(router_score.MESSAGE_SCHEMA).json(out)


@query(f"""
    select origin, * exclude (origin) from (
      select 'one' as origin, * from ({EVENT_MESSAGES_SQL})
      union all select 'two' as origin, * from ({EVENT_MESSAGES_SQL}))""")
def stream_two_topics(spark, sf_dir):
    """Two topics into one sink; each message says where it came from."""
    streams = []
    for name in ("one", "two"):
        topic = folder_topic(shared_folder(spark, name))
        event_messages(spark, sf_dir).write.text(topic.options["path"])
        records = router_score.score_records(stream_topic(spark, topic))
        streams.append(records.withColumn("origin", F.lit(name)))
    out = shared_folder(spark, "scores")
    both = streams[0].unionByName(streams[1])
    run_available(start_json_batches(both, out, shared_folder(spark, "progress"), interval=None))
    schema = T.StructType([*router_score.MESSAGE_SCHEMA, T.StructField("origin", T.StringType())])
    return spark.read.schema(schema).json(out).drop("batch")


def _location_ingest(spark, sf_dir, **layout):
    topic = folder_topic(shared_folder(spark, "topic"))
    location_messages(spark, sf_dir).write.text(topic.options["path"])
    out, checkpoint = shared_folder(spark, "locations"), shared_folder(spark, "progress")
    records = location_events.location_records(stream_topic(spark, topic))
    compression = location_events.COMPRESSION
    run_available(
        start_json_sink(
            records, out, checkpoint, interval=None, compression=compression, **layout
        )
    )
    return spark.read.schema(records.schema).json(out)


@query(LOCATION_SQL)
def stream_partitioned_json(spark, sf_dir):
    """A backlog over all days and hours: each hour is brought together, then written."""
    return _location_ingest(
        spark, sf_dir, partition_by=location_events.PARTITION_BY, rebalance=True
    )


@query(LOCATION_SQL)
def stream_backlog_json(spark, sf_dir):
    """All days at once, so rows are brought together by day, and a large day is split by size."""
    return _location_ingest(
        spark, sf_dir, partition_by=("date",), rebalance=True, max_records_per_file=1_000_000
    )


@query(EVENT_MESSAGES_SQL)
def stream_restart(spark, sf_dir):
    """Stopped and started again with the same checkpoint: new input is added, old is not."""
    topic = folder_topic(shared_folder(spark, "topic"))
    out, checkpoint = shared_folder(spark, "scores"), shared_folder(spark, "progress")
    messages = event_messages(spark, sf_dir)
    unreadable = F.col("value") == "bad"
    for arriving in (messages.filter(~unreadable), messages.filter(unreadable)):
        arriving.write.mode("append").text(topic.options["path"])
        _score_ingest(spark, topic, out, checkpoint)
    _score_ingest(spark, topic, out, checkpoint)
    return spark.read.schema(router_score.MESSAGE_SCHEMA).json(out).drop("batch")


_ARCHIVE_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType(), True),
        T.StructField("event_type", T.StringType(), True),
    ]
)


@query("""
    select 'decoded' as origin, event_id, event_type from events
    union all select 'kept' as origin, event_id, event_type from events""")
def stream_archive_input(spark, sf_dir):
    """Consumed files move to an archive as the stream goes on: the rows that came out, and the
    rows of the input files wherever these are now."""
    source, archive = shared_folder(spark, "inbox"), shared_folder(spark, "archive")
    out, checkpoint = shared_folder(spark, "decoded"), shared_folder(spark, "progress")
    topic = Topic("text", {"path": source, **archive_options(archive)})
    messages = encode_rows(table(spark, sf_dir, "events").select("event_id", "event_type"))
    types = F.get_json_object("value", "$.event_type").isin("view", "click")
    for arriving in (messages.filter(types), messages.filter(~types)):
        arriving.write.mode("append").text(source)
        stream = decode_messages(stream_topic(spark, topic), _ARCHIVE_SCHEMA)
        run_available(start_json_sink(stream, out, checkpoint, interval=None))
    decoded = spark.read.schema(_ARCHIVE_SCHEMA).json(out)
    files = (
        spark.read.schema(MESSAGE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "part-*")
        .text([source, archive])
    )
    kept = decode_messages(files, _ARCHIVE_SCHEMA)
    return decoded.withColumn("origin", F.lit("decoded")).unionByName(
        kept.withColumn("origin", F.lit("kept"))
    )


_EVENT_TEXTS_SQL = """
    select case when event_type = 'error' then 'bad'
      else cast(to_json(struct_pack(event_id := event_id, event_type := event_type)) as varchar) end as "value"
    from events"""


def _event_texts(spark, sf_dir):
    """Events as messages; one type gives a line that is no JSON."""
    text = json_object("event_id", "event_type")
    return table(spark, sf_dir, "events").select(F.when(F.col("event_type") == "error", "bad").otherwise(text).alias("value"))


def _in_batches(spark, topic):
    """The topic's files, one in each micro-batch."""
    return stream_topic(spark, topic.with_options(maxFilesPerTrigger="1"))


def _arrives(messages, topic):
    """One more file of messages in the topic."""
    messages.coalesce(1).write.mode("append").text(topic.options["path"])


def _until_failure(start):
    """Run a stream that is to die."""
    try:
        run_available(start())
    except StreamingQueryException:
        return
    raise AssertionError("the stream did not fail")


@query(EVENT_MESSAGES_SQL)
def stream_half_written_batch(spark, sf_dir):
    """The job dies while its second batch is being written, and is started again: readers see
    committed batches only, and each message once."""
    topic = folder_topic(shared_folder(spark, "topic"))
    out, checkpoint = shared_folder(spark, "scores"), shared_folder(spark, "progress")
    messages = event_messages(spark, sf_dir)
    unreadable = F.col("value") == "bad"

    def start(step=lambda rows: rows):
        records = router_score.score_records(_in_batches(spark, topic))
        return start_committed_batches(step(records), out, checkpoint, interval=None)

    _arrives(messages.filter(unreadable), topic)
    run_available(start())
    messages.filter(~unreadable).repartition(4).write.mode("append").text(topic.options["path"])
    dying = F.when(F.col("serial_num").isNotNull(), F.raise_error("died").cast("string"))
    _until_failure(lambda: start(lambda rows: rows.withColumn("mdn", F.coalesce(dying, "mdn"))))
    run_available(start())
    return Commits(spark, out).read(router_score.MESSAGE_SCHEMA)


@query(f"""
    select moment, * exclude (moment) from (
      select 'before' as moment, * from ({EVENT_MESSAGES_SQL})
      union all select 'during' as moment, * from ({EVENT_MESSAGES_SQL})
      union all select 'after' as moment, * from ({EVENT_MESSAGES_SQL}))""")
def stream_compaction(spark, sf_dir):
    """Batches of an hour rewritten into few files: the rows as a reader sees them who began before,
    who began before and reads after, and after the replaced folders are gone."""
    topic = folder_topic(shared_folder(spark, "topic"))
    out, checkpoint = shared_folder(spark, "scores"), shared_folder(spark, "progress")
    event_messages(spark, sf_dir).repartition(4).write.text(topic.options["path"])
    records = router_score.score_records(_in_batches(spark, topic))
    run_available(start_committed_batches(records, out, checkpoint, interval=None))
    log = Commits(spark, out)
    moments = {"before": stage(log.read(router_score.MESSAGE_SCHEMA), "before")}
    reader = log.read(router_score.MESSAGE_SCHEMA)
    compact(spark, out, before=files.modified(spark, log.log) + HOUR)
    moments["during"] = stage(reader, "during")
    log.vacuum(keep_ms=0)
    moments["after"] = log.read(router_score.MESSAGE_SCHEMA)
    seen = [df.withColumn("moment", F.lit(name)) for name, df in moments.items()]
    return seen[0].unionByName(seen[1]).unionByName(seen[2])


@query(f"""
    select 'rejected' as sink, count(*) as n, count(distinct "value") as texts
    from ({_EVENT_TEXTS_SQL}) where "value" = 'bad'
    union all select 'records', count(*), count(distinct "value") from ({_EVENT_TEXTS_SQL}) where "value" <> 'bad'""")
def stream_quarantine(spark, sf_dir):
    """Messages that are no JSON go to a sink of their own, in one commit with the others, over a
    restart: how many each sink holds, and how many different ones."""
    topic = folder_topic(shared_folder(spark, "topic"))
    out, checkpoint = shared_folder(spark, "scores"), shared_folder(spark, "progress")
    messages = _event_texts(spark, sf_dir)

    def start(step=lambda rows: rows):
        kept = F.from_json("value", "raw string, corrupt string", {"columnNameOfCorruptRecord": "corrupt"})
        lines = _in_batches(spark, topic).withColumn("corrupt", kept["corrupt"])
        return start_committed_batches(step(lines), out, checkpoint, interval=None, split=malformed("corrupt"))

    messages.repartition(2).write.text(topic.options["path"])
    dying = F.when(F.col("corrupt").isNotNull(), F.raise_error("died").cast("string"))
    _until_failure(lambda: start(lambda rows: rows.withColumn("corrupt", dying)))
    run_available(start())
    log = Commits(spark, out)
    counts = [
        log.read(MESSAGE_SCHEMA, sink).agg(
            F.lit(sink).alias("sink"), F.count("*").alias("n"), F.count_distinct("value").alias("texts")
        )
        for sink in ("records", REJECTED)
    ]
    return counts[0].unionByName(counts[1])


@query(f"""
    select 'prod' as target, "value" from ({_EVENT_TEXTS_SQL})
    union all select 'nonprod' as target, "value" from ({_EVENT_TEXTS_SQL})""")
def stream_fan_out(spark, sf_dir):
    """A stream to two topics that dies between them and is started again."""
    source = folder_topic(shared_folder(spark, "topic"))
    ledger, checkpoint = shared_folder(spark, "ledger"), shared_folder(spark, "progress")
    topics = {name: folder_topic(shared_folder(spark, name)) for name in ("prod", "nonprod")}
    _event_texts(spark, sf_dir).repartition(2).write.text(source.options["path"])

    def start(targets):
        return start_fan_out(_in_batches(spark, source), targets, ledger, checkpoint, interval=None)

    _until_failure(lambda: start({**topics, "nonprod": Topic("no-such-connector")}))
    run_available(start(topics))
    arrived = [read_topic(spark, t).withColumn("target", F.lit(n)) for n, t in topics.items()]
    return arrived[0].unionByName(arrived[1])
