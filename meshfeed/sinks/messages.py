"""Publishing one message per row, to one target or several, and checking what arrived."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from meshfeed.functions.payload import named
from meshfeed.session import staged
from meshfeed.sources.topics import Topic


def publish(df: DataFrame, topic: Topic) -> None:
    """Send column ``value``, one message per row. A failure to write fails the job."""
    messages = df.select(named("value"))
    messages.write.format(topic.format).options(**topic.options).mode("append").save()


def fan_out(df: DataFrame, topics: Sequence[Topic]) -> None:
    """Send the same messages to several topics.

    For more than one topic they are computed once and staged as a table until all are sent. A
    cache would be lost with its executor and computed anew between two targets.
    """
    messages = df.select(named("value"))
    if len(topics) == 1:
        publish(messages, topics[0])
    elif topics:
        with staged(messages, "fan-out") as table:
            for topic in topics:
                publish(table, topic)


#: What is counted of messages, in the order of the columns of a check.
MEASURES = ("messages", "bytes", "nulls", "checksum")


def _measures() -> list[Column]:
    """Counts that do not depend on the order of messages. The checksum adds a hash of each message, in
    a decimal that no number of messages overflows."""
    value = named("value")
    hashed = F.xxhash64(value).cast("decimal(20,0)")
    zero = F.lit(0)
    return [
        F.count(F.lit(1)).alias("messages"),
        F.coalesce(F.sum(F.octet_length(value)), zero.cast("bigint")).alias("bytes"),
        F.count(F.when(value.isNull(), 1)).alias("nulls"),
        F.coalesce(F.sum(F.when(value.isNotNull(), hashed)), zero.cast("decimal(30,0)")).alias("checksum"),
    ]


def publish_counted(df: DataFrame, topic: Topic) -> dict[str, int]:
    """:func:`publish`, and what was sent, counted by the sending job on the way: ``messages``, ``bytes``,
    ``nulls`` and a ``checksum`` of all texts. Only tasks that succeeded count, once each."""
    seen = Observation()
    publish(df.select(named("value").cast("string").alias("value")).observe(seen, *_measures()), topic)
    return {name: int(seen.get[name]) for name in MEASURES}


def measured(messages: DataFrame) -> dict[str, int]:
    """The same counts of messages that are there, in one pass without a shuffle of texts."""
    row = messages.agg(*_measures()).first()
    return {name: int(row[name]) for name in MEASURES}


def message_counts(messages: DataFrame) -> DataFrame:
    """``digest``, ``messages``, ``unreadable`` of each different message: how often it is there, and how
    often it is not JSON. A null and an empty message are different; both count as readable or
    not as JSON has it, null as readable."""
    value = named("value")
    digest = F.when(value.isNull(), F.unhex(F.lit("00"))).otherwise(F.unhex(F.sha2(value, 256)))
    broken = F.when(value.isNotNull() & F.try_parse_json(value).isNull(), 1).otherwise(0)
    return (
        messages.select(digest.alias("digest"), broken.cast("bigint").alias("broken"))
        .groupBy("digest")
        .agg(F.count("*").alias("messages"), F.sum("broken").alias("unreadable"))
    )


def delivery_check(
    sent: DataFrame, received: DataFrame, before: DataFrame | None = None
) -> DataFrame:
    """Compare all messages sent with those received, copies counted; one row of counts.

    ``missing`` and ``unexpected`` count messages that only one side has, ``unreadable`` those
    received that are not JSON. ``before`` is what the topic held before this run, as
    :func:`message_counts`: it is taken off, so neither can an older copy stand for a lost message
    nor is an older message unexpected. All sides are reduced to counts per SHA-256 digest before
    they meet, so message texts are not shuffled and a message with many copies is one row.
    """
    zero = F.lit(0).cast("bigint")

    def side(counts: DataFrame, out, back) -> DataFrame:
        broken = back * F.col("unreadable")
        return counts.select(
            "digest",
            (out * F.col("messages")).alias("out"),
            (back * F.col("messages")).alias("back"),
            broken.alias("broken"),
        )

    sides = side(message_counts(sent), F.lit(1), F.lit(0))
    sides = sides.unionByName(side(message_counts(received), F.lit(0), F.lit(1)))
    if before is not None:
        sides = sides.unionByName(side(before, F.lit(0), F.lit(-1)))
    per_message = sides.groupBy("digest").agg(
        *[F.greatest(F.sum(count), zero).alias(count) for count in ("out", "back", "broken")]
    )

    def total(column):
        return F.coalesce(F.sum(column), zero)

    gap = F.col("out") - F.col("back")
    return per_message.agg(
        total(F.col("out")).alias("sent"),
        total(F.col("back")).alias("received"),
        total(F.greatest(gap, zero)).alias("missing"),
        total(F.greatest(-gap, zero)).alias("unexpected"),
        total(F.col("broken")).alias("unreadable"),
    )
