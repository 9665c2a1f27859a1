"""Message topics, through whichever connector the session has.

The connector is a format name and its options. A directory of text or Parquet files with a
column ``value`` has the same shape as a topic and stands in for one where there is no broker.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from meshfeed.session import hadoop_path

MIN_PARTITIONS = 20

MESSAGE_SCHEMA = T.StructType([T.StructField("value", T.StringType(), True)])


@dataclass(frozen=True)
class Topic:
    """Where messages come from or go to."""

    format: str
    options: Mapping[str, str] = field(default_factory=dict)
    #: For brokers: where the topic ends now, in the form that the two options below take.
    end: Callable[[SparkSession], str] | None = None
    from_option: str = "startingOffsets"
    to_option: str = "endingOffsets"

    def with_options(self, **more: str) -> Topic:
        return replace(self, options={**self.options, **more})


def folder_topic(path: str, format: str = "text") -> Topic:
    """A directory in place of a topic. Use Parquet where messages hold line breaks."""
    return Topic(format, {"path": path})


def tls_topic(
    service_url: str,
    topic: str,
    cert_file: str,
    key_file: str,
    ca_file: str,
    admin_url: str | None = None,
    reading: bool = False,
    subscription: str | None = None,
    min_partitions: int = MIN_PARTITIONS,
) -> Topic:
    """A broker topic over mutual TLS; ``reading`` adds what a streaming source needs."""
    # Option names of the public Apache Pulsar connector for Spark.
    options = {
        "service.url": service_url,
        "pulsar.client.authPluginClassName": "org.apache.pulsar.client.impl.auth.AuthenticationTls",
        "pulsar.client.authParams": f"tlsCertFile:{cert_file},tlsKeyFile:{key_file}",
        "pulsar.client.tlsTrustCertsFilePath": ca_file,
        "pulsar.client.useTls": "true",
        "pulsar.client.tlsAllowInsecureConnection": "false",
    }
    if reading:
        options["topics"] = topic
        options["minPartitions"] = str(min_partitions)
        if admin_url:
            options["admin.url"] = admin_url
        if subscription:
            options["predefinedSubscription"] = subscription
    else:
        options["topic"] = topic
    return Topic("pulsar", options)


def read_topic(spark: SparkSession, topic: Topic) -> DataFrame:
    """What a topic holds now, as a batch."""
    reader = spark.read.format(topic.format).options(**topic.options)
    if "path" in topic.options:
        reader = reader.schema(MESSAGE_SCHEMA)
    return reader.load()


def stream_topic(spark: SparkSession, topic: Topic) -> DataFrame:
    """A topic as an unbounded table."""
    reader = spark.readStream.format(topic.format).options(**topic.options)
    if "path" in topic.options:
        reader = reader.schema(MESSAGE_SCHEMA)
    return reader.load()


@dataclass(frozen=True)
class Position:
    """A place in a topic: the files that a directory holds, or what a broker calls its end."""

    files: frozenset[str] = frozenset()
    offset: str | None = None


def position(spark: SparkSession, topic: Topic) -> Position:
    """Where the topic ends now. For a directory this is a listing, for a broker one question
    (``topic.end``); no message is read."""
    if "path" not in topic.options:
        if topic.end is None:
            raise ValueError("the topic has no positions: it needs a function that tells its end")
        return Position(offset=topic.end(spark))
    files, root = hadoop_path(spark, topic.options["path"])
    if not files.exists(root):
        return Position()
    listed, found = files.listFiles(root, True), set()
    while listed.hasNext():
        path = listed.next().getPath()
        if not path.getName().startswith(("_", ".")):
            found.add(path.toString())
    return Position(files=frozenset(found))


def read_between(spark: SparkSession, topic: Topic, start: Position, end: Position) -> DataFrame:
    """What was added to the topic after ``start`` and up to ``end``; nothing else is read."""
    if "path" not in topic.options:
        between = topic.with_options(**{topic.from_option: start.offset, topic.to_option: end.offset})
        return read_topic(spark, between)
    added = sorted(end.files - start.files)
    if not added:
        return spark.createDataFrame([], MESSAGE_SCHEMA)
    options = {k: v for k, v in topic.options.items() if k != "path"}
    return spark.read.format(topic.format).options(**options).schema(MESSAGE_SCHEMA).load(added)
