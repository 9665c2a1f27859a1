"""A feed: read, transform step by step, publish."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import ExitStack
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from meshfeed.session import hadoop_path, staged
from meshfeed.sinks.messages import MEASURES, delivery_check, fan_out, measured, message_counts, publish_counted
from meshfeed.sources.topics import Topic, position, read_between, read_topic

Step = Callable[[DataFrame], DataFrame]
REPORT = ("sent", "received", "missing", "unexpected", "unreadable")


@dataclass(frozen=True)
class Feed:
    """``steps`` may be any functions from DataFrame to DataFrame; none means rows pass as read.

    The result must have the message text in column ``value``.
    """

    read: Callable[[SparkSession], DataFrame]
    steps: Sequence[Step] = ()
    topics: Sequence[Topic] = ()
    preview_rows: int = 0

    def messages(self, spark: SparkSession) -> DataFrame:
        df = self.read(spark)
        for step in self.steps:
            df = df.transform(step)
        return df

    def run(self, spark: SparkSession) -> None:
        """Publish to every topic; a feed without topics is an error.

        A preview computes the feed once more, so there is none unless asked for.
        """
        self._send(self._previewed(spark))

    def run_checked(self, spark: SparkSession) -> DataFrame:
        """Publish, then compare what was sent with what each topic got in this run, one row per
        topic in their order; see :func:`delivery_check` for the counts.

        What a topic held before is counted before anything is sent, so a check reads the topic's
        retention twice. Messages that others send meanwhile count as unexpected.
        """
        if not self.topics:
            raise ValueError("the feed has no topic")
        reports = []
        with ExitStack() as tables:
            known = [
                tables.enter_context(staged(message_counts(read_topic(spark, topic)), "before"))
                if self._exists(spark, topic)
                else None
                for topic in self.topics
            ]
            sent = tables.enter_context(staged(self._previewed(spark), "sent"))
            self._send(sent)
            for number, (topic, old) in enumerate(zip(self.topics, known, strict=True)):
                row = delivery_check(sent, read_topic(spark, topic), old).first()
                reports.append((*row, number))
        kinds = ", ".join([*(f"{n} bigint" for n in REPORT), "topic int"])
        return spark.createDataFrame(reports, kinds)

    def run_counted(self, spark: SparkSession) -> DataFrame:
        """Publish, and compare what the sending job counted on the way with what stands in each topic
        between its end before and its end after: one row per topic in their order, ``sent_`` and
        ``received_`` messages, bytes, nulls and checksum, and whether they agree (``delivered``).

        Sent messages are not read a second time, and of a topic only what this run added, however
        much it retains. Messages that others send meanwhile make a topic disagree;
        :meth:`run_checked` tells missing from unexpected ones, at the price of reading all.
        """
        if not self.topics:
            raise ValueError("the feed has no topic")
        df, rows = self._previewed(spark), []
        with ExitStack() as tables:
            if len(self.topics) > 1:
                df = tables.enter_context(staged(df, "fan-out"))
            for number, topic in enumerate(self.topics):
                start = position(spark, topic)
                sent = publish_counted(df, topic)
                received = measured(read_between(spark, topic, start, position(spark, topic)))
                counts = [Decimal(c[m]) if m == "checksum" else c[m] for c in (sent, received) for m in MEASURES]
                rows.append((number, *counts, sent == received))
        kinds = [f"{side}_{m} {'decimal(30,0)' if m == 'checksum' else 'bigint'}" for side in ("sent", "received") for m in MEASURES]
        return spark.createDataFrame(rows, ", ".join(["topic int", *kinds, "delivered boolean"]))

    def _previewed(self, spark: SparkSession) -> DataFrame:
        df = self.messages(spark)
        if self.preview_rows:
            df.printSchema()
            df.show(self.preview_rows, truncate=False)
        return df

    def _send(self, df: DataFrame) -> None:
        if not self.topics:
            raise ValueError("the feed has no topic")
        fan_out(df, self.topics)

    @staticmethod
    def _exists(spark: SparkSession, topic: Topic) -> bool:
        """A folder that stands in for a topic may not be there before the first message."""
        if "path" not in topic.options:
            return True
        files, path = hadoop_path(spark, topic.options["path"])
        return files.exists(path)
