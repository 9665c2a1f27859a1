"""A stream of messages to several topics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from meshfeed import files
from meshfeed.functions.payload import named
from meshfeed.sinks.messages import publish
from meshfeed.sources.topics import MESSAGE_SCHEMA, Topic
from meshfeed.streaming.ingest import _writer


class Ledger:
    """Small files that say of each batch whether its rows are staged, and which topics have them."""

    def __init__(self, spark, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def rows(self, batch: int) -> str:
        return files.join(self.folder, f"rows-{batch}")

    def _mark(self, batch: int, what: str) -> str:
        return files.join(self.folder, f"batch-{batch}", what)

    def noted(self, batch: int, what: str) -> bool:
        return files.exists(self.spark, self._mark(batch, what))

    def note(self, batch: int, what: str) -> None:
        files.write_new(self.spark, self._mark(batch, what), "")

    def forget(self, batch: int) -> None:
        files.delete(self.spark, files.join(self.folder, f"batch-{batch}"))


def start_fan_out(
    df: DataFrame,
    topics: Mapping[str, Topic],
    ledger: str,
    checkpoint: str,
    interval: str | None = "10 seconds",
    name: str | None = None,
) -> StreamingQuery:
    """Send column ``value`` of every micro-batch to all ``topics``, whose names are file names.

    A batch is staged as a table in the shared folder ``ledger`` before anything is sent, so all topics
    get the same messages, also those that are served after a restart. The ledger notes each topic when
    it has the batch: a batch that runs again goes only to the topics that had not. A topic that was
    being written when the job died gets the batch again, so within one topic delivery is at least
    once, as with :func:`~meshfeed.sinks.messages.publish`. A topic that is added later gets the
    batches from then on.
    """
    for key in topics:
        if not key or "/" in key or key.startswith((".", "_")):
            raise ValueError(f"no name for a topic: {key!r}")

    def write(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        notes = Ledger(spark, ledger)
        left = [key for key in topics if not notes.noted(number, f"sent-{key}")]
        if left:
            if not notes.noted(number, "staged"):
                rows.select(named("value").cast("string").alias("value")).write.mode("overwrite").parquet(notes.rows(number))
                notes.note(number, "staged")
            table = spark.read.schema(MESSAGE_SCHEMA).parquet(notes.rows(number))
            for key in left:
                publish(table, topics[key])
                notes.note(number, f"sent-{key}")
        files.delete(spark, notes.rows(number))
        notes.forget(number - 1)  # this batch's notes stay: it may run again until its end is noted

    return _writer(df, checkpoint, interval, name).foreachBatch(write).start()
