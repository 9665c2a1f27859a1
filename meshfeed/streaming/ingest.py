"""Streams of messages into JSON files. The decoding steps are those of the batch side."""

from __future__ import annotations

import signal
import threading
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from meshfeed.functions.payload import named


def _writer(df: DataFrame, checkpoint: str, interval: str | None, name: str | None):
    writer = df.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    if name:
        writer = writer.queryName(name)
    if interval is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval)


def _file_options(
    compression: str | None, keep_nulls: bool, max_records_per_file: int | None
) -> dict[str, str]:
    options = {"ignoreNullFields": str(not keep_nulls).lower()}
    if compression:
        options["compression"] = compression
    if max_records_per_file:
        options["maxRecordsPerFile"] = str(max_records_per_file)
    return options


def rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of an output partition brought together, and large ones split by bytes.

    Otherwise every task writes a small file into every partition it has rows for. The session's
    advisory partition size decides where an hour that holds most of the rows is split.
    """
    return df.hint("rebalance", *[named(n) for n in partition_by])


def start_json_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = "10 seconds",
    partition_by: Sequence[str] = (),
    compression: str | None = None,
    keep_nulls: bool = False,
    name: str | None = None,
    rebalance: bool = False,
    max_records_per_file: int | None = None,
) -> StreamingQuery:
    """Append to JSON files under ``path``; ``checkpoint`` must be a shared folder.

    A micro-batch starts every ``interval``; with ``None`` what is there now is processed and
    the query ends. Rows are written where they are decoded, without a shuffle, which suits a
    live stream: a batch falls into one hour or two. For a backlog spread over many partitions
    set ``rebalance``, see :func:`rebalanced`.

    The file sink keeps a log of all files it ever wrote. A job that runs for months is better off
    with :func:`start_json_batches`.
    """
    if rebalance:
        df = rebalanced(df, partition_by)
    writer = _writer(df, checkpoint, interval, name).format("json").option("path", path)
    writer = writer.options(**_file_options(compression, keep_nulls, max_records_per_file))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start()


def start_json_batches(
    df: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = "10 seconds",
    partition_by: Sequence[str] = (),
    compression: str | None = None,
    keep_nulls: bool = False,
    name: str | None = None,
    rebalance: bool = False,
    max_records_per_file: int | None = None,
) -> StreamingQuery:
    """JSON files in one folder ``batch=<number>`` under ``path`` for each micro-batch.

    There is no log of files that grows. A batch that is run again after a failure overwrites its own
    folder, so its rows are there once. Readers see ``batch`` as a partition column. Choices as in
    :func:`start_json_sink`.
    """
    options = _file_options(compression, keep_nulls, max_records_per_file)

    def write(rows: DataFrame, number: int) -> None:
        if rebalance:
            rows = rebalanced(rows, partition_by)
        writer = rows.write.mode("overwrite").options(**options).partitionBy(*partition_by)
        writer.json(f"{path.rstrip('/')}/batch={number}")

    return _writer(df, checkpoint, interval, name).foreachBatch(write).start()


def run_until_stopped(query: StreamingQuery, timeout: float | None = None) -> bool:
    """Wait for the query; stop it when interrupted, terminated (SIGTERM) or after ``timeout`` seconds.

    True if it ended by itself. A termination lets the batch that is running finish, so that nothing
    has to be done again. Failures of the query are raised.
    """
    asked = threading.Event()
    in_main = threading.current_thread() is threading.main_thread()
    before = signal.signal(signal.SIGTERM, lambda *_: asked.set()) if in_main else None
    end = None if timeout is None else time.monotonic() + timeout
    try:
        while not asked.is_set() and (end is None or time.monotonic() < end):
            if query.awaitTermination(1):
                return True
        while asked.is_set() and query.isActive and query.status["isTriggerActive"]:
            query.awaitTermination(1)
        return False
    finally:
        if in_main:
            signal.signal(signal.SIGTERM, before)
        if query.isActive:
            query.stop()


def run_available(query: StreamingQuery, timeout: float | None = None) -> None:
    """Wait for a query that was started with ``interval=None``, however long it takes."""
    if not run_until_stopped(query, timeout):
        raise TimeoutError(f"stream not done after {timeout} s")


def archive_options(folder: str) -> dict[str, str]:
    """File-source options that move consumed files under ``folder``, keeping their path.

    A file is moved once a later batch has been planned, so the newest ones stay in place.
    """
    return {"cleanSource": "archive", "sourceArchiveDir": folder}
