"""Batches of a stream that readers see whole or not at all, and their compaction.

A batch is written into a folder of its own, and is there once an entry of a log names it. The log is
a row of numbered small files; an entry adds folders and removes others in one step.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from meshfeed import files
from meshfeed.functions.payload import named
from meshfeed.session import staged
from meshfeed.streaming.ingest import _file_options, _writer, rebalanced

LOG = "_commits"
#: Partition column that tells the folders apart; readers do not see it.
FOLDER = "commit_folder"
RECORDS, REJECTED = "records", "rejected"
#: A summary of the log is written after so many entries; readers start from the last one.
SUMMARY_EVERY = 64
HOUR = 3_600_000


@dataclass
class State:
    """What the log's entries up to ``number`` amount to."""

    number: int = -1
    #: the last batch that is there
    batch: int = -1
    #: folder -> sink, commit time (ms), batch or None
    folders: dict[str, list] = field(default_factory=dict)
    #: folder that was there once -> when it was removed
    removed: dict[str, int] = field(default_factory=dict)

    def apply(self, number: int, entry: Mapping) -> None:
        self.number = number
        if entry["batch"] is not None:
            self.batch = max(self.batch, entry["batch"])
        for folder in entry["remove"]:
            if self.folders.pop(folder, None) is not None:
                self.removed[folder] = entry["time"]
        for folder, sink in entry["add"].items():
            self.folders[folder] = [sink, entry["stamp"], entry["batch"]]


class Commits:
    """The log of the batches under ``path``. Needs a file system that renames in one step without
    overwriting, as HDFS does."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path, self.log = spark, path.rstrip("/"), files.join(path, LOG)

    def state(self, known: State | None = None) -> State:
        """The present state, from the last summary on, or from one that is ``known``."""
        found = files.names(self.spark, self.log)
        state = known or State()
        if known is None:
            summaries = [n for n in found if n.startswith("upto-")]
            if summaries:
                state = State(**json.loads(files.read_text(self.spark, files.join(self.log, summaries[-1]))))
        for name in found:
            if name[:1].isdigit() and int(name.split(".")[0]) > state.number:
                entry = json.loads(files.read_text(self.spark, files.join(self.log, name)))
                state.apply(int(name.split(".")[0]), entry)
        return state

    def append(
        self,
        state: State,
        add: Mapping[str, str],
        remove: Sequence[str] = (),
        batch: int | None = None,
        stamp: int | None = None,
    ) -> bool:
        """Add and remove folders in one step, and bring ``state`` up to date.

        False if nothing was done because someone else had done it: the batch is there already, or a
        folder to be removed is not there any more. ``stamp`` is the time that the added rows count as
        committed at; now, unless they were committed before.
        """
        while True:
            self.state(state)
            if batch is not None and batch <= state.batch or any(f not in state.folders for f in remove):
                return False
            now = int(time.time() * 1000)
            entry = {"batch": batch, "time": now, "stamp": stamp or now, "add": dict(add), "remove": list(remove)}
            number = state.number + 1
            if files.write_new(self.spark, files.join(self.log, f"{number:012d}.json"), json.dumps(entry)):
                state.apply(number, entry)
                break
        if (state.number + 1) % SUMMARY_EVERY == 0:
            files.write_new(self.spark, files.join(self.log, f"upto-{state.number:012d}.json"), json.dumps(vars(state)))
        return True

    def folders(self, sink: str = RECORDS) -> list[str]:
        return [files.join(self.path, f) for f, (s, _, _) in sorted(self.state().folders.items()) if s == sink]

    def read(self, schema: T.StructType, sink: str = RECORDS) -> DataFrame:
        """The rows of all committed batches, as a table that later commits do not change."""
        folders = self.folders(sink)
        if not folders:
            return self.spark.createDataFrame([], schema)
        return _of_table(self.spark, self.path, schema).json(folders).select(*[named(n) for n in schema.names])

    def vacuum(self, keep_ms: int) -> list[str]:
        """Delete folders that no entry names, or none any more for ``keep_ms``; returns them.

        Those are left by attempts that failed, and by compaction. A reader that began before a
        compaction may still read the folders it replaced, so keep them longer than any reader runs,
        and longer than a batch takes to be written.
        """
        state, now, gone = self.state(), int(time.time() * 1000), []
        for folder in files.names(self.spark, self.path):
            if folder.startswith(f"{FOLDER}=") and folder not in state.folders:
                whole = files.join(self.path, folder)
                since = state.removed.get(folder) or files.modified(self.spark, whole)
                if now - since >= keep_ms:
                    files.delete(self.spark, whole)
                    gone.append(folder)
        return gone


def _of_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrameReader:
    """Folders are levels of one partitioned table, so that they can be read together."""
    return spark.read.schema(schema).option("basePath", path)


def _folder(what: str, sink: str) -> str:
    return f"{FOLDER}={what}-{uuid.uuid4().hex}-{sink}"


def malformed(corrupt_column: str) -> Callable[[DataFrame], tuple[DataFrame, DataFrame]]:
    """Splits decoded messages into records, without ``corrupt_column``, and the messages that were not
    JSON, as column ``value``."""

    def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        bad = named(corrupt_column).isNotNull()
        return rows.where(~bad).drop(corrupt_column), rows.where(bad).select(named(corrupt_column).alias("value"))

    return split


def start_committed_batches(
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
    split: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None,
) -> StreamingQuery:
    """JSON files of each micro-batch in a folder of its own, committed in one step: read them with
    :meth:`Commits.read`.

    A batch that is half written, or whose attempt failed, is in no reader's table. A batch that runs
    again after its commit changes nothing. ``split`` makes records and rejected rows of each batch,
    such as :func:`malformed`; it is then staged once, and both are committed together, the rejected
    ones as JSON objects without partitions. Other choices as in
    :func:`~meshfeed.streaming.ingest.start_json_sink`; ``path`` belongs to one stream.
    """
    options = _file_options(compression, keep_nulls, max_records_per_file)
    states: list[State] = []

    def put(rows: DataFrame, folder: str, by: Sequence[str]) -> None:
        if rebalance and by:
            rows = rebalanced(rows, by)
        rows.write.options(**options).partitionBy(*by).json(files.join(path, folder))

    def write(rows: DataFrame, number: int) -> None:
        log = Commits(rows.sparkSession, path)
        state = states[0] if states else log.state()
        states[:] = [state]
        if number <= state.batch:
            return
        good = _folder(f"batch{number}", RECORDS)
        if split is None:
            put(rows, good, partition_by)
            log.append(state, {good: RECORDS}, batch=number)
            return
        bad = _folder(f"batch{number}", REJECTED)
        with staged(rows, "batch") as table:
            records, rejected = split(table)
            put(records, good, partition_by)
            put(rejected, bad, ())
        log.append(state, {good: RECORDS, bad: REJECTED}, batch=number)

    return _writer(df, checkpoint, interval, name).foreachBatch(write).start()


def compact(
    spark: SparkSession,
    path: str,
    before: int,
    file_bytes: int = 128 << 20,
    partition_by: Sequence[str] = (),
    compression: str | None = None,
    sink: str = RECORDS,
) -> int:
    """Rewrite the batches of every hour that ended by ``before`` (epoch ms) into files of about
    ``file_bytes``, and swap them in the log; returns how many folders were replaced.

    Hours are those of the commits. Lines are copied as they are, within their partitions. Readers see
    the same rows before, during and after; the stream may go on meanwhile. An hour in one
    compacted folder already is left alone. If another compaction was faster, this one's work is void.
    """
    log = Commits(spark, path)
    state = log.state()
    hours: dict[int, list[str]] = {}
    for folder, (of, stamp, _) in sorted(state.folders.items()):
        if of == sink and (stamp // HOUR + 1) * HOUR <= before:
            hours.setdefault(stamp // HOUR, []).append(folder)
    shape = T.StructType([T.StructField(n, T.StringType(), True) for n in ("value", *partition_by)])
    replaced = 0
    for hour, old in sorted(hours.items()):
        if len(old) < 2:
            continue
        sources = [files.join(path, f) for f in old]
        parts = max(1, -(-sum(files.size(spark, f) for f in sources) // file_bytes))
        lines = _of_table(spark, path, shape).text(sources).select(*map(named, shape.names))
        lines = lines.repartition(parts) if not partition_by else lines.hint("rebalance", *map(named, partition_by))
        goal = _folder(f"hour{hour}", sink)
        writer = lines.write.partitionBy(*partition_by)
        if compression:
            writer = writer.option("compression", compression)
        writer.text(files.join(path, goal))
        if log.append(state, {goal: sink}, remove=old, stamp=hour * HOUR):
            replaced += len(old)
        else:
            files.delete(spark, files.join(path, goal))
    return replaced
