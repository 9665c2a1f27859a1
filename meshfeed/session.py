"""Session settings, and the shared folder that jobs stage tables in."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# hour() and to_date() follow the session zone; all feeds are defined in UTC
ZONE = {"spark.sql.session.timeZone": "UTC"}

#: Set only where the user has set nothing.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    # size shuffle partitions by bytes, not by the number of free cores
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # document messages are collected group by group: after this many a task goes over to
    # sorting, which spills, and holds one group at a time
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "8",
}


def build_session(
    app_name: str,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    settings: Mapping[str, str] | None = None,
) -> SparkSession:
    """Start a session with the settings the feeds rely on.

    ``shuffle_partitions`` is the number a shuffle starts with before adaptive execution merges
    small ones; about (bytes shuffled / 128 MB) is right, so a large cluster sets it in thousands.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    asked = {**ZONE, **(settings or {})}
    if shuffle_partitions:
        asked["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in asked.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for key, value in SETTINGS.items():
        if key not in asked and not given.contains(key):
            spark.conf.set(key, value)
    return spark


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="meshfeed-")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = _local_root()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


_folders: ContextVar[list[str] | None] = ContextVar("folders of the open block of temporary tables", default=None)


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Everything that reads the result sees the same rows, whatever executors are lost later. The table
    stays until the cluster clears the folder, or until the :func:`temporary_tables` block around ends.
    """
    folder = shared_folder(df.sparkSession, purpose)
    if (made := _folders.get()) is not None:
        made.append(folder)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def hadoop_path(spark: SparkSession, path: str):
    """The file system that holds ``path``, and the path in it. PySpark has no other way to move or
    delete files of any file system; it needs a classic session, not Spark Connect."""
    goal = spark._jvm.org.apache.hadoop.fs.Path(path)
    return goal.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), goal


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder and all in it, if it is there."""
    files, path = hadoop_path(spark, folder)
    files.delete(path, True)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that :func:`stage` writes within the block are deleted after it, also if it fails.

    An operator's result reads the tables that it staged when it is read itself, so it must have been
    written by the end of the block. Blocks nest; a table belongs to the innermost.
    """
    made: list[str] = []
    outer = _folders.set(made)
    try:
        yield
    finally:
        _folders.reset(outer)
        for folder in made:
            delete_folder(spark, folder)


@contextmanager
def staged(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """``df`` as a written table for as long as the block runs; the files are deleted after it,
    also if it fails. What reads the table must be done by then."""
    folder = shared_folder(df.sparkSession, purpose)
    try:
        df.write.parquet(folder)
        yield df.sparkSession.read.schema(df.schema).parquet(folder)
    finally:
        delete_folder(df.sparkSession, folder)
