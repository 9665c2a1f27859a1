"""CSV files whose headers name the same columns in different orders."""

from __future__ import annotations

import csv
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from fnmatch import fnmatchcase
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshfeed.functions.payload import named, string_schema
from meshfeed.session import hadoop_path
from meshfeed.sources.tables import read_csv

#: Files whose first lines are read at the same time.
READERS = 16


def data_files(spark: SparkSession, paths: Iterable[str], glob: str | None = None) -> list[str]:
    """All files below the paths (files, folders or patterns), but hidden ones, those in hidden folders
    and those that are empty; a path that matches nothing is an error."""
    found = []
    for path in paths:
        files, goal = hadoop_path(spark, path)
        roots = files.globStatus(goal)
        if not roots:
            raise FileNotFoundError(path)
        for root in roots:
            below = len(root.getPath().toString())
            listed = files.listFiles(root.getPath(), True)
            while listed.hasNext():
                status = listed.next()
                name = status.getPath().toString()
                inside = name[below:].split("/") if root.isDirectory() else [status.getPath().getName()]
                if any(part.startswith(("_", ".")) for part in inside if part) or not status.getLen():
                    continue
                if glob is None or fnmatchcase(status.getPath().getName(), glob):
                    found.append(name)
    return sorted(set(found))


def _first_line(spark: SparkSession, path: str) -> str:
    """A file's first line; what compressed it is told by the file's ending."""
    jvm = spark._jvm
    files, goal = hadoop_path(spark, path)
    stream = files.open(goal)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(files.getConf()).getCodec(goal)
        if codec is not None:
            stream = codec.createInputStream(stream)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return (reader.readLine() or "").removeprefix("\ufeff")
    finally:
        stream.close()


def header_census(spark: SparkSession, *paths: str, glob: str | None = None) -> dict[tuple[str, ...], list[str]]:
    """The files of each different header. Of a file only the first line is read, by a few threads of
    the driver, which holds one header for each order and the list of files that Spark holds as well."""
    found = data_files(spark, paths, glob)
    with ThreadPoolExecutor(READERS) as pool:
        lines = list(pool.map(lambda path: _first_line(spark, path), found))
    census: dict[tuple[str, ...], list[str]] = {}
    for path, line in zip(found, lines, strict=True):
        census.setdefault(tuple(next(csv.reader([line]), [])), []).append(path)
    return census


def read_csv_by_name(
    spark: SparkSession, *paths: str, schema: T.StructType | None = None, glob: str | None = None
) -> DataFrame:
    """CSV files at any depth below the paths, each column taken by its name in the file's own header.

    One scan for each different header, united by name: nothing is moved or read twice but the first
    lines. Columns and types are those of ``schema``; without it all columns that any header names, in
    order of appearance and as first spelled, as text. A column that a file does not have is null there, one that only the
    file has is left out. Types follow :func:`~meshfeed.sources.tables.read_csv`, so text that is no
    number is null in a number's column. Two columns of one name in a header are an error. Headers
    are one line, separated by commas.
    """
    census = header_census(spark, *paths, glob=glob)
    for header, members in census.items():
        if len({n.lower() for n in header}) < len(header):
            raise ValueError(f"two columns of one name in {members[0]}: {header}")
    if schema is None:
        spelled: dict[str, str] = {}
        for header in sorted(census, key=census.get):
            for n in header:
                spelled.setdefault(n.lower(), n)
        schema = string_schema(spelled.values())
    wanted = {f.name.lower(): f for f in schema}
    tables = []
    for header, members in sorted(census.items(), key=lambda item: item[1]):
        kinds = [wanted.get(n.lower(), T.StructField(n, T.StringType())).dataType for n in header]
        own = T.StructType([T.StructField(n, k, True) for n, k in zip(header, kinds, strict=True)])
        there = {n.lower() for n in header}
        columns = [
            (named(f.name) if f.name.lower() in there else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema
        ]
        tables.append(read_csv(spark, *members, schema=own).select(*columns))
    return reduce(DataFrame.unionByName, tables) if tables else spark.createDataFrame([], schema)
