"""Batch tables: Parquet, CSV, whole files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_csv(
    spark: SparkSession,
    *paths: str,
    schema: T.StructType | None = None,
    infer: bool = False,
    nested: bool = False,
    glob: str | None = None,
) -> DataFrame:
    """CSV files with a header row.

    With ``schema`` nothing is read twice. ``infer`` reads all the data an extra time to find
    types. With neither, every column is text. ``nested`` takes files at any depth below the
    paths (and so gives up partition columns); ``glob`` keeps only matching file names.

    Spark assigns CSV fields by position. Files whose header differs from the schema, or from
    the first file, are refused here rather than read with columns swapped.
    """
    reader = spark.read.option("header", "true").option("enforceSchema", "false")
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", "true")
    if nested:
        reader = reader.option("recursiveFileLookup", "true")
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.csv(list(paths))


def read_whole_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """One row per file: column ``value`` holds the file's whole content as text.

    A file is one row in one task, so one of over 2 GB, the most a row can hold, is an error.
    """
    reader = spark.read.format("binaryFile")
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(F.col("content").cast("string").alias("value"))
