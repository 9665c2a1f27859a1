"""Projection steps. Each takes a DataFrame and returns one, so they chain with ``transform``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshfeed.functions.payload import json_object, named, parsed_message
from meshfeed.functions.values import epoch_text, epoch_time


def project(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[named(n) for n in names])


def select_except(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """All columns but those named, in their order. Names are matched to the letter case."""
    return project(df, [n for n in df.columns if n not in set(names)])


def rename_columns(df: DataFrame, names: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Rename columns. A name that is not there is passed over, or an error if ``strict``."""
    absent = sorted(set(names) - set(df.columns))
    if strict and absent:
        raise ValueError(f"no such columns: {', '.join(absent)}")
    return df.withColumnsRenamed(dict(names))


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*names)


def add_constant(df: DataFrame, name: str, value: Any) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def derive_link(df: DataFrame, name: str, prefix: str, key: str) -> DataFrame:
    """Text column ``prefix`` + key; null where the key is null."""
    return df.withColumn(name, F.concat(F.lit(prefix), named(key).cast("string")))


def fill_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    return df.fillna(dict(defaults))


def cast_payload(df: DataFrame, name: str = "value") -> DataFrame:
    """The message payload alone, as text."""
    return df.select(named(name).cast("string").alias(name))


def encode_rows(df: DataFrame, keep_nulls: bool = False) -> DataFrame:
    """Each row as one message: column ``value`` with the row as a JSON object."""
    return df.select(json_object("*", keep_nulls=keep_nulls).alias("value"))


def decode_messages(
    df: DataFrame,
    schema: T.StructType,
    corrupt_column: str | None = None,
    value: str = "value",
) -> DataFrame:
    """The opposite of :func:`encode_rows`: the fields of ``schema`` as top-level columns."""
    parsed = parsed_message(named(value), schema, corrupt_column)
    return df.select(parsed.alias("parsed")).select("parsed.*")


def epoch_parts(df: DataFrame, millis: str) -> DataFrame:
    """Add ``date_parsed`` text, ``hour`` and ``date`` of a column of epoch milliseconds."""
    instant = epoch_time(named(millis))
    return df.withColumns(
        {
            "date_parsed": epoch_text(named(millis)),
            "hour": F.hour(instant),
            "date": F.to_date(instant),
        }
    )
