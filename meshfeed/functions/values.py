"""Lenient numbers, epoch milliseconds and map lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshfeed.functions.payload import named


def as_number(df: DataFrame, name: str) -> Column:
    """Column ``name`` for comparing with a number.

    A text column is read as a double and text that is no number is null, so neither '1.0' nor
    an empty string stops a job. Number columns stay as they are and can be pushed to the scan.
    """
    column = named(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return column.try_cast("double")
    return column


def epoch_seconds(millis: Column) -> Column:
    """Whole seconds of epoch milliseconds, the fraction cut off towards zero."""
    return (millis / F.lit(1000)).cast("bigint")


def epoch_text(millis: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text in the session zone."""
    return F.from_unixtime(epoch_seconds(millis))


def epoch_time(millis: Column) -> Column:
    """The same instant as a timestamp."""
    return F.timestamp_seconds(epoch_seconds(millis))


def map_value(mapping: str, key: str) -> Column:
    """The value under ``key``, null if the map does not have it."""
    return named(mapping)[key]
