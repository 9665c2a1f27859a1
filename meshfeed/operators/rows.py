"""Steps that change which rows there are: filters, array flattening, distinct, limit."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshfeed.functions.payload import named
from meshfeed.functions.values import as_number
from meshfeed.operators.columns import project


def filter_flag(df: DataFrame, flag: str, value: int = 1) -> DataFrame:
    """Rows whose flag equals ``value`` as a number; the flag may be text ('1', '1.0')."""
    return df.filter(as_number(df, flag) == value)


def filter_below(df: DataFrame, name: str, limit: float) -> DataFrame:
    """Rows strictly below the limit. Nulls, and text that is no number, do not pass."""
    return df.filter(as_number(df, name) < limit)


def filter_in_list(df: DataFrame, name: str, allowed: Sequence[Any]) -> DataFrame:
    return df.filter(named(name).isin(*allowed))


def flag_then_project(df: DataFrame, flag: str, names: Sequence[str]) -> DataFrame:
    """Filter on a flag that is not itself among the selected columns."""
    return project(filter_flag(df, flag), names)


def explode_nested(df: DataFrame, nested: str, into: str) -> DataFrame:
    """One row for each element of an array of arrays.

    An outer or inner array that is null or empty gives no row. (Flattening first would lose
    all of a row's elements as soon as one of its inner arrays is null.)
    """
    inner = df.withColumn(into, F.explode(named(nested)))
    return inner.withColumn(into, F.explode(named(into)))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct. Copies are merged on the map side first, so a row with very many
    copies reaches the shuffle once per task."""
    return df.dropDuplicates()


def first_rows(df: DataFrame, count: int, order_by: Sequence[str]) -> DataFrame:
    """The first rows in a stated order, so that a repeated run gives the same sample.

    Every task keeps only its own ``count`` first rows; there is no full sort.
    """
    return df.orderBy(*[named(n) for n in order_by]).limit(count)
