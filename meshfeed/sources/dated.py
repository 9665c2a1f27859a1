"""Input chosen by date: one day some days back, or a window of days."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshfeed.functions.payload import named
from meshfeed.sources.tables import read_csv, read_parquet

DAY_FORMAT = "%Y-%m-%d"


def as_day(value: str | date) -> date:
    if isinstance(value, datetime):
        return value.date()
    return value if isinstance(value, date) else datetime.strptime(value, DAY_FORMAT).date()


def day_before(run_date: str | date, days: int) -> str:
    return (as_day(run_date) - timedelta(days=days)).strftime(DAY_FORMAT)


def window_days(target: str | date, days_before: int) -> list[str]:
    """The days from ``days_before`` before the target up to the target, both included."""
    return [day_before(target, n) for n in range(days_before, -1, -1)]


def dated_path(root: str, run_date: str | date, days_back: int, name: str = "{day}") -> str:
    """Path of the input of ``days_back`` days before the run, e.g. ``name='Report_{day}'``."""
    return f"{root.rstrip('/')}/{name.format(day=day_before(run_date, days_back))}"


def read_dated_parquet(
    spark: SparkSession, root: str, run_date: str | date, days_back: int = 1
) -> DataFrame:
    """The one-directory-per-day layout ``root/2024-01-31``."""
    return read_parquet(spark, dated_path(root, run_date, days_back))


def _in_days(df: DataFrame, name: str, first: str, last: str) -> Column:
    """``first <= day <= last``, written so that it prunes partitions or reaches the scan."""
    column, kind = named(name), df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        start = F.lit(first).cast(kind)
        end = F.lit(day_before(last, -1)).cast(kind)
        return (column >= start) & (column < end)
    if isinstance(kind, T.DateType):
        return column.between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return column.between(first, last)


def on_day(df: DataFrame, name: str, run_date: str | date, days_back: int = 1) -> DataFrame:
    """Rows of the day ``days_back`` days before the run, by a date, time or text column."""
    day = day_before(run_date, days_back)
    return df.filter(_in_days(df, name, day, day))


def in_window(df: DataFrame, name: str, target: str | date, days_before: int = 3) -> DataFrame:
    """Rows from ``days_before`` days before the target to the target, both included."""
    days = window_days(target, days_before)
    return df.filter(_in_days(df, name, days[0], days[-1]))


def read_csv_window(
    spark: SparkSession,
    root: str,
    target: str | date,
    days_before: int = 3,
    name: str = "{target}_{day}.csv",
    schema: T.StructType | None = None,
    allow_missing: bool = False,
) -> DataFrame:
    """One CSV file or folder per day of the window, names made from ``name``.

    A missing day is an error, unless ``allow_missing``: then the days are matched by one path
    pattern, and whichever are there are read; that there is none at all stays an error.
    """
    days = window_days(target, days_before)
    target_day = day_before(target, 0)
    if allow_missing:
        any_day = "{" + ",".join(days) + "}"
        found = f"{root.rstrip('/')}/{name.format(target=target_day, day=any_day)}"
        return read_csv(spark, found, schema=schema)
    paths = [f"{root.rstrip('/')}/{name.format(target=target_day, day=d)}" for d in days]
    return read_csv(spark, *paths, schema=schema)
