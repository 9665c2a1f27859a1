"""Queries over CSV files and dated directories, written from the test tables first."""

from __future__ import annotations

from pyspark.sql import functions as F

from meshfeed.catalog.registry import query, table
from meshfeed.catalog.standins import ACTIVATION_JSON_SQL, activations
from meshfeed.plans import activation
from meshfeed.session import shared_folder
from meshfeed.sources import dated
from meshfeed.sources.headers import read_csv_by_name
from meshfeed.sources.tables import read_csv

_TARGET = "2024-01-16"


def _written_csv(df, purpose):
    folder = shared_folder(df.sparkSession, purpose)
    df.write.option("header", "true").csv(folder)
    return folder


@query("""
    select cast(event_id as int) as event_id, cast(user_id as int) as user_id, event_type, value
    from events""")
def csv_infer_schema(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return read_csv(spark, _written_csv(events, "csv"), infer=True)


@query("""
    select cast(event_id as varchar) as event_id, cast(user_id as varchar) as user_id,
      event_type as kind
    from events""")
def csv_recursive_scan(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.col("event_type").alias("kind"), "event_type"
    )
    folder = shared_folder(spark, "csv-tree")
    events.write.option("header", "true").partitionBy("event_type").csv(folder)
    return read_csv(spark, folder, nested=True)


@query("""
    select event_id, user_id, event_type, case when event_type <> 'view' then value end as value
    from events""")
def csv_columns_by_name(spark, sf_dir):
    """A tree of files with three headers: the columns in two orders, and one without a column."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    folder = shared_folder(spark, "csv-orders")
    kinds = F.col("event_type")
    for name, rows in {
        "usual": events.filter(~kinds.isin("click", "view")),
        "turned": events.filter(kinds == "click").select("value", "event_type", "event_id", "user_id"),
        "less/deep": events.filter(kinds == "view").select("event_type", "event_id", "user_id"),
    }.items():
        rows.write.option("header", "true").csv(f"{folder}/{name}")
    return read_csv_by_name(spark, folder, schema=events.schema)


def _by_day(df):
    """Each day in few files."""
    return df.hint("rebalance", "day")


def _daily_events(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "value", F.col("ts").cast("date").alias("day")
    )


@query("""
    select event_id, user_id, value, cast(ts as date) as "day" from events
    where cast(ts as date) between date '2024-01-13' and date '2024-01-16'""")
def date_window_scan(spark, sf_dir):
    folder = shared_folder(spark, "csv-days")
    events = _daily_events(spark, sf_dir)
    _by_day(events).write.option("header", "true").partitionBy("day").csv(folder)
    return dated.in_window(read_csv(spark, folder, schema=events.schema), "day", _TARGET)


@query("""
    select event_id, user_id, value from events
    where cast(ts as date) between date '2024-01-13' and date '2024-01-16'""")
def date_window_paths(spark, sf_dir):
    """The same window as a list of paths, one for each day."""
    folder = shared_folder(spark, "csv-days")
    events = _daily_events(spark, sf_dir)
    _by_day(events).write.option("header", "true").partitionBy("day").csv(folder)
    schema = events.drop("day").schema
    return dated.read_csv_window(spark, folder, _TARGET, name="day={day}", schema=schema)


@query("""
    select event_id, user_id, value from events
    where cast(ts as date) in (date '2024-01-13', date '2024-01-14', date '2024-01-16')""")
def date_window_gaps(spark, sf_dir):
    """A window of day folders of which one is not there."""
    folder = shared_folder(spark, "csv-days")
    events = _daily_events(spark, sf_dir).filter("day <> '2024-01-15'")
    _by_day(events).write.option("header", "true").partitionBy("day").csv(folder)
    schema = events.drop("day").schema
    return dated.read_csv_window(
        spark, folder, _TARGET, name="day={day}", schema=schema, allow_missing=True
    )


@query("select * from events where cast(ts as date) = date '2024-01-15'")
def dated_input(spark, sf_dir):
    return dated.on_day(table(spark, sf_dir, "events"), "ts", _TARGET)


@query("""
    select event_id, user_id, value from events where cast(ts as date) = date '2024-01-09'""")
def dated_directory(spark, sf_dir):
    folder = shared_folder(spark, "days")
    _by_day(_daily_events(spark, sf_dir)).write.partitionBy("day").parquet(folder)
    path = dated.dated_path(folder, _TARGET, activation.DAYS_BACK, "day={day}")
    return spark.read.parquet(path)


@query(f"""
    select {ACTIVATION_JSON_SQL} as "value" from events
    where event_type <> 'signup' and value < 85""")
def low_score_feed(spark, sf_dir):
    rows = activations(spark, sf_dir)
    folder = _written_csv(rows, "activations")
    return activation.low_score_feed(read_csv(spark, folder, schema=rows.schema))


@query(f"""
    select {ACTIVATION_JSON_SQL} as "value" from events
    where event_type <> 'signup' and value < 85""")
def low_score_feed_inferred(spark, sf_dir):
    folder = _written_csv(activations(spark, sf_dir), "activations")
    return activation.low_score_feed(read_csv(spark, folder, infer=True))


@query(f"""
    select {ACTIVATION_JSON_SQL} as "value"
    from (select * from events order by event_id limit 2)""")
def trial_feed(spark, sf_dir):
    rows = activations(spark, sf_dir, "date")
    folder = _written_csv(rows, "trial")
    return activation.trial_feed(read_csv(spark, folder, schema=rows.schema), ["event_id"])
