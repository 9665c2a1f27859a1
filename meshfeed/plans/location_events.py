"""Ingest of location events into JSON files by date and hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from meshfeed.functions.values import map_value
from meshfeed.operators.columns import decode_messages, drop_columns, epoch_parts

# Fields of the event messages and the layout of the files.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("eventType", T.IntegerType(), True),
        T.StructField("location", T.MapType(T.StringType(), T.StringType()), True),
        T.StructField("timestamp", T.LongType(), True),
        T.StructField("data", T.StringType(), True),
    ]
)
PARTITION_BY = ("date", "hour")
COMPRESSION = "gzip"
INTERVAL = "60 seconds"


def location_records(messages: DataFrame, corrupt_column: str | None = None) -> DataFrame:
    """Event messages, batch or stream, as rows with coordinates, date and hour. Malformed messages
    are rows of nulls, kept as text in ``corrupt_column`` if that is named."""
    events = epoch_parts(decode_messages(messages, EVENT_SCHEMA, corrupt_column), "timestamp")
    events = events.withColumns(
        {
            "latitude": map_value("location", "latitude"),
            "longitude": map_value("location", "longitude"),
        }
    )
    return drop_columns(events, ["location"])
