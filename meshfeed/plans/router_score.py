"""Daily router score feed, its samples, and the ingest of its messages.

A router row lists its device models as an array of arrays. The feed has one message per router
row and model, for the models asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from meshfeed.operators.columns import decode_messages, encode_rows, fill_defaults, project
from meshfeed.operators.rows import distinct_rows, explode_nested, filter_in_list, first_rows

# Models, column names and defaults of the published feeds.
HOME_MODELS = (
    "ASK-NCQ1338",
    "ASK-NCQ1338FA",
    "XCI55AX",
    "CR1000A",
    "WNC-CR200A",
    "ASK-NCM1100",
)
FIBER_MODELS = ("G3100", "CR1000A", "CR1000B")
DEFAULTS = {"mdn": "0000000000", "cust_id": "000000000"}
MODEL_LISTS = "dg_model"
MODEL = "dg_model_indiv"
IDENTITY = ("serial_num", "mdn", "cust_id", "date")
SCORES = ("poor_rssi", "poor_phyrate", "num_station", "home_score")
ANONYMOUS = ("serial_num", "date", *SCORES, MODEL)
SAMPLE_SIZE = 10

MESSAGE_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType(), True) for name in IDENTITY]
    + [T.StructField(name, T.FloatType(), True) for name in SCORES]
    + [T.StructField(MODEL, T.StringType(), True)]
)


def routers_by_model(df: DataFrame, models: Sequence[str]) -> DataFrame:
    """Router rows once per matching model entry.

    The model filter comes before any column is dropped or any row merged, so a router that has
    a matching model anywhere in its lists is never lost.
    """
    return filter_in_list(explode_nested(df, MODEL_LISTS, MODEL), MODEL, models)


def router_score_rows(df: DataFrame, models: Sequence[str] = HOME_MODELS) -> DataFrame:
    """Identity, scores and model; defaults are filled in after the distinct, so a row with no
    number and a row that holds the default number both stay."""
    rows = project(routers_by_model(df, models), [*IDENTITY, *SCORES, MODEL])
    return fill_defaults(distinct_rows(rows), DEFAULTS)


def router_score_feed(df: DataFrame, models: Sequence[str] = HOME_MODELS) -> DataFrame:
    return encode_rows(router_score_rows(df, models))


def router_score_rows_anon(df: DataFrame, models: Sequence[str] = FIBER_MODELS) -> DataFrame:
    """The same without customer identifiers."""
    return distinct_rows(project(routers_by_model(df, models), ANONYMOUS))


def router_score_feed_anon(df: DataFrame, models: Sequence[str] = FIBER_MODELS) -> DataFrame:
    return encode_rows(router_score_rows_anon(df, models))


def sample_feed(
    df: DataFrame, models: Sequence[str] = HOME_MODELS, count: int = SAMPLE_SIZE
) -> DataFrame:
    """A few messages with the identity columns only."""
    rows = distinct_rows(project(routers_by_model(df, models), IDENTITY))
    return encode_rows(first_rows(fill_defaults(rows, DEFAULTS), count, IDENTITY))


def sample_feed_anon(
    df: DataFrame, models: Sequence[str] = FIBER_MODELS, count: int = SAMPLE_SIZE
) -> DataFrame:
    return encode_rows(first_rows(router_score_rows_anon(df, models), count, ANONYMOUS))


def score_records(messages: DataFrame, corrupt_column: str | None = None) -> DataFrame:
    """Score messages, batch or stream, back as rows."""
    return decode_messages(messages, MESSAGE_SCHEMA, corrupt_column)
