"""Daily feed of new activations with a low score, and its trial."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from meshfeed.operators.columns import encode_rows, rename_columns, select_except
from meshfeed.operators.rows import filter_below, first_rows

# Columns and limit of the published feed.
HIDDEN = ("hr", "mdn1", "mdn2", "mdn3", "mins", "sec")
RENAMED = {
    "date_1": "outage_date_1",
    "date_2": "outage_date_2",
    "date_3": "outage_date_3",
}
TRIAL_RENAMED = {
    "date1": "outage_date_1",
    "date2": "outage_date_2",
    "date3": "outage_date_3",
}
SCORE = "AVG_SCORE_1_3"
SCORE_LIMIT = 85
DAYS_BACK = 7
TRIAL_SIZE = 2


def activation_rows(df: DataFrame, renamed: Mapping[str, str] = RENAMED) -> DataFrame:
    return rename_columns(select_except(df, HIDDEN), renamed)


def low_score_feed(
    df: DataFrame,
    limit: float = SCORE_LIMIT,
    score: str = SCORE,
    renamed: Mapping[str, str] = RENAMED,
) -> DataFrame:
    return encode_rows(filter_below(activation_rows(df, renamed), score, limit))


def trial_feed(
    df: DataFrame,
    order_by: Sequence[str],
    count: int = TRIAL_SIZE,
    renamed: Mapping[str, str] = TRIAL_RENAMED,
) -> DataFrame:
    """The first rows whatever their score."""
    return encode_rows(activation_rows(first_rows(df, count, order_by), renamed))
