"""Keep a measurement only where its alert flag is raised."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from meshfeed.functions.payload import named

ALERT_SUFFIX = "_alert"
NOT_RAISED = "0"


def alert_name(feature: str) -> str:
    return feature + ALERT_SUFFIX


def when_alerting(feature: str) -> Column:
    """The feature, or null unless its flag is raised.

    Flags are text: everything but ``'0'`` is raised, ``'0.0'`` too. A missing flag is not raised.
    """
    return F.when(named(alert_name(feature)) != NOT_RAISED, named(feature))


def alerting_json(features: Sequence[str]) -> Column:
    """JSON object text that holds only the alerting features."""
    return F.to_json(F.struct(*[when_alerting(f).alias(f) for f in features]))


def alerting_map(features: Sequence[str]) -> Column:
    """The same as a map, which nests in a document that spells out its own nulls."""
    pairs = [part for f in features for part in (F.lit(f), when_alerting(f).cast("string"))]
    return F.map_filter(F.create_map(*pairs), lambda _, value: value.isNotNull())
