"""Daily report of abnormal network sites with the measurements that raised an alert."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame

from meshfeed.functions.alerts import alert_name, alerting_map
from meshfeed.functions.payload import json_object, string_schema
from meshfeed.operators.columns import (
    add_constant,
    derive_link,
    drop_columns,
    encode_rows,
    rename_columns,
)
from meshfeed.operators.rows import flag_then_project
from meshfeed.sinks.documents import array_messages, document_message, write_json_array

# Columns of the site table and of the report.
KEYS = ("enodeb", "day", "event_day", "site", "region", "abnormal_kpi")
FEATURES = (
    "sip_dc_rate",
    "rrc_setup_failure",
    "bearer_drop_rate",
    "rtp_gap",
    "avgconnected_users",
    "dl_data_volume",
    "uptp_user_perceived_throughput",
)
TICKETS = ("nrb_ticket_counts", "w360_ticket_counts")
ALERTS = tuple(alert_name(f) for f in FEATURES)
FLAG = "has_abnormal_kpi"
RENAMED = {"day": "alert_day", "abnormal_kpi": "abnormal_kpi_count"}
VENDOR = "samsung"

SITE_COLUMNS = (*KEYS, *FEATURES, *TICKETS, *ALERTS)
SITE_SCHEMA = string_schema([*SITE_COLUMNS, FLAG])
REPORT_ORDER = ("enodeb", "alert_day", "event_day")


def site_alert_records(
    df: DataFrame,
    link_prefix: str,
    vendor: str = VENDOR,
    include_alert_flags: bool = True,
) -> DataFrame:
    """One record per abnormal site.

    ``features`` is a map of the alerting measurements, ``features_alert`` the flags as JSON
    text. ``link_prefix`` is the address that the site number is appended to.
    """
    sites = flag_then_project(df, FLAG, SITE_COLUMNS)
    sites = add_constant(rename_columns(sites, RENAMED), "vendor", vendor)
    sites = sites.withColumns(
        {"features": alerting_map(FEATURES), "features_alert": json_object(*ALERTS)}
    )
    sites = derive_link(sites, "link", link_prefix, "enodeb")
    unwanted = [*FEATURES, *ALERTS]
    if not include_alert_flags:
        unwanted.append("features_alert")
    return drop_columns(sites, unwanted)


def site_alert_report(df: DataFrame, link_prefix: str, **choices) -> DataFrame:
    """One message per abnormal site; missing values are spelled out as null."""
    return encode_rows(site_alert_records(df, link_prefix, **choices), keep_nulls=True)


#: How the report can be sent. The choice is the caller's; none depends on the report's size.
FORMS = {"records": None, "arrays": array_messages, "document": document_message}


@contextmanager
def site_alert_messages(
    records: DataFrame, form: str, order_by: Sequence[str] = REPORT_ORDER, **limits
) -> Iterator[DataFrame]:
    """Report records as messages for as long as the block runs: ``records`` one each, ``arrays`` in order
    and of bounded length, or ``document`` all in one."""
    if FORMS[form] is None:
        yield encode_rows(records, keep_nulls=True)
    else:
        with FORMS[form](records, order_by, **limits) as messages:
            yield messages


def write_site_alert_document(
    df: DataFrame, path: str, link_prefix: str, order_by: Sequence[str] = (), **choices
) -> None:
    write_json_array(site_alert_records(df, link_prefix, **choices), path, order_by)
