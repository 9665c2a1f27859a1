"""Queries for the whole feeds."""

from __future__ import annotations

from meshfeed.catalog.registry import query
from meshfeed.catalog.standins import (
    ANON_WORDS,
    LINK_PREFIX,
    SITES_SQL,
    WORDS,
    gated_json_sql,
    router_words_sql,
    routers,
    sites,
)
from meshfeed.plans import router_score, site_alert

_IDENTITY = """
      serial_num := serial_num,
      mdn := coalesce(mdn, '0000000000'),
      cust_id := coalesce(cust_id, '000000000'),
      "date" := "date" """
_SCORES = """
      poor_rssi := poor_rssi,
      poor_phyrate := poor_phyrate,
      num_station := num_station,
      home_score := home_score,
      dg_model_indiv := dg_model_indiv"""
_SCORE_COLUMNS = "poor_rssi, poor_phyrate, num_station, home_score, dg_model_indiv"


def _encoded(fields: str, rows: str) -> str:
    return (
        f"select cast(json_merge_patch('{{}}', to_json(struct_pack({fields}))) as varchar) "
        f'as "value" from ({rows})'
    )


@query(
    _encoded(
        f"{_IDENTITY}, {_SCORES}",
        router_words_sql(WORDS, f"serial_num, mdn, cust_id, date, {_SCORE_COLUMNS}"),
    )
)
def router_score_feed(spark, sf_dir):
    return router_score.router_score_feed(routers(spark, sf_dir), WORDS)


@query(
    _encoded(
        f'serial_num := serial_num, "date" := "date", {_SCORES}',
        router_words_sql(ANON_WORDS, f"serial_num, date, {_SCORE_COLUMNS}"),
    )
)
def router_score_feed_anon(spark, sf_dir):
    return router_score.router_score_feed_anon(routers(spark, sf_dir), ANON_WORDS)


@query(
    _encoded(
        _IDENTITY,
        router_words_sql(WORDS, "serial_num, mdn, cust_id, date")
        + " order by serial_num, coalesce(mdn, '0000000000'), coalesce(cust_id, '000000000'), date"
        " limit 10",
    )
)
def sample_feed(spark, sf_dir):
    return router_score.sample_feed(routers(spark, sf_dir), WORDS)


@query(
    _encoded(
        f'serial_num := serial_num, "date" := "date", {_SCORES}',
        router_words_sql(ANON_WORDS, f"serial_num, date, {_SCORE_COLUMNS}")
        + " order by serial_num, date, poor_rssi, poor_phyrate, num_station nulls first, "
        "home_score, dg_model_indiv limit 10",
    )
)
def sample_feed_anon(spark, sf_dir):
    return router_score.sample_feed_anon(routers(spark, sf_dir), ANON_WORDS)


_ALERT_FLAGS = ", ".join(f"{name} := {name}" for name in site_alert.ALERTS)


def _site_sql(alert_flags: str) -> str:
    return f"""
    select cast(to_json(struct_pack(
      enodeb := enodeb,
      alert_day := "day",
      event_day := event_day,
      site := site,
      region := region,
      abnormal_kpi_count := abnormal_kpi,
      nrb_ticket_counts := nrb_ticket_counts,
      w360_ticket_counts := w360_ticket_counts,
      vendor := 'samsung',
      features := {gated_json_sql(site_alert.FEATURES)},
      {alert_flags}
      link := '{LINK_PREFIX}' || enodeb)) as varchar) as "value"
    from ({SITES_SQL}) where l_discount > 0.05"""


@query(
    _site_sql(
        f"features_alert := cast(json_merge_patch('{{}}', to_json(struct_pack({_ALERT_FLAGS}))) "
        "as varchar),"
    )
)
def site_alert_report(spark, sf_dir):
    return site_alert.site_alert_report(sites(spark, sf_dir), LINK_PREFIX)


@query(_site_sql(""))
def site_alert_report_short(spark, sf_dir):
    return site_alert.site_alert_report(
        sites(spark, sf_dir), LINK_PREFIX, include_alert_flags=False
    )
