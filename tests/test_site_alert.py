import json

import pytest

from meshfeed.functions.alerts import alerting_json
from meshfeed.plans import site_alert as sa
from meshfeed.sources.tables import read_csv

LINK = "https://reports.example.org/site?id="


def site(key, flag="1", alerts=None, **values):
    row = {n: "" for n in sa.SITE_SCHEMA.fieldNames()}
    row.update({n: "1.5" for n in sa.FEATURES})
    row.update({n: "0" for n in sa.ALERTS})
    row.update({f"{n}_alert": v for n, v in (alerts or {}).items()})
    row.update(enodeb=key, day="2024-01-02", event_day="2024-01-01", has_abnormal_kpi=flag)
    row.update(values)
    return row


def write(path, rows, names=None):
    names = names or sa.SITE_SCHEMA.fieldNames()
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([",".join(names)] + [",".join(r[n] for n in names) for r in rows]) + "\n")


@pytest.fixture(scope="module")
def sites(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("sites")
    write(
        root / "north" / "a.csv",
        [
            site("1", alerts={"rtp_gap": "1"}, region="N"),
            site("2", flag="1.0", alerts={"sip_dc_rate": "0.0", "rtp_gap": ""}),
            site("3", flag="0", alerts={"rtp_gap": "1"}),
        ],
    )
    write(
        root / "south" / "deep" / "b.csv",
        [
            site("4", flag="", alerts={"rtp_gap": "1"}),
            site("5", flag="yes", alerts={"rtp_gap": "1"}),
            site("6"),
            site("7", alerts={"rtp_gap": "1"}, rtp_gap=""),
        ],
    )
    return read_csv(spark, str(root), nested=True)


def by_site(df):
    return {m["enodeb"]: m for m in (json.loads(r.value) for r in df.collect())}


def test_scan_finds_nested_files_as_text(sites):
    assert sites.count() == 7
    assert {t for _, t in sites.dtypes} == {"string"}


def test_flag_as_number_in_text(sites):
    assert set(by_site(sa.site_alert_report(sites, LINK))) == {"1", "2", "6", "7"}


def test_record_layout(sites):
    record = by_site(sa.site_alert_report(sites, LINK))["1"]
    assert record == {
        "enodeb": "1",
        "alert_day": "2024-01-02",
        "event_day": "2024-01-01",
        "site": None,
        "region": "N",
        "abnormal_kpi_count": None,
        "nrb_ticket_counts": None,
        "w360_ticket_counts": None,
        "vendor": "samsung",
        "features": {"rtp_gap": "1.5"},
        "features_alert": json.dumps(
            {n: "1" if n == "rtp_gap_alert" else "0" for n in sa.ALERTS}, separators=(",", ":")
        ),
        "link": LINK + "1",
    }


def test_gate_on_alert_text(sites):
    records = by_site(sa.site_alert_report(sites, LINK))
    # '0.0' is not '0'; a missing flag is not raised and not listed
    assert records["2"]["features"] == {"sip_dc_rate": "1.5"}
    assert "rtp_gap_alert" not in json.loads(records["2"]["features_alert"])
    assert records["6"]["features"] == {}
    # raised, but there is no measurement
    assert records["7"]["features"] == {}


def test_both_forms_of_the_gate_agree(sites):
    plain = {
        r.enodeb: json.loads(r.features)
        for r in sites.select("enodeb", alerting_json(sa.FEATURES).alias("features")).collect()
    }
    for key, record in by_site(sa.site_alert_report(sites, LINK)).items():
        assert record["features"] == plain[key]


def test_alert_flags_can_be_left_out(sites):
    df = sa.site_alert_report(sites, LINK, include_alert_flags=False)
    assert all("features_alert" not in r for r in by_site(df).values())


def document(folder):
    return "".join(p.read_text() for p in sorted(folder.glob("part-*")))


def test_document_is_one_json_array_in_order(sites, tmp_path):
    target = tmp_path / "report"
    sa.write_site_alert_document(sites.repartition(4), str(target), LINK, sa.REPORT_ORDER)
    parsed = json.loads(document(target))
    assert [r["enodeb"] for r in parsed] == ["1", "2", "6", "7"]
    assert parsed[0]["region"] == "N" and parsed[1]["region"] is None


def test_document_without_an_order_has_all_records(sites, tmp_path):
    sa.write_site_alert_document(sites.repartition(4), str(tmp_path / "report"), LINK)
    parsed = json.loads(document(tmp_path / "report"))
    assert sorted(r["enodeb"] for r in parsed) == ["1", "2", "6", "7"]


def test_document_replaces_the_one_before(sites, tmp_path):
    target = tmp_path / "report"
    sa.write_site_alert_document(sites, str(target), LINK)
    sa.write_site_alert_document(sites.filter("enodeb = '6'"), str(target), LINK)
    assert [r["enodeb"] for r in json.loads(document(target))] == ["6"]


def test_document_of_nothing(sites, tmp_path):
    sa.write_site_alert_document(sites.filter("enodeb = '3'"), str(tmp_path / "none"), LINK)
    assert json.loads(document(tmp_path / "none")) == []


def test_equal_records_all_stay_in_the_document(sites, tmp_path):
    copies = sites.filter("enodeb = '6'").union(sites.filter("enodeb = '6'"))
    copies = copies.union(copies).repartition(3)
    sa.write_site_alert_document(copies, str(tmp_path / "copies"), LINK)
    assert [r["enodeb"] for r in json.loads(document(tmp_path / "copies"))] == ["6"] * 4


def test_files_with_another_column_order_are_refused(spark, tmp_path):
    names = sa.SITE_SCHEMA.fieldNames()
    write(tmp_path / "a.csv", [site("1")])
    write(tmp_path / "b.csv", [site("2")], list(reversed(names)))
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path), schema=sa.SITE_SCHEMA).collect()
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path)).collect()
