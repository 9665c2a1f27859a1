"""The jobs as they are started from a command line."""

import gzip
import json

import pytest

from meshfeed.__main__ import main
from meshfeed.plans import router_score as rs
from meshfeed.plans import site_alert
from meshfeed.plans.job import Feed
from tests.test_activation import HEADER, line
from tests.test_router_score import SCHEMA, router
from tests.test_site_alert import document, site, write
from tests.test_streaming import EVENTS, SCORES


@pytest.fixture
def job(spark):
    """Runs a job in the test's own session."""
    return lambda *argv: main([str(a) for a in argv])


def topic(path, format="text"):
    return json.dumps({"format": format, "options": {"path": str(path)}})


def sent(path):
    return [json.loads(t) for p in path.glob("part-*") for t in p.read_text().splitlines()]


@pytest.mark.parametrize("variant, columns", [("home", rs.IDENTITY), ("fiber", rs.ANONYMOUS)])
def test_router_score(spark, tmp_path, job, capsys, variant, columns):
    rows = [router("a", [["CR1000A"]]), router("b", [["OTHER"]])]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "in" / "2024-01-04"))
    job(
        "router-score", "--variant", variant, "--root", tmp_path / "in", "--run-date", "2024-01-05",
        "--topic", topic(tmp_path / "prod"), "--sample-topic", topic(tmp_path / "test"), "--check",
    )
    assert [m["serial_num"] for m in sent(tmp_path / "prod")] == ["a"]
    assert [list(m) for m in sent(tmp_path / "test")] == [list(columns)]
    assert capsys.readouterr().out.count("missing") == 2


def test_activation_to_two_topics(tmp_path, job):
    folder = tmp_path / "in" / "Report_2024-01-01"
    folder.mkdir(parents=True)
    (folder / "r.csv").write_text("\n".join([HEADER, line(1, 84), line(2, 85), line(3, 99)]) + "\n")
    common = ("activation", "--root", tmp_path / "in", "--name", "Report_{day}")
    when = ("--run-date", "2024-01-08")
    topics = ("--topic", topic(tmp_path / "one"), "--topic", topic(tmp_path / "two"))
    job(*common, *when, *topics)
    assert [m["id"] for m in sent(tmp_path / "one")] == [1]
    assert sent(tmp_path / "one") == sent(tmp_path / "two")
    job(*common, *when, "--topic", topic(tmp_path / "trial"), "--trial-order", "id")
    assert [m["id"] for m in sent(tmp_path / "trial")] == [1, 2]
    assert all("outage_date_1" in m for m in sent(tmp_path / "trial"))
    text = ", ".join(f"{n} string" for n in HEADER.split(",")).replace("AVG_SCORE_1_3 string", "AVG_SCORE_1_3 double")
    job(*common, *when, "--topic", topic(tmp_path / "typed"), "--schema", text)
    assert [m["id"] for m in sent(tmp_path / "typed")] == ["1"]


def test_a_failed_check_fails_the_job(spark, tmp_path, job, monkeypatch):
    rows = [router("a", [["CR1000A"]])]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "in" / "2024-01-04"))
    common = ("router-score", "--root", tmp_path / "in", "--run-date", "2024-01-05", "--check")
    job(*common, "--topic", topic(tmp_path / "t"))
    monkeypatch.setattr(Feed, "_send", lambda self, df: None)  # nothing arrives
    with pytest.raises(SystemExit, match="missing"):
        job(*common, "--topic", topic(tmp_path / "t"))


def test_a_job_without_topics_is_a_usage_error(tmp_path, job):
    for name in ("router-score", "activation"):
        with pytest.raises(SystemExit):
            job(name, "--root", tmp_path)
    for name in ("score-ingest", "location-ingest"):
        with pytest.raises(SystemExit):
            job(name, "--out", tmp_path / "o", "--checkpoint", tmp_path / "c")
    with pytest.raises(SystemExit, match="needs"):
        job("site-alert", "--root", tmp_path, "--link-prefix", "x")


def test_the_archive_is_checked_before_anything_is_sent(tmp_path, job):
    write(tmp_path / "in" / "2024-01-01" / "a.csv", [site("1")])
    (tmp_path / "archive" / "report").mkdir(parents=True)
    with pytest.raises(FileExistsError):
        job(
            "site-alert", "--root", tmp_path / "in", "--run-date", "2024-01-02", "--link-prefix", "x",
            "--document", tmp_path / "report", "--topic", topic(tmp_path / "topic"), "--archive",
        )
    assert not (tmp_path / "topic").exists()


def test_site_alert_document_is_sent_and_archived(spark, tmp_path, job):
    write(tmp_path / "in" / "2024-01-01_sites" / "x" / "a.csv", [site("1"), site("2", flag="0")])
    job(
        "site-alert", "--root", tmp_path / "in", "--name", "{day}_sites", "--run-date", "2024-01-02",
        "--link-prefix", "https://reports.example.org/", "--document", tmp_path / "report",
        "--topic", topic(tmp_path / "topic"), "--archive", "--form", "document",
    )
    assert not (tmp_path / "report").exists()
    (written,) = json.loads(document(tmp_path / "archive" / "report"))
    assert written["enodeb"] == "1" and written["vendor"] == site_alert.VENDOR
    assert sent(tmp_path / "topic") == [[written]]


def test_ingest_jobs(spark, tmp_path, job):
    for name, lines in (("scores", SCORES), ("events", EVENTS)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a").write_text("".join(t + "\n" for t in lines))
    common = ("--once", "--checkpoint")
    job(
        "score-ingest", "--topic", topic(tmp_path / "scores"), "--topic", topic(tmp_path / "events"),
        "--out", tmp_path / "o1", *common, tmp_path / "c1",
    )
    assert spark.read.text(str(tmp_path / "o1")).count() == len(SCORES) + len(EVENTS)
    job(
        "location-ingest", "--topic", topic(tmp_path / "events"), "--out", tmp_path / "o2",
        *common, tmp_path / "c2", "--backlog",
    )
    files = list((tmp_path / "o2").glob("date=2024-01-01/hour=0/*.json.gz"))
    assert [json.loads(t)["eventType"] for f in files for t in gzip.open(f, "rt")] == [1, 1]


def test_counted_check(spark, tmp_path, job, monkeypatch):
    spark.createDataFrame([router("a", [["CR1000A"]])], SCHEMA).write.parquet(str(tmp_path / "in" / "2024-01-04"))
    common = ("router-score", "--root", tmp_path / "in", "--run-date", "2024-01-05", "--counted", "--topic", topic(tmp_path / "t"))
    job(*common)
    job(*common)
    assert len(sent(tmp_path / "t")) == 2
    monkeypatch.setattr("meshfeed.plans.job.measured", lambda df: dict.fromkeys(("messages", "bytes", "nulls", "checksum"), 0))
    with pytest.raises(SystemExit, match="arrived"):
        job(*common)


def test_quarantine_and_compaction_jobs(spark, tmp_path, job):
    from meshfeed.streaming.commits import REJECTED, Commits

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_text("".join(e + "\n" for e in EVENTS))
    common = ("--topic", topic(tmp_path / "in"), "--checkpoint", tmp_path / "c", "--once", "--quarantine")
    with pytest.raises(SystemExit):
        job("location-ingest", *common, "--out", tmp_path / "o")
    for text in ("", '{"eventType":7}\n'):
        if text:
            (tmp_path / "in" / "b").write_text(text)
        job("location-ingest", *common, "--out", tmp_path / "o", "--batch-folders")
    log = Commits(spark, str(tmp_path / "o"))
    assert len(log.folders()) == len(log.folders(REJECTED)) == 2
    shape = spark.createDataFrame([], "eventType int, date string, hour int").schema
    assert log.read(shape).count() == len(EVENTS) and log.read(spark.createDataFrame([], "value string").schema, REJECTED).count() == 1
    job("compact", "--path", tmp_path / "o", "--before", "2100-01-01T00:00", "--partition-by", "date,hour", "--compression", "gzip", "--keep-hours", "0")
    assert len(log.folders()) == 1 and log.read(shape).count() == len(EVENTS)


def test_fan_out_job(tmp_path, job):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_text('{"n":1}\n{"n":2}\n')
    targets = [f"{name}={topic(tmp_path / name)}" for name in ("prod", "nonprod")]
    job(
        "fan-out", "--topic", topic(tmp_path / "in"), "--to", targets[0], "--to", targets[1],
        "--out", tmp_path / "ledger", "--checkpoint", tmp_path / "c", "--once",
    )
    assert sorted(m["n"] for m in sent(tmp_path / "prod")) == sorted(m["n"] for m in sent(tmp_path / "nonprod")) == [1, 2]


def test_readable_document_of_files_with_other_headers(tmp_path, job):
    """The report as one readable file, from files whose columns stand in different orders."""
    names = [*site_alert.SITE_COLUMNS, site_alert.FLAG]
    folder = tmp_path / "in" / "2024-01-04"
    folder.mkdir(parents=True)
    for n, order in enumerate((names, names[::-1])):
        values = {c: "1" if c in site_alert.ALERTS or c == site_alert.FLAG else f"{c}-{n}" for c in names}
        (folder / f"{n}.csv").write_text(",".join(order) + "\n" + ",".join(values[c] for c in order) + "\n")
    job(
        "site-alert", "--root", tmp_path / "in", "--run-date", "2024-01-05", "--link-prefix", "x/",
        "--document", tmp_path / "report.json", "--one-file", "--pretty", "--sort", "--by-name",
    )
    text = (tmp_path / "report.json").read_text()
    found = json.loads(text)
    assert [r["enodeb"] for r in found] == ["enodeb-0", "enodeb-1"]
    assert [r["features"]["rtp_gap"] for r in found] == ["rtp_gap-0", "rtp_gap-1"]
    assert text == json.dumps(found, indent=2) + "\n"
