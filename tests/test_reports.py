"""Reports that are replaced as a whole, one file, pretty text; checks by position; CSV by name."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from meshfeed import files
from meshfeed.operators.columns import encode_rows
from meshfeed.plans.job import Feed
from meshfeed.sinks import documents
from meshfeed.sinks.documents import recover_report, write_json_array, write_json_records
from meshfeed.sinks.messages import measured, publish, publish_counted
from meshfeed.sources.headers import header_census, read_csv_by_name
from meshfeed.sources.topics import Topic, folder_topic, position, read_between, read_topic


def text(path):
    if path.is_file():
        return path.read_text()
    return "".join(p.read_text() for p in sorted(path.glob("part-*")))


def beside(path):
    return sorted(p.name for p in path.parent.iterdir() if not p.name.endswith(".crc"))


FORMS = {
    "parts": lambda df, p: write_json_array(df, p),
    "sorted": lambda df, p: write_json_array(df, p, ["id"]),
    "file": lambda df, p: write_json_array(df, p, ["id"], one_file=True),
    "records": write_json_records,
}


@pytest.mark.parametrize("form", FORMS)
def test_a_failed_write_leaves_the_old_report(spark, tmp_path, form):
    path = tmp_path / "report"
    FORMS[form](spark.range(3), str(path))
    before = text(path)
    broken = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 70, F.raise_error("stop")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        FORMS[form](broken, str(path))
    assert text(path) == before and beside(path) == ["report"]
    FORMS[form](spark.range(5), str(path))
    assert text(path) != before and beside(path) == ["report"]


@pytest.mark.parametrize("form", ["sorted", "file"])
def test_a_failed_swap_leaves_the_old_report(spark, tmp_path, monkeypatch, form):
    path = tmp_path / "report"
    write_json_array(spark.range(3), str(path), ["id"])  # a folder, which the new report replaces
    before, rename = text(path), files.rename
    monkeypatch.setattr(files, "rename", lambda s, a, b, **k: False if b == str(path) and ".old" not in a else rename(s, a, b, **k))
    with pytest.raises(OSError):
        FORMS[form](spark.range(5), str(path))
    assert text(path) == before and beside(path) == ["report"]
    monkeypatch.undo()
    FORMS[form](spark.range(5), str(path))
    assert json.loads(text(path)) == [{"id": n} for n in range(5)]


def test_a_report_comes_back_after_the_job_was_killed(spark, tmp_path):
    path = tmp_path / "report"
    write_json_array(spark.range(3), str(path), ["id"])
    before = text(path)
    path.rename(tmp_path / ".report.old")  # killed between the two renames
    (tmp_path / ".report.new-1").mkdir()
    recover_report(spark, str(path))
    assert text(path) == before and beside(path) == ["report"]
    (tmp_path / ".report.old").mkdir()  # killed before the old one was deleted
    recover_report(spark, str(path))
    assert text(path) == before and beside(path) == ["report"]


def test_one_file(spark, tmp_path):
    path = tmp_path / "report.json"
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("n"), F.lit(None).cast("int").alias("x"))
    write_json_array(df, str(path), ["n"], one_file=True)
    lines = path.read_text().splitlines()
    assert (lines[0], lines[-1], len(lines)) == ("[", "]", 5002)
    assert json.loads(path.read_text()) == [{"n": n, "x": None} for n in range(5000)]
    write_json_array(df.limit(0), str(path), one_file=True)
    assert json.loads(path.read_text()) == []
    write_json_array(spark.range(2), str(path))  # a folder where a file was
    assert path.is_dir() and len(json.loads(text(path))) == 2


def test_pretty_records(spark, tmp_path):
    values = [(1, 'a" : b', {"k\n": "v", 'q\\" : ': None}, (1, None)), (2, None, {}, None), (3, "", None, (2, "x"))]
    df = spark.createDataFrame(values, "n int, `na\"me` string, m map<string,string>, s struct<a:int,b:string>")
    path = tmp_path / "report.json"
    write_json_array(df, str(path), ["n"], one_file=True, pretty=True)
    want = [
        {"n": n, 'na"me': t, "m": m, "s": s and {"a": s[0], "b": s[1]}} for n, t, m, s in values
    ]
    assert json.loads(path.read_text()) == want
    got = path.read_text()
    assert got.replace("{ }", "{}") == json.dumps(json.loads(got), indent=2) + "\n"
    write_json_array(df, str(path), pretty=True)
    assert sorted(json.loads(text(path)), key=lambda r: r["n"]) == want


MESSAGES = ["a", "a", "", None, "ü", '{"x":1}']


def test_counts_of_the_sending_job_are_those_of_the_messages(spark, tmp_path):
    topic = folder_topic(str(tmp_path / "topic"), "parquet")
    df = spark.createDataFrame([(m,) for m in MESSAGES], "value string").repartition(3)
    sent = publish_counted(df, topic)
    assert sent == measured(df) == measured(read_topic(spark, topic))
    assert sent["messages"] == 6 and sent["nulls"] == 1 and sent["bytes"] == 11
    assert measured(df.limit(0)) == publish_counted(df.limit(0), topic) == dict.fromkeys(sent, 0)
    others = [["a", "", "", None, "ü", '{"x":1}'], MESSAGES[:5], [*MESSAGES[:4], "u", '{"x":1}']]
    for messages in others:
        assert measured(spark.createDataFrame([(m,) for m in messages], "value string")) != sent


def test_a_check_reads_what_the_run_added(spark, tmp_path):
    topic = folder_topic(str(tmp_path / "topic"))
    feed = Feed(lambda s: s.range(10), [encode_rows], [topic, folder_topic(str(tmp_path / "other"))])
    for _ in range(2):
        start = position(spark, topic)
        rows = feed.run_counted(spark).collect()
        assert [(r.topic, r.sent_messages, r.received_messages, r.delivered) for r in rows] == [(0, 10, 10, True), (1, 10, 10, True)]
        added = read_between(spark, topic, start, position(spark, topic))
        assert added.count() == 10 and set(added.inputFiles()).isdisjoint({f.replace("file:/", "file:///") for f in start.files})
    assert read_topic(spark, topic).count() == 20
    assert read_between(spark, topic, position(spark, topic), position(spark, topic)).count() == 0


def test_a_lost_message_is_seen(spark, tmp_path, monkeypatch):
    topic = folder_topic(str(tmp_path / "topic"))
    from meshfeed.sinks import messages

    real = publish
    monkeypatch.setattr(messages, "publish", lambda df, t: real(df.where("value <> '{\"id\":7}'"), t))
    (row,) = Feed(lambda s: s.range(10), [encode_rows], [topic]).run_counted(spark).collect()
    assert not row.delivered and row.sent_messages == 10 and row.received_messages == 9


def test_broker_positions_are_passed_on(spark):
    ends = iter(["5", "9"])
    topic = Topic("kafka", {"subscribe": "t"}, end=lambda s: next(ends), to_option="until")
    start, end = position(spark, topic), position(spark, topic)
    assert (start.offset, end.offset) == ("5", "9")
    assert topic.with_options(a="b").end is topic.end
    with pytest.raises(ValueError):
        position(spark, Topic("kafka", {}))


def test_no_topic(spark):
    with pytest.raises(ValueError):
        Feed(lambda s: s.range(1), [encode_rows]).run_counted(spark)


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "tree"
    (root / "deep" / "er").mkdir(parents=True)
    (root / "_hidden").mkdir()
    (root / "a.csv").write_text("k,n,s\n1,10,x\n")
    (root / "deep" / "b.csv").write_text("﻿s,k,n\n\"y, z\",2,20\n")
    (root / "deep" / "er" / "c.csv.gz").write_bytes(gzip.compress(b"n,k\n30,3\n"))
    (root / "d.csv").write_text('K,"more, or",n,s\n4,?,no,w\n')
    (root / "empty.csv").write_text("")
    (root / "only-header.csv").write_text("k,n,s\n")
    (root / "_hidden" / "e.csv").write_text("k,n,s\n9,9,9\n")
    return root


def test_columns_go_by_name(spark, tree):
    assert len(header_census(spark, str(tree))) == 4
    schema = spark.createDataFrame([], "k string, n int, s string").schema
    df = read_csv_by_name(spark, str(tree), schema=schema)
    assert df.schema == schema
    assert sorted(map(tuple, df.collect())) == [("1", 10, "x"), ("2", 20, "y, z"), ("3", 30, None), ("4", None, "w")]
    plain = read_csv_by_name(spark, str(tree), glob="*.csv")
    assert sorted(plain.columns) == ["k", "more, or", "n", "s"]
    assert {r.k: (r.n, r["more, or"]) for r in plain.collect()} == {"1": ("10", None), "2": ("20", None), "4": ("no", "?")}
    assert read_csv_by_name(spark, str(tree / "a.csv"), str(tree / "deep" / "*.csv")).count() == 2


def test_headers_that_cannot_be_read(spark, tree, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_csv_by_name(spark, str(tree / "none"))
    (tmp_path / "twice.csv").write_text("a,A\n1,2\n")
    with pytest.raises(ValueError, match="two columns"):
        read_csv_by_name(spark, str(tmp_path / "twice.csv"))
