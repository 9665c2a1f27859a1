import gzip
import json
import os
import signal
import threading

import pytest

from meshfeed.plans import location_events, router_score
from meshfeed.sources.topics import Topic, folder_topic, read_topic, stream_topic
from meshfeed.streaming.ingest import (
    archive_options,
    rebalanced,
    run_available,
    run_until_stopped,
    start_json_batches,
    start_json_sink,
)

SCORES = [
    '{"serial_num":"full","mdn":"1","cust_id":"2","date":"2024-01-01","poor_rssi":1.5,'
    '"poor_phyrate":2.5,"num_station":3.0,"home_score":80.25,"dg_model_indiv":"M"}',
    '{"serial_num":"missing"}',
    '{"serial_num":"extra","other":1}',
    "bad",
    "",
    "{}",
    "[1]",
    '{"serial_num":"text-in-float","poor_rssi":"high","home_score":1.0}',
    '{"serial_num":17}',
]


def inbox(tmp_path, name, lines):
    folder = tmp_path / "inbox"
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(line + "\n" for line in lines))
    return folder_topic(str(folder))


def ingest(spark, topic, tmp_path, **choices):
    records = router_score.score_records(stream_topic(spark, topic))
    query = start_json_sink(
        records, str(tmp_path / "out"), str(tmp_path / "progress"), interval=None, **choices
    )
    run_available(query, timeout=120)


def rows(df):
    return sorted(map(str, df.collect()))


def output(spark, tmp_path):
    return spark.read.schema(router_score.MESSAGE_SCHEMA).json(str(tmp_path / "out"))


def test_stream_gives_what_the_batch_gives(spark, tmp_path):
    topic = inbox(tmp_path, "a.txt", SCORES)
    ingest(spark, topic, tmp_path)
    batch = router_score.score_records(read_topic(spark, topic))
    assert batch.count() == len(SCORES)
    assert rows(output(spark, tmp_path)) == rows(batch)


def test_decoding_rules(spark, tmp_path):
    topic = inbox(tmp_path, "a.txt", SCORES)
    decoded = router_score.score_records(read_topic(spark, topic), corrupt_column="corrupt")
    by_key = {r.serial_num: r for r in decoded.collect() if r.serial_num}
    assert by_key["full"].home_score == 80.25 and by_key["full"].dg_model_indiv == "M"
    assert by_key["missing"].date is None and by_key["extra"].corrupt is None
    # the field of the wrong type is lost, the others are not
    assert by_key["text-in-float"].poor_rssi is None and by_key["text-in-float"].home_score == 1.0
    assert by_key["17"].serial_num == "17"
    assert "bad" in {r.corrupt for r in decoded.collect()}


def test_null_message_is_a_row_of_nulls(spark):
    messages = spark.createDataFrame([(None,), (b'{"serial_num":"1"}',)], "value binary")
    decoded = router_score.score_records(messages, corrupt_column="corrupt").collect()
    assert {r.serial_num for r in decoded} == {None, "1"}
    assert all(r.corrupt is None and r.home_score is None for r in decoded)


def test_malformed_messages_become_empty_objects(spark, tmp_path):
    ingest(spark, inbox(tmp_path, "a.txt", ["bad"]), tmp_path)
    (part,) = (tmp_path / "out").glob("part-*")
    assert part.read_text() == "{}\n"


def test_restart_adds_only_what_is_new(spark, tmp_path):
    topic = inbox(tmp_path, "a.txt", ['{"serial_num":"1"}', '{"serial_num":"2"}'])
    ingest(spark, topic, tmp_path)
    ingest(spark, topic, tmp_path)
    assert output(spark, tmp_path).count() == 2
    inbox(tmp_path, "b.txt", ['{"serial_num":"3"}'])
    ingest(spark, topic, tmp_path)
    assert sorted(r.serial_num for r in output(spark, tmp_path).collect()) == ["1", "2", "3"]


def test_runs_until_stopped(spark, tmp_path):
    topic = inbox(tmp_path, "a.txt", ['{"serial_num":"1"}'])
    records = router_score.score_records(stream_topic(spark, topic))
    query = start_json_sink(
        records, str(tmp_path / "out"), str(tmp_path / "progress"), interval="1 second"
    )
    assert run_until_stopped(query, timeout=8) is False
    assert not query.isActive
    assert output(spark, tmp_path).count() == 1


def event(millis, **fields):
    return json.dumps({"eventType": 1, "timestamp": millis, "data": "d", **fields})


EVENTS = [
    event(1704067207999, location={"latitude": "1.5", "longitude": "2.5"}),
    event(1704070800000, location={"latitude": "1.5"}),
    event(1704070799999),
    event(-86_400_000),
    "bad",
]


def test_location_records(spark, tmp_path):
    records = location_events.location_records(read_topic(spark, inbox(tmp_path, "a", EVENTS)))
    assert "location" not in records.columns
    found = {r.timestamp: r for r in records.collect()}
    first = found[1704067207999]
    assert (first.date_parsed, first.hour, str(first.date)) == ("2024-01-01 00:00:07", 0, "2024-01-01")
    assert (first.latitude, first.longitude) == ("1.5", "2.5")
    assert found[1704070800000].hour == 1 and found[1704070800000].longitude is None
    assert found[1704070799999].hour == 0 and found[1704070799999].latitude is None
    assert found[-86_400_000].date_parsed == "1969-12-31 00:00:00"
    assert found[None].date is None


@pytest.mark.parametrize("rebalance", [False, True])
def test_partitioned_gzip_files(spark, tmp_path, rebalance):
    topic = inbox(tmp_path, "a", EVENTS)
    stream = location_events.location_records(stream_topic(spark, topic))
    query = start_json_sink(
        stream,
        str(tmp_path / "out"),
        str(tmp_path / "progress"),
        interval=None,
        partition_by=location_events.PARTITION_BY,
        compression=location_events.COMPRESSION,
        rebalance=rebalance,
    )
    run_available(query, timeout=120)
    files = sorted((tmp_path / "out").glob("date=*/hour=*/part-*.json.gz"))
    folders = {"/".join(f.parts[-3:-1]) for f in files}
    assert folders == {
        "date=2024-01-01/hour=0",
        "date=2024-01-01/hour=1",
        "date=1969-12-31/hour=0",
        "date=__HIVE_DEFAULT_PARTITION__/hour=__HIVE_DEFAULT_PARTITION__",
    }
    body = [json.loads(line) for f in files for line in gzip.open(f, "rt")]
    assert len(body) == len(EVENTS)
    assert all("date" not in b and "hour" not in b for b in body)


def test_rebalance_writes_few_files_and_splits_a_hot_hour(spark, tmp_path):
    """16 tasks, one day that holds nearly everything: few files for small days, many for that one."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "100k")
    try:
        df = spark.range(0, 160_000, 1, 16).selectExpr(
            "id", "if(id % 1000 < 5, concat('rare', id % 1000), 'hot') as day", "id as _writer"
        )
        rebalanced(df, ["day"]).write.partitionBy("day").json(str(tmp_path / "gathered"))
    finally:
        spark.conf.set(key, before)
    parts = {d.name: [len(p.read_text().splitlines()) for p in d.glob("part-*")] for d in (tmp_path / "gathered").glob("day=*")}
    hot = parts.pop("day=hot")
    assert sum(hot) == 159_200 and len(hot) > 3 and max(hot) < 80_000
    assert all(sum(p) == 160 for p in parts.values())
    # 16 tasks would write 16 files each; a day that shares the hot one's bucket may be split with it
    assert sum(len(p) <= 2 for p in parts.values()) >= 4
    back = spark.read.json(str(tmp_path / "gathered")).where("_writer <> id").count()
    assert back == 0


def test_batch_folders_hold_each_row_once(spark, tmp_path):
    topic = inbox(tmp_path, "a.txt", SCORES[:3])

    def ingest_batches():
        records = router_score.score_records(stream_topic(spark, topic))
        query = start_json_batches(
            records, str(tmp_path / "out"), str(tmp_path / "progress"), interval=None
        )
        run_available(query, timeout=120)

    ingest_batches()
    ingest_batches()
    assert output(spark, tmp_path).count() == 3
    # the batch was written, but its end was not noted: it runs again, into the same folder
    for entry in (tmp_path / "progress" / "commits").iterdir():
        entry.unlink()
    ingest_batches()
    assert output(spark, tmp_path).count() == 3
    inbox(tmp_path, "b.txt", SCORES[3:5])
    ingest_batches()
    assert output(spark, tmp_path).count() == 5
    assert {p.name for p in (tmp_path / "out").iterdir()} == {"batch=0", "batch=1"}


def test_termination_stops_between_batches(spark, tmp_path):
    topic = inbox(tmp_path, "a.txt", ['{"serial_num":"1"}'])
    records = router_score.score_records(stream_topic(spark, topic))
    query = start_json_batches(
        records, str(tmp_path / "out"), str(tmp_path / "progress"), interval="1 second"
    )
    query.processAllAvailable()
    timer = threading.Timer(2, lambda: os.kill(os.getpid(), signal.SIGTERM))
    timer.start()
    assert run_until_stopped(query, timeout=60) is False
    assert not query.isActive and query.exception() is None
    assert output(spark, tmp_path).count() == 1


def test_malformed_location_messages_can_be_kept(spark, tmp_path):
    messages = read_topic(spark, inbox(tmp_path, "a", EVENTS))
    rows = location_events.location_records(messages, corrupt_column="corrupt").collect()
    assert [r.corrupt for r in rows if r.corrupt] == ["bad"]


def test_consumed_files_move_to_the_archive(spark, tmp_path):
    archive = tmp_path / "archive"
    for name in "abc":
        topic = inbox(tmp_path, name, ['{"serial_num":"%s"}' % name])
        topic = Topic("text", {**topic.options, **archive_options(str(archive))})
        ingest(spark, topic, tmp_path)
    left = {p.name for p in (tmp_path / "inbox").iterdir() if not p.name.startswith(".")}
    moved = {p.name for p in archive.rglob("*") if p.is_file() and not p.name.startswith(".")}
    assert moved and left | moved == {"a", "b", "c"} and not left & moved
    assert sorted(r.serial_num for r in output(spark, tmp_path).collect()) == ["a", "b", "c"]
