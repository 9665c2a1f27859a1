"""Committed batches, compaction, quarantine, and fan-out of a stream."""

import json
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from meshfeed import files
from meshfeed.plans import location_events
from meshfeed.sources.topics import Topic, folder_topic, read_topic, stream_topic
from meshfeed.streaming import commits
from meshfeed.streaming.commits import HOUR, REJECTED, Commits, compact, malformed, start_committed_batches
from meshfeed.streaming.fanout import Ledger, start_fan_out
from meshfeed.streaming.ingest import run_available

SCHEMA = "n bigint, day string"


def put(folder, name, lines):
    """A new file, younger than those before it: the stream takes them in this order."""
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(line + "\n" for line in lines))
    age = 1000 - len(list(folder.iterdir()))
    os.utime(folder / name, (time.time() - age, time.time() - age))


@pytest.fixture
def place(tmp_path):
    return tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress")


def ingest(spark, place, step=lambda rows: rows, **choices):
    source, out, checkpoint = place
    lines = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(str(source))
    rows = step(lines.select(F.from_json("value", "n bigint, day string").alias("r")).select("r.*"))
    run_available(start_committed_batches(rows, out, checkpoint, interval=None, **choices), timeout=120)


def numbers(spark, place, schema=SCHEMA):
    return sorted(r.n for r in Commits(spark, place[1]).read(spark.createDataFrame([], schema).schema).collect())


def rows(*ns, day="a"):
    return [json.dumps({"n": n, "day": day}) for n in ns]


def test_only_whole_batches_are_seen(spark, place):
    put(place[0], "a.txt", rows(1, 2))
    put(place[0], "b.txt", rows(3, 4, 5))
    # the second batch dies when some of its files may be written
    broken = lambda df: df.withColumn("n", F.when(F.col("n") == 5, F.raise_error("stop").cast("bigint")).otherwise(F.col("n")))
    assert numbers(spark, place) == []
    with pytest.raises(Exception, match="stop"):
        ingest(spark, place, broken)
    assert numbers(spark, place) == [1, 2]
    ingest(spark, place)
    assert numbers(spark, place) == [1, 2, 3, 4, 5]
    # a batch that was committed, but whose end was not noted, runs again and changes nothing
    folders = Commits(spark, place[1]).folders()
    for entry in (place[0].parent / "progress" / "commits").glob("*1*"):
        entry.unlink()
    ingest(spark, place)
    assert Commits(spark, place[1]).folders() == folders and numbers(spark, place) == [1, 2, 3, 4, 5]


def test_rejected_rows_are_committed_with_the_others(spark, place):
    messages = ['{"timestamp":1704067207999,"eventType":1}', "bad", '{"eventType":2}', "", "[1]", "worse\tstill"]
    put(place[0], "a.txt", messages)
    source, out, checkpoint = place
    stream = location_events.location_records(stream_topic(spark, folder_topic(str(source))), "corrupt")
    query = start_committed_batches(
        stream, out, checkpoint, interval=None, partition_by=("date", "hour"), compression="gzip", split=malformed("corrupt")
    )
    run_available(query, timeout=120)
    log = Commits(spark, out)
    batch = location_events.location_records(read_topic(spark, folder_topic(str(source))), "corrupt")
    good = log.read(batch.drop("corrupt").schema)
    bad = log.read(spark.createDataFrame([], "value string").schema, REJECTED)
    assert sorted(r.value for r in bad.collect()) == sorted(r.corrupt for r in batch.collect() if r.corrupt is not None)
    assert good.count() + bad.count() == len(messages)
    assert {r.eventType for r in good.collect() if r.eventType} == {1, 2}


@pytest.mark.parametrize("partition_by", [(), ("day",)])
def test_compaction_keeps_the_rows(spark, place, partition_by):
    for n in range(5):
        put(place[0], f"{n}.txt", rows(n, n + 100, day="x y=z") + ['{"n":%d}' % (n + 1000)])
    ingest(spark, place, partition_by=partition_by, compression="gzip")
    log, want = Commits(spark, place[1]), sorted([*range(5), *range(100, 105), *range(1000, 1005)])
    before = log.read(spark.createDataFrame([], SCHEMA).schema)
    assert numbers(spark, place) == want
    assert compact(spark, place[1], before=0) == 0  # the hour is not over
    later = files.modified(spark, log.log) + HOUR
    assert compact(spark, place[1], later, partition_by=partition_by, compression="gzip") == 5
    assert len(log.folders()) == 1 and numbers(spark, place) == want
    assert sorted(r.n for r in before.collect()) == want  # a reader that began before
    assert {r.day for r in log.read(spark.createDataFrame([], SCHEMA).schema).collect()} == {"x y=z", None}
    assert compact(spark, place[1], later) == 0
    assert log.vacuum(keep_ms=HOUR) == []
    assert len(log.vacuum(keep_ms=0)) == 5 and numbers(spark, place) == want
    put(place[0], "9.txt", rows(9))  # the stream goes on
    ingest(spark, place, partition_by=partition_by, compression="gzip")
    assert numbers(spark, place) == sorted([*want, 9])


def test_files_of_a_set_size(spark, place):
    for n in range(3):
        put(place[0], f"{n}.txt", rows(*range(2000)))
    ingest(spark, place)
    log = Commits(spark, place[1])
    total = sum(files.size(spark, f) for f in log.folders())
    compact(spark, place[1], files.modified(spark, log.log) + HOUR, file_bytes=total // 3)
    (folder,) = log.folders()
    parts = [n for n in files.names(spark, folder) if n.startswith("part-")]
    assert len(parts) in (3, 4) and len(numbers(spark, place)) == 6000


def test_two_compactions_at_once(spark, place, monkeypatch):
    for n in range(2):
        put(place[0], f"{n}.txt", rows(n))
    ingest(spark, place)
    log = Commits(spark, place[1])
    later = files.modified(spark, log.log) + HOUR
    append, first = Commits.append, []

    def slower(self, state, *args, **kwargs):
        if not first:
            first.append(True)
            assert compact(spark, place[1], later) == 2  # another job is done in between
        return append(self, state, *args, **kwargs)

    monkeypatch.setattr(Commits, "append", slower)
    assert compact(spark, place[1], later) == 0
    assert numbers(spark, place) == [0, 1]


def test_summaries_and_contended_numbers(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "SUMMARY_EVERY", 4)
    path = str(tmp_path / "log")

    def work(name):
        log = Commits(spark, path)
        state = log.state()
        for n in range(10):
            assert log.append(state, {f"batch={n}/{name}": "records"})

    threads = [threading.Thread(target=work, args=(n,)) for n in "ab"]
    for t in threads:
        t.start()
        t.join()
    log = Commits(spark, path)
    state = log.state()
    assert len(state.folders) == 20 and state.number == 19
    assert [n for n in files.names(spark, log.log) if n.startswith("upto")][-1] == "upto-000000000019.json"
    assert log.append(state, {"batch=7/x": "records"}, batch=7) and not log.append(state, {"batch=7/y": "records"}, batch=7)
    assert not log.append(state, {}, remove=["batch=0/none"])
    assert log.append(state, {"hour=0/z": "records"}, remove=["batch=0/a", "batch=0/b"])
    again = Commits(spark, path).state()
    assert vars(again) == vars(state) and set(again.removed) == {"batch=0/a", "batch=0/b"} and again.batch == 7


def fan(spark, place, topics, ledger):
    lines = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(str(place[0]))
    run_available(start_fan_out(lines, topics, ledger, place[2], interval=None), timeout=120)


def values(spark, topic):
    return sorted(r.value for r in read_topic(spark, topic).collect())


def test_each_topic_gets_each_batch_once(spark, place, tmp_path):
    good = {n: folder_topic(str(tmp_path / n)) for n in ("prod", "nonprod")}
    ledger = str(tmp_path / "ledger")
    put(place[0], "a.txt", ["1", "2"])
    fan(spark, place, good, ledger)
    put(place[0], "b.txt", ["3"])
    put(place[0], "c.txt", ["4", "4"])
    dead = {**good, "nonprod": Topic("no-such-connector")}  # dies between the two topics
    for _ in range(2):
        with pytest.raises(Exception):  # noqa: B017
            fan(spark, place, dead, ledger)
        assert values(spark, good["prod"]) == ["1", "2", "3"]
        assert values(spark, good["nonprod"]) == ["1", "2"]
    put(place[0], "b.txt", ["changed since"])  # what was staged is what all topics get
    fan(spark, place, good, ledger)
    assert values(spark, good["prod"]) == values(spark, good["nonprod"]) == ["1", "2", "3", "4", "4"]
    # all sent, but the end of the last batch was not noted
    for entry in (tmp_path / "progress" / "commits").glob("*2*"):
        entry.unlink()
    fan(spark, place, good, ledger)
    assert values(spark, good["prod"]) == values(spark, good["nonprod"]) == ["1", "2", "3", "4", "4"]
    assert [n for n in files.names(spark, ledger) if n.startswith("rows")] == []
    assert files.names(spark, ledger) == ["batch-2"]
    assert Ledger(spark, ledger).noted(2, "sent-prod")


def test_names_of_topics(spark, place):
    put(place[0], "a.txt", ["1"])
    with pytest.raises(ValueError):
        fan(spark, place, {"a/b": folder_topic("x")}, "ledger")
