"""The jobs, for ``spark-submit``: ``python -m meshfeed JOB ...``.

A topic is given as JSON, the connector's format and options:
``--topic '{"format": "text", "options": {"path": "/shared/topic"}}'``.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from contextlib import ExitStack
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from meshfeed.functions.payload import string_schema
from meshfeed.plans import activation, location_events, router_score, site_alert
from meshfeed.plans.job import Feed
from meshfeed.session import build_session, staged
from meshfeed.sinks.archive import move_to_archive, require_free
from meshfeed.sinks.documents import write_json_array
from meshfeed.sources import dated
from meshfeed.sources.headers import read_csv_by_name
from meshfeed.sources.tables import read_csv
from meshfeed.sources.topics import Topic, stream_topic
from meshfeed.streaming.commits import HOUR, Commits, compact, malformed, start_committed_batches
from meshfeed.streaming.fanout import start_fan_out
from meshfeed.streaming.ingest import run_until_stopped, start_json_sink


def topic(text: str) -> Topic:
    return Topic(**json.loads(text))


def _publish(spark: SparkSession, feed: Feed, args: argparse.Namespace) -> None:
    """A check that finds a message missing or unreadable, or counts that differ, fails the job."""
    if args.counted:
        report = feed.run_counted(spark)
        report.show(truncate=False)
        if report.where("not delivered").count():
            raise SystemExit("what was sent is not what arrived")
        return
    if not args.check:
        feed.run(spark)
        return
    report = feed.run_checked(spark)
    report.show(truncate=False)
    if report.where("missing > 0 or unreadable > 0").count():
        raise SystemExit("messages are missing or unreadable")


def router_scores(spark: SparkSession, args: argparse.Namespace) -> None:
    whole, sample = {
        "home": (router_score.router_score_feed, router_score.sample_feed),
        "fiber": (router_score.router_score_feed_anon, router_score.sample_feed_anon),
    }[args.variant]

    def read(session: SparkSession):
        return dated.read_dated_parquet(session, args.root, args.run_date, args.days_back)

    _publish(spark, Feed(read, [whole], args.topic), args)
    if args.sample_topic:
        _publish(spark, Feed(read, [sample], args.sample_topic), args)


def activations(spark: SparkSession, args: argparse.Namespace) -> None:
    path = dated.dated_path(args.root, args.run_date, args.days_back, args.name)
    # both spellings of the date columns are about; a name that is not there changes nothing
    renamed = {**activation.RENAMED, **activation.TRIAL_RENAMED}

    def step(df: DataFrame) -> DataFrame:
        if args.trial_order:
            return activation.trial_feed(df, args.trial_order, renamed=renamed)
        return activation.low_score_feed(df, renamed=renamed)

    schema = StructType.fromDDL(args.schema) if args.schema else None
    feed = Feed(
        lambda session: read_csv(session, path, schema=schema, infer=schema is None), [step], args.topic
    )
    _publish(spark, feed, args)


def site_alerts(spark: SparkSession, args: argparse.Namespace) -> None:
    if not args.document and not args.topic:
        raise SystemExit("site-alert needs --document or --topic")
    if args.document and args.archive:
        require_free(spark, args.document)
    path = dated.dated_path(args.root, args.run_date, args.days_back, args.name)
    schema = string_schema(args.columns.split(",")) if args.columns else site_alert.SITE_SCHEMA
    if args.by_name:
        sites = read_csv_by_name(spark, path, schema=schema)
    else:
        sites = read_csv(spark, path, schema=schema, nested=True)
    records = site_alert.site_alert_records(sites, args.link_prefix)
    with ExitStack() as tables:
        if args.document and args.topic:
            records = tables.enter_context(staged(records, "report"))
        if args.document:
            order = site_alert.REPORT_ORDER if args.sort else ()
            write_json_array(records, args.document, order, one_file=args.one_file, pretty=args.pretty)
        if args.topic:
            messages = tables.enter_context(site_alert.site_alert_messages(records, args.form))
            _publish(spark, Feed(lambda _: messages, [], args.topic), args)
    if args.document and args.archive:
        print(move_to_archive(spark, args.document))


def _ingest(spark: SparkSession, args: argparse.Namespace, decode, start, **layout) -> None:
    messages = reduce(DataFrame.unionByName, [stream_topic(spark, t) for t in args.topic])
    corrupt = args.corrupt_column
    if args.quarantine:
        if start is not start_committed_batches:
            raise SystemExit("--quarantine needs committed batches")
        corrupt = corrupt or "corrupt"
        layout["split"] = malformed(corrupt)
    query = start(
        decode(messages, corrupt_column=corrupt),
        args.out,
        args.checkpoint,
        interval=None if args.once else args.interval,
        max_records_per_file=args.max_records_per_file,
        **layout,
    )
    run_until_stopped(query)


def score_ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    _ingest(spark, args, router_score.score_records, start_committed_batches)


def location_ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    _ingest(
        spark,
        args,
        location_events.location_records,
        start_committed_batches if args.batch_folders else start_json_sink,
        partition_by=location_events.PARTITION_BY,
        compression=location_events.COMPRESSION,
        rebalance=args.backlog,
    )


def stream_fan_out(spark: SparkSession, args: argparse.Namespace) -> None:
    messages = reduce(DataFrame.unionByName, [stream_topic(spark, t) for t in args.topic])
    names = [name for name, _ in args.to]
    if len(set(names)) < len(names):
        raise SystemExit("two topics of the same name")
    interval = None if args.once else args.interval
    run_until_stopped(start_fan_out(messages, dict(args.to), args.out, args.checkpoint, interval))


def compact_batches(spark: SparkSession, args: argparse.Namespace) -> None:
    before = int(datetime.fromisoformat(args.before).replace(tzinfo=UTC).timestamp() * 1000)
    partitions = args.partition_by.split(",") if args.partition_by else ()
    print(compact(spark, args.path, before, args.file_bytes, partitions, args.compression))
    if args.keep_hours is not None:
        Commits(spark, args.path).vacuum(int(args.keep_hours * HOUR))


def named_topic(text: str) -> tuple[str, Topic]:
    """``name=`` and a topic as JSON."""
    name, _, rest = text.partition("=")
    return name, topic(rest)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="meshfeed", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, run, days_back: int | None = None) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        sub.add_argument(
            "--topic", type=topic, action="append", default=[], required=name not in ("site-alert", "compact")
        )
        sub.add_argument(
            "--shuffle-partitions", type=int, help="about the bytes shuffled divided by 128 MB"
        )
        if days_back is not None:
            sub.add_argument("--root", required=True, help="folder that holds the dated input")
            sub.add_argument("--run-date", default=datetime.now(UTC).date().isoformat())
            sub.add_argument("--days-back", type=int, default=days_back)
            sub.add_argument("--check", action="store_true", help="read the topics back")
            sub.add_argument("--counted", action="store_true", help="check by counts, reading only what was added")
        elif name != "compact":
            sub.add_argument("--out", required=True)
            sub.add_argument("--checkpoint", required=True)
            sub.add_argument("--once", action="store_true", help="stop when all is read")
            if name == "fan-out":
                return sub
            sub.add_argument("--corrupt-column", help="keep malformed messages in this column")
            sub.add_argument("--max-records-per-file", type=int, default=5_000_000)
            sub.add_argument("--quarantine", action="store_true", help="malformed messages into a sink of their own")
        return sub

    sub = job("router-score", router_scores, 1)
    sub.add_argument("--variant", choices=("home", "fiber"), default="home")
    sub.add_argument("--sample-topic", type=topic, action="append", default=[])

    sub = job("activation", activations, activation.DAYS_BACK)
    sub.add_argument("--name", default="{day}", help="input name, with {day}")
    sub.add_argument("--schema", help="column types as DDL; else they are inferred in a second read")
    sub.add_argument("--trial-order", nargs="+", help="send two rows only, first by these columns")

    sub = job("site-alert", site_alerts, 1)
    sub.add_argument("--name", default="{day}", help="input name, with {day}")
    sub.add_argument("--link-prefix", required=True)
    sub.add_argument("--document", help="folder for the report as one JSON array")
    sub.add_argument("--sort", action="store_true", help="sort the document")
    sub.add_argument("--one-file", action="store_true", help="the document as one file, not a folder of parts")
    sub.add_argument("--pretty", action="store_true", help="a line for each field")
    sub.add_argument("--by-name", action="store_true", help="files may have their columns in any order")
    sub.add_argument("--columns", help="names of all columns in order, if not the usual ones")
    sub.add_argument(
        "--form", choices=sorted(site_alert.FORMS), default="records", help="messages of the report"
    )
    sub.add_argument("--archive", action="store_true", help="then move the document to archive/")

    sub = job("score-ingest", score_ingest)
    sub.add_argument("--interval", default="10 seconds")

    sub = job("location-ingest", location_ingest)
    sub.add_argument("--interval", default=location_events.INTERVAL)
    sub.add_argument(
        "--backlog", action="store_true", help="bring each hour together, split by size"
    )
    sub.add_argument("--batch-folders", action="store_true", help="one folder for each batch")

    sub = job("fan-out", stream_fan_out)
    sub.add_argument("--to", type=named_topic, action="append", required=True, help="NAME=topic")
    sub.add_argument("--interval", default="10 seconds")

    sub = job("compact", compact_batches)
    sub.add_argument("--path", required=True, help="folder of committed batches")
    sub.add_argument("--before", required=True, help="UTC time; hours that ended by then are rewritten")
    sub.add_argument("--file-bytes", type=int, default=128 << 20)
    sub.add_argument("--partition-by", help="partition columns of the batches")
    sub.add_argument("--compression")
    sub.add_argument("--keep-hours", type=float, help="then delete folders replaced so long ago")
    return top


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"meshfeed-{args.job}", shuffle_partitions=args.shuffle_partitions)
    args.run(spark, args)


if __name__ == "__main__":
    main()
