"""How the feeds grow: the test tables repeated, with a third of all rows in one hot group.

    python benchmarks/scale_trial.py FOLDER 1 10 40

For each factor the inputs are written below FOLDER once, then each feed runs to the end;
``TRIAL_FEEDS=a,b`` picks feeds, ``TRIAL_MEMORY=2g`` sets the heap.
Prints one line per feed: seconds, input rows per second, and the share of the output rows that
the fullest task had.
"""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from meshfeed.catalog import standins  # noqa: E402
from meshfeed.plans import location_events, router_score, site_alert  # noqa: E402
from meshfeed.session import build_session  # noqa: E402
from meshfeed.sinks.messages import delivery_check  # noqa: E402
from meshfeed.streaming.ingest import rebalanced  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")

WANTED = [n for n in os.environ.get("TRIAL_FEEDS", "").split(",") if n]


def repeated(df: DataFrame, factor: int, key: str) -> DataFrame:
    """``factor`` times the rows under new keys, and half as many again under one key."""
    copies = df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(factor))))
    cold = copies.withColumn(key, F.concat_ws("-", key, F.col("_copy").cast("string")))
    hot = copies.filter(F.col("_copy") % 2 == 0 if factor > 1 else F.rand(7) < 0.5)
    return cold.unionByName(hot.withColumn(key, F.lit("hot"))).drop("_copy")


def prepared(spark, folder: str, factor: int) -> dict[str, DataFrame]:
    tables = {
        "routers": lambda: repeated(standins.routers(spark, SF_DIR), factor, "serial_num"),
        "sites": lambda: repeated(standins.sites(spark, SF_DIR), factor, "enodeb"),
        "events": lambda: standins.location_messages(spark, SF_DIR).withColumn(
            "value", F.explode(F.array_repeat("value", factor))
        ),
    }
    result = {}
    for name, make in tables.items():
        path = f"{folder}/{name}-{factor}"
        if not os.path.exists(f"{path}/_SUCCESS"):
            make().repartition(max(8, factor)).write.parquet(path)
        result[name] = spark.read.parquet(path)
    return result


def fullest(df: DataFrame) -> float:
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


def main() -> None:
    folder, factors = sys.argv[1], [int(a) for a in sys.argv[2:]] or [1, 10]
    spark = build_session(
        "scale-trial",
        master=f"local[{os.environ.get('BENCH_CPUS', '8')}]",
        shuffle_partitions=32,
        settings={
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("TRIAL_MEMORY", "12g"),
            "spark.checkpoint.dir": f"{folder}/shared",
            # so that the share of the fullest task is that of the shuffle itself
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    for factor in factors:
        tables = prepared(spark, folder, factor)
        routers, sites, events = tables["routers"], tables["sites"], tables["events"]
        feeds = {
            "router_score_feed": (
                routers,
                lambda: router_score.router_score_feed(routers, standins.WORDS),
            ),
            "sample_feed": (routers, lambda: router_score.sample_feed(routers, standins.WORDS)),
            "site_alert_report": (
                sites,
                lambda: site_alert.site_alert_report(sites, standins.LINK_PREFIX),
            ),
            "document": (
                sites,
                lambda: site_alert.site_alert_document(sites, standins.LINK_PREFIX),
            ),
            "document_messages": (
                sites,
                lambda: site_alert.site_alert_messages(sites, standins.LINK_PREFIX),
            ),
            "delivery_check": (events, lambda: delivery_check(events, events)),
            "location_records": (events, lambda: location_events.location_records(events)),
            "location_gathered": (
                events,
                lambda: rebalanced(
                    location_events.location_records(events), location_events.PARTITION_BY
                ),
            ),
        }
        for name, (source, make) in feeds.items():
            if WANTED and name not in WANTED:
                continue
            rows = source.count()
            start = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            share = fullest(make())
            print(
                f"x{factor:<3} {name:<18} {took:7.2f} s {rows / took:12,.0f} rows/s"
                f"  fullest task {share:5.1%}",
                flush=True,
            )
    spark.stop()


if __name__ == "__main__":
    main()
