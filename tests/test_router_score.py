import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshfeed.operators.columns import encode_rows
from meshfeed.plans import router_score as rs

SCHEMA = T.StructType(
    [T.StructField(n, T.StringType(), True) for n in rs.IDENTITY]
    + [T.StructField(n, T.FloatType(), True) for n in rs.SCORES]
    + [T.StructField(rs.MODEL_LISTS, T.ArrayType(T.ArrayType(T.StringType())), True)]
)


def router(serial, models, mdn="5550001", cust="7", score=80.5):
    return (serial, mdn, cust, "2024-01-05", 1.0, 2.0, 3.0, score, models)


@pytest.fixture(scope="module")
def routers(spark):
    rows = [
        router("match-first", [["CR1000A", "OTHER"]]),
        router("match-second", [["OTHER"], ["XCI55AX"]]),
        router("match-twice", [["CR1000A"], ["CR1000A", "CR1000A"]]),
        router("two-models", [["CR1000A", "XCI55AX"]]),
        router("no-match", [["OTHER"]]),
        router("null-outer", None),
        router("empty-outer", []),
        router("null-inner", [None, ["G3100"], ["CR1000A"]]),
        router("empty-inner", [[]]),
        router("null-model", [[None, "CR1000A"]]),
        router("filled", [["CR1000A"]], mdn=None, cust=None),
        router("filled", [["CR1000A"]], mdn="0000000000", cust="000000000"),
        router("no-score", [["CR1000A"]], score=None),
        router("copy", [["CR1000A"]]),
        router("copy", [["CR1000A"]]),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def values(df):
    return [json.loads(r.value) for r in df.collect()]


def test_feed_has_one_message_per_router_and_model(routers):
    sent = sorted((m["serial_num"], m["dg_model_indiv"]) for m in values(rs.router_score_feed(routers)))
    assert sent == [
        ("copy", "CR1000A"),
        ("filled", "CR1000A"),
        ("filled", "CR1000A"),
        ("match-first", "CR1000A"),
        ("match-second", "XCI55AX"),
        ("match-twice", "CR1000A"),
        ("no-score", "CR1000A"),
        ("null-inner", "CR1000A"),
        ("null-model", "CR1000A"),
        ("two-models", "CR1000A"),
        ("two-models", "XCI55AX"),
    ]


def test_fill_comes_after_distinct_so_filled_rows_stay_apart(routers):
    filled = [m for m in values(rs.router_score_feed(routers)) if m["serial_num"] == "filled"]
    assert len(filled) == 2
    assert filled[0] == filled[1]
    assert filled[0]["mdn"] == "0000000000" and filled[0]["cust_id"] == "000000000"


def test_null_score_is_left_out(routers):
    (message,) = [m for m in values(rs.router_score_feed(routers)) if m["serial_num"] == "no-score"]
    assert "home_score" not in message
    assert list(message) == [*rs.IDENTITY, "poor_rssi", "poor_phyrate", "num_station", rs.MODEL]


def test_anonymous_feed_has_no_customer_columns(routers):
    sent = values(rs.router_score_feed_anon(routers))
    assert {m["serial_num"] for m in sent} >= {"match-first", "null-inner", "copy"}
    assert all("mdn" not in m and "cust_id" not in m for m in sent)
    assert {m["dg_model_indiv"] for m in sent} == {"CR1000A", "G3100"}
    # without the numbers the two filled rows are copies of each other
    assert sum(m["serial_num"] == "filled" for m in sent) == 1


def test_sample_keeps_a_router_with_any_matching_model(routers):
    sent = values(rs.sample_feed(routers, count=100))
    assert "match-second" in {m["serial_num"] for m in sent}
    assert all(list(m) == list(rs.IDENTITY) for m in sent)
    # two models of one router are one row here
    assert sum(m["serial_num"] == "two-models" for m in sent) == 1


def test_sample_is_the_same_every_time(routers):
    first = values(rs.sample_feed(routers, count=3))
    again = values(rs.sample_feed(routers.repartition(5), count=3))
    assert first == again
    assert [m["serial_num"] for m in first] == ["copy", "filled", "filled"]


def test_records_come_back_from_messages(routers):
    rows = rs.router_score_rows(routers)
    back = rs.score_records(encode_rows(rows))
    assert back.schema.simpleString() == rs.MESSAGE_SCHEMA.simpleString()
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))


def test_hot_router_is_merged_before_the_shuffle(spark):
    """A third of all rows are copies of one router: they leave each task as one row."""
    hot = spark.range(0, 30_000, 1, 6).withColumn(
        "serial_num",
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")),
    )
    rows = hot.select(
        "serial_num",
        F.lit("m").alias("mdn"),
        F.lit("c").alias("cust_id"),
        F.lit("d").alias("date"),
        *[F.lit(1.0).cast("float").alias(n) for n in rs.SCORES],
        F.array(F.array(F.lit("CR1000A"))).alias(rs.MODEL_LISTS),
    )
    result = rs.router_score_rows(rows)
    assert result.count() == 20_001
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2
    assert plan.count("Exchange") == 1
    assert "SortAggregate" not in plan
