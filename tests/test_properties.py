import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from meshfeed.functions.alerts import alerting_json, alerting_map
from meshfeed.operators.columns import decode_messages, encode_rows
from meshfeed.operators.rows import distinct_rows, explode_nested

few = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
text = st.text(st.characters(blacklist_categories=("Cs",)), max_size=8)
maybe = st.one_of(st.none(), text)

ROW = T.StructType(
    [
        T.StructField("a.b", T.StringType(), True),
        T.StructField("n", T.LongType(), True),
        T.StructField("x", T.DoubleType(), True),
        T.StructField("l", T.ArrayType(T.StringType()), True),
    ]
)
rows = st.lists(
    st.tuples(
        maybe,
        st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1)),
        st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False)),
        st.one_of(st.none(), st.lists(text, max_size=3)),
    ),
    min_size=1,
    max_size=6,
)


@few
@given(rows)
def test_decode_undoes_encode(spark, data):
    df = spark.createDataFrame(data, ROW)
    for keep_nulls in (False, True):
        back = decode_messages(encode_rows(df, keep_nulls), ROW)
        assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))


@few
@given(st.lists(st.one_of(st.none(), st.lists(st.one_of(st.none(), st.lists(maybe, max_size=3)), max_size=3)), max_size=5))
def test_explode_gives_every_inner_element(spark, nested):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(nested)], "id int, a array<array<string>>")
    got = [(r.id, r.e) for r in explode_nested(df, "a", "e").collect()]
    expected = [(i, e) for i, n in enumerate(nested) for inner in n or [] for e in inner or []]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


@few
@given(st.lists(st.tuples(maybe, st.booleans()), max_size=8))
def test_distinct_is_idempotent(spark, data):
    df = spark.createDataFrame(data, "a string, b boolean")
    once = distinct_rows(df)
    assert once.count() == len(set(data)) == distinct_rows(once).count()


flag = st.one_of(st.none(), st.sampled_from(["0", "1", "0.0", ""]))


@few
@given(st.lists(st.tuples(maybe, maybe, flag, flag), min_size=1, max_size=5))
def test_gated_features_are_those_with_a_raised_flag(spark, data):
    df = spark.createDataFrame(data, "f string, g string, f_alert string, g_alert string")
    picked = df.select("*", alerting_json(["f", "g"]).alias("j"), alerting_map(["f", "g"]).alias("m"))
    for row in picked.collect():
        expected = {
            n: row[n]
            for n in ("f", "g")
            if row[n] is not None and row[f"{n}_alert"] not in (None, "0")
        }
        assert json.loads(row.j) == row.m == expected


def test_column_names_are_taken_to_the_letter(spark):
    from meshfeed.operators.columns import project, select_except

    df = spark.createDataFrame([(1, 2, 3)], "`a.b` int, c int, d int")
    assert select_except(df, ["c", "D"]).columns == ["a.b", "d"]
    assert project(df, ["d", "a.b"]).first() == (3, 1)
    with pytest.raises(Exception):
        project(df, ["absent"])
