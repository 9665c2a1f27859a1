"""Personal data: what is always found, what the trees decide, and time in one text."""

import time

import pytest
from pyspark.sql import functions as F

from meshfeed.llm import pii

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def proposed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("proposed") / "table")
    pii.propose(spark.read.parquet(f"{SF}/documents.parquet")).drop("text").write.parquet(folder)
    return spark.read.parquet(folder)


@pytest.fixture(scope="module")
def model(proposed):
    return pii.fit(proposed)


def spans(spark, texts, model):
    docs = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    found = {r.n: r.pii_spans for r in pii.find(docs, model).collect()}
    return [[(s.kind, t[s.start : s.end]) for s in found[n]] for n, t in enumerate(texts)]


def test_no_blank_and_no_distance_hides_a_secret(spark, model):
    gaps = ["", " " * 21, " " * 30, "\t" * 4000]
    texts = [f"password{g}={h}hunter2!x and" for g in gaps for h in gaps]
    assert spans(spark, texts, model) == [[("secret", "hunter2!x")]] * len(texts)
    assert spans(spark, texts, pii.Model([], {})) == [[("secret", "hunter2!x")]] * len(texts)
    far = ["passphrase: correct horse", "API-Key:   \"ab.c!d\"", "pwd=x", "token token=tokentoken1 2"]
    assert spans(spark, far, pii.Model([], {})) == [[("secret", w)] for w in ("correct", "ab.c!d", "x", "tokentoken1")]


def test_the_trees_decide(spark, model):
    """Forms that no base form has are redacted by the trees alone; numbers that only look alike stay."""
    texts = [
        "mail bob (at) example (dot) org now", "write to bob.smith [at] example.org please", "call (826) 555-4081 or",
        "call 030 123 4567 soon", "card 4111.1111.1111.1111 ok", "server 10-20-30-40 down",
    ]
    want = ["bob (at) example (dot) org", "bob.smith [at] example.org", "(826) 555-4081", "030 123 4567", "4111.1111.1111.1111", "10-20-30-40"]
    assert [[w for _, w in s] for s in spans(spark, texts, model)] == [[w] for w in want]
    assert spans(spark, texts, pii.Model([], {})) == [[]] * len(texts)
    plain = ["a thoroughly internationalised text", "4111.1111.1111.1112 units, 712-300-400-500", "9312345678901236 rows", "year 1999-2000, 300-400-500", ""]
    assert spans(spark, plain, model) == [[]] * len(plain)


def test_held_out_precision_and_recall(spark, model):
    """Rewritten spans of documents that the model has not seen, against what is proposed there anyway."""
    other = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id % 10 = 3 and doc_id > 1000")
    found = pii.propose(other)
    cases = F.filter(F.flatten(F.transform(F.concat("pii_base", F.filter("pii_loose", lambda s: s["sure"])), pii._rewritten)), pii._proposable)
    lone = F.filter("pii_loose", lambda s: ~s["sure"])
    shape = lambda s: F.struct(s["kind"].alias("kind"), s["text"].alias("text"), s["left"].alias("left"), s["right"].alias("right"))
    rows = found.select(F.explode(F.transform(cases, shape)).alias("c"), F.lit(1).alias("case")).union(
        found.select(F.explode(F.transform(lone, shape)).alias("c"), F.lit(0).alias("case"))
    )
    sure = F.struct(F.lit(False).alias("sure"), F.col("c.kind").alias("kind"))
    chosen = pii._odds_pass({"c": sure, "f": pii._features(F.col("c"))}, model)
    counts = {(r.kind, r.case): (r.n, r.hits) for r in rows.select("c.kind", "case", chosen.cast("int").alias("hit")).groupBy("kind", "case").agg(F.count("*").alias("n"), F.sum("hit").alias("hits")).collect()}
    hits = sum(h for (_, case), (_, h) in counts.items() if case)
    wrong = sum(h for (_, case), (_, h) in counts.items() if not case)
    assert hits >= 0.9 * (hits + wrong)
    for kind in range(4):
        n, found_ = counts[kind, 1]
        assert n > 20 and found_ >= 0.8 * n


def test_spans_keep_their_places_in_long_lists(spark, monkeypatch):
    """Lists longer than a chunk, overlaps of all sorts, marks in the text."""
    texts = [
        "a@b.c " * 700, "password=x1 " * 600 + "a@b.c", "\ue000 a@b.c \ue001password: \ue000b", "x" * 3 + " bob (at) b.org a@b.c,d@e.f " * 300,
        "password=a@b.c password=10.0.0.1 " * 3,
    ]
    once = spans(spark, texts, pii.Model([], {}))
    monkeypatch.setattr(pii, "_CHUNK", 7)
    assert spans(spark, texts, pii.Model([], {})) == once
    assert [len(s) for s in once] == [700, 601, 2, 600, 6]
    assert {w for _, w in once[0]} == {"a@b.c"} and once[2][0] == ("email", "a@b.c")
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    clean = [r.text for r in pii.redact(docs, pii.Model([], {})).collect()]
    assert clean[0] == "[EMAIL] " * 700 and clean[1] == "password=[SECRET] " * 600 + "[EMAIL]"
    assert clean[4] == "password=[EMAIL] password=[IP] " * 3


def test_time_follows_the_number_of_matches(spark, model):
    def seconds(n):
        docs = spark.createDataFrame([("a@b.cc, bob (at) b.org; password: x9 " * n,)], "text string")
        start = time.perf_counter()
        (row,) = pii.redact(docs, model).select(F.length("text").alias("n"), F.md5("text").alias("m")).collect()
        assert row.n == len("[EMAIL], [EMAIL]; password: [SECRET] ") * n
        return time.perf_counter() - start

    seconds(100)
    few, many = seconds(2000), seconds(16000)
    assert many < 2.5 * 8 * max(few, 1.0)


def test_model_and_redaction_together(spark, model):
    docs = spark.createDataFrame([(1, "a@b.c", "x"), (2, None, "y"), (3, "", "z")], "doc_id int, text string, pii_docs string")
    clean = pii.fit_and_redact(docs)
    assert clean.columns == docs.columns
    assert sorted(map(tuple, clean.collect())) == [(1, "[EMAIL]", "x"), (2, None, "y"), (3, "", "z")]
    assert pii.fit_and_redact(docs.limit(0)).count() == 0
