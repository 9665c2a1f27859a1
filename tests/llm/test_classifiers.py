import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from meshfeed.llm import language, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def held_out(divisor, which):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor == which


@pytest.fixture(scope="module")
def toxic_model(spark, docs):
    return toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"), held_out=held_out(4, 2))


@pytest.fixture(scope="module")
def language_model(docs):
    return language.fit(docs, held_out=held_out(5, 0))


def test_toxicity_on_held_out_documents(spark, docs, toxic_model):
    scored = toxicity.score(docs.where(held_out(4, 2)), toxic_model).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    rows = scored.select("toxic", "toxicity").collect()
    clean = [r.toxicity >= 0.3 for r in rows if r.toxic == 0]
    bad = [r.toxicity >= 0.3 for r in rows if r.toxic == 1]
    assert np.mean(clean) <= 0.05
    assert np.mean(bad) >= 0.5  # 50 toxic labels in all, part of them in languages with 5 to learn from
    assert all(0 <= r.toxicity <= 1 for r in rows)


def test_toxicity_learns_from_the_larger_tables(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels, held_out=held_out(4, 2))
    rows = toxicity.score(docs.where(held_out(4, 2)), model).join(labels, "doc_id").select("toxic", "toxicity").collect()
    assert np.mean([r.toxicity >= 0.3 for r in rows if r.toxic == 1]) >= 0.9
    assert np.mean([r.toxicity >= 0.3 for r in rows if r.toxic == 0]) <= 0.01


def noisy_or(text, model):
    """Score and offending sentences, one sentence and one feature at a time."""
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    clean, found, at = 1 - model.leak, [], 0
    for part in re.split(r"([.!?\n])", lower):
        words = list(re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", part))
        if words:
            own = {w[0] + " " for w in words} | {w[0][:n] for w in words for n in range(3, 9) if len(w[0]) >= n}
            p = 1 / (1 + math.exp(-model.bias - sum(v for f, v in zip(model.features, model.weights, strict=True) if f in own)))
            clean *= 1 - p
            if p >= 0.3:
                found.append((at + words[0].start(), at + words[-1].end()))
        at += len(part)
    return 1 - clean, found


def test_toxicity_is_the_noisy_or_of_all_sentences(spark, docs, toxic_model):
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, " .!? "), (-4, "loser " * 30_000), (-5, "Ünique LOSER\nloser")], "doc_id bigint, text string")
    scored = toxicity.score(docs.select("doc_id", "text").union(odd), toxic_model).collect()
    assert len(scored) > 1000 and any(r.offending for r in scored)
    for r in scored:
        want, found = noisy_or(r.text, toxic_model)
        assert r.toxicity == pytest.approx(want, abs=1e-9)
        assert [(s.start, s.end) for s in r.offending] == found


def test_the_sample_is_bounded_and_keeps_the_rates(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 20 == 0, "such an idiot. a word").when(F.col("id") % 20 == 1, "a clown? a word").otherwise("a word").alias("text"),
    )
    labels = docs.select("doc_id", ((F.col("doc_id") % 20 == 0) | (F.col("doc_id") % 40 == 1)).cast("int").alias("toxic"))
    repeated = docs.union(docs).union(docs.select("doc_id", F.lit("z other text").alias("text")))
    model = toxicity.fit(repeated, labels.union(labels), sample_rows=400, toxic_weight=1.0)
    assert {"idiot ", "clown "} <= set(model.features)
    by_text = {r.text: r.toxicity for r in toxicity.score(docs, model).select("text", "toxicity").distinct().collect()}
    assert by_text["such an idiot. a word"] > 0.95 and by_text["a word"] < 0.02
    assert by_text["a clown? a word"] == pytest.approx(0.5, abs=0.15)  # half of all of them, not of the sample


def test_offending_sentences_are_located(spark):
    model = toxicity.Model(["idiot ", "größt"], np.array([9.0, 9.0]), -6.0, 0.01)
    texts = ["Übung eins. You IDIOT there! Fine.", "die größten Sachen\nrest", "idiotic", None, "", "...!!", "idiot " * 20_000]
    rows = toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), model).collect()
    by_id = {r.doc_id: r for r in rows}
    assert [texts[0][s.start : s.end] for s in by_id[0].offending] == ["You IDIOT there"]
    assert [texts[1][s.start : s.end] for s in by_id[1].offending] == ["die größten Sachen"]
    for k in (2, 3, 4, 5):
        assert by_id[k].offending == [] and by_id[k].toxicity < 0.02
    assert len(by_id[6].offending) == 1  # one sentence, however long
    assert by_id[0].toxicity == pytest.approx(by_id[6].toxicity, abs=0.01)


def test_toxic_documents_go_and_columns_stay(spark):
    model = toxicity.Model(["idiot "], np.array([9.0]), -6.0, 0.01)
    docs = spark.createDataFrame([(1, "an idiot", "a"), (2, "fine", "b"), (2, "fine", "b"), (None, None, None)], "doc_id int, text string, Toxicity string")
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "2", "None"]


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a text"), (2, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 0)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    assert model.features == [] and model.leak == 1.0
    assert toxicity.fit(docs, labels.limit(0)).leak == 0.0
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert toxicity.score(docs, model).count() == 2


def test_language_on_held_out_documents(docs, language_model):
    rows = language.identify(docs.where(held_out(5, 0)), language_model).select("lang", "lang_pred", "lang_score").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) >= 0.97
    assert all(0 <= r.lang_score <= 1 for r in rows)


def test_language_sample_is_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(language, "_pairs", lambda names, labels, x: seen.append(list(labels)) or [])
    rows = [(k, f"the text of {k} words", "en") for k in range(300)] + [(7, "das ist ein Text", "de")] * 500 + [(None, "un texte", "fr")] * 500
    language.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4), sample_rows=60)
    assert sorted(seen[0]) == ["germanic"] * 21 + ["romance"]
    assert sorted(seen[1]) == ["de"] + ["en"] * 20 + ["fr"]


def test_language_edge_cases(spark, language_model):
    texts = [None, "", "12 34 !!", "²¼", "中文", "what is that with the and from this for was " * 4_000, "der die das und nicht eine"]
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id int, text string, lang_pred string")
    rows = {r.doc_id: r for r in language.identify(docs, language_model).collect()}
    assert [rows[k].lang_pred for k in range(4)] == ["und"] * 4
    assert rows[4].lang_pred in {"en", "de", "fr", "es"}
    assert rows[5].lang_pred == "en" and rows[6].lang_pred == "de"
    assert language.identify(docs.limit(0), language_model).count() == 0


def test_language_without_or_with_one_language(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, None, "en")], "doc_id int, text string, lang string")
    assert {r.lang_pred for r in language.identify(docs, language.fit(docs)).collect()} == {"und"}
    one = spark.createDataFrame([(1, "some text", "en"), (2, "more", "en")], "doc_id int, text string, lang string")
    rows = language.identify(one, language.fit(one)).collect()
    assert {(r.lang_pred, r.lang_score) for r in rows} == {("en", 1.0)}


def test_unknown_languages_are_their_own_family(spark):
    rows = [(k, "zu ka ri mo " * 5, "xx") for k in range(30)] + [(50 + k, "the of and is " * 5, "en") for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    model = language.fit(docs)
    assert model.families == {"germanic": ["en"], "xx": ["xx"]}
    assert all(r.lang == r.lang_pred for r in language.identify(docs, model).collect())
