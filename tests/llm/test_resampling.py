"""Resampling against CRCs of every n-gram, a sort in Python, and a planted target."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from meshfeed.llm import resampling

SCHEMA = "doc_id bigint, text string"


def words(text):
    lower = (text or "").translate({n: n + 32 for n in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def grams(text, least, most):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in range(least, most + 1) for i in range(len(w) - n + 1)]


def hashes(text, least, most, buckets):
    return [crc32(g.encode()) % buckets for g in grams(text, least, most)]


TEXTS = [
    None, "", "...", "one", "One two, THREE four", "Über Straße über", "日本 語 x", "a-b_c d", "x" * 70000 + " tail " + "y" * 300,
    "the cat sat on the mat " * 40, "the cat sat on the mat " * 40, "Ä ä A a", "zero\x00byte nine",
]


@pytest.mark.parametrize("least, most, chunk", [(1, 1, 1 << 17), (1, 3, 5), (2, 2, 1 << 17)])
def test_features_are_crcs_of_all_ngrams(monkeypatch, least, most, chunk):
    monkeypatch.setattr(resampling, "_CHUNK", chunk)
    texts = [(t or "").encode() for t in TEXTS]
    cuts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    got = [[] for _ in texts]
    for of, bucket in resampling.features(data, cuts, least, most, 1 << 32):
        for t, b in zip(of.tolist(), bucket.tolist(), strict=True):
            got[t].append(b)
    assert got == [hashes(t, least, most, 1 << 32) for t in TEXTS]


def test_shift_cancels_a_prefix_of_any_length():
    for size in (0, 1, 255, 256, 65535, 65536, 1 << 20):
        a, b = b"prefix", b"z" * size
        moved = resampling.shifted(np.array([crc32(a)], np.uint32), np.array([size]))
        assert int(moved[0]) == crc32(a + b) ^ crc32(b)


def brute(docs, target, least=1, most=1, buckets=10000, percent=10, least_words=20, seed=2024):
    s = Counter(b for _, t in docs for b in hashes(t, least, most, buckets))
    t = Counter(b for x in target for b in hashes(x, least, most, buckets))
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    rows = []
    for i, x in docs:
        weight = sum(gain(b) for b in hashes(x, least, most, buckets))
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(grams(x, least, most)), weight, score, len(words(x)) >= least_words))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0]))
    return rows, [(r[0], r[3]) for r in able[: percent * len(able) // 100]]


@pytest.mark.parametrize("least, most", [(1, 1), (1, 2)])
def test_matches_brute_force(spark, least, most):
    docs = [(n, t) for n, t in enumerate(TEXTS * 3)]
    docs += [(100 + n, f"the cat {n} sat on a mat near me " * 4) for n in range(60)]
    docs += [(200, "the very same row " * 9)] * 80 + [(None, "no id at all " * 9)] * 3  # one id with a third of the rows
    target = ["the cat sat", "", None, "a dog and a mat", "the cat sat"]
    table = spark.createDataFrame(docs, SCHEMA)
    goal = spark.createDataFrame([(0, t) for t in target], "n int, body string")
    options = {"least": least, "most": most, "buckets": 500}
    model = resampling.fit(table, goal, target_text="body", **options)
    scored = resampling.weigh(table, model)
    scored = scored.withColumn("score", resampling.noisy_score("doc_id", "weight", 2024))
    found = resampling.ranked(scored, 10, F.col("n_words") >= 20, [F.desc("score"), F.asc_nulls_last("doc_id")]).collect()
    rows, drawn = brute(docs, target, least, most, 500)
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score) for r in found), key=repr) == sorted((r[:4] for r in rows), key=repr)
    ranks = sorted((r["rank"], r.doc_id, r.score) for r in found if r["rank"] is not None)
    assert [r[0] for r in ranks] == list(range(1, len(drawn) + 1))
    assert [r[1:] for r in ranks] == drawn
    kept = resampling.resample(table, goal, 10, target_text="body", **options)
    assert kept.columns == ["doc_id", "text"]
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((d[0] for d in drawn), key=repr)


def test_draws_towards_the_target(spark):
    law = "the court finds that the claim of the party is void under the act and must be dismissed today "
    sea = "we sailed along the coast until a storm broke the mast and drove our little ship to the shore "
    docs = [(n, (law if n % 10 == 0 else sea) + f"number {n}") for n in range(600)]
    table = spark.createDataFrame(docs, SCHEMA)
    goal = spark.createDataFrame([(law,)] * 20, "text string")
    got = {r.doc_id for r in resampling.resample(table, goal, 10).collect()}
    assert len(got) == 60
    assert sum(n % 10 == 0 for n in got) >= 55


def test_clashing_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(n, "a b c " * 9, 5, n) for n in range(20)], "doc_id bigint, text string, weight int, row_of_input int")
    goal = spark.createDataFrame([("a",)], "text string")
    out = resampling.resample(docs, goal, 50)
    assert out.columns == docs.columns and out.count() == 10
    assert {r.weight for r in out.collect()} == {5}
    none = docs.limit(0)
    assert resampling.resample(none, goal, 50).collect() == []
    assert set(resampling.fit(none, goal.limit(0)).gains.tolist()) == {0}
    assert resampling.resample(docs.withColumnRenamed("text", "n_words"), goal, 50, text="n_words").count() == 10
    with pytest.raises(ValueError):
        resampling.fit(docs, goal, least=0)
