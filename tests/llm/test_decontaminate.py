import random
import re

import pytest
from pyspark.sql import functions as F

from meshfeed.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII_LOWER = {k: k + 32 for k in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(ASCII_LOWER))


def brute(docs, items, window):
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - window + 1)) if w and i is not None else ():
            windows.setdefault(tuple(w[k : k + window]), set()).add(str(i))
    out = []
    for i, t in docs:
        w, hit, own = words(t), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    own |= windows[tuple(w[k : k + n])]
        out.append((str(i), len(w), len(hit), sorted(own)))
    return sorted(out)


def found(df):
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in df.collect())


ITEMS = [
    (1, "The quick brown fox, jumps over the lazy dog; again and again."), (2, "Short item"), (3, "ÄRGER größer als 12 Äpfel"),
    (4, None), (5, ""), (None, "nobody asks this"), (1, "a second text of the same item id, long enough to count here"),
    (6, "again and again again and again again and again again"),
]
DOCS = [
    (1, "xx THE QUICK BROWN FOX JUMPS OVER THE LAZY DOG AGAIN and again yy"), (2, "a short item, short\nitem"), (3, None), (4, ""),
    (5, "the quick brown fox jumps over the lazy dog"), (5, "the quick brown fox jumps over the lazy dog again"),
    (6, "ÄRGER größer als 12 Äpfel ärger größer als 12 äpfel"), (7, "again and " * 40), (8, "word " * 50_000 + "short item"),
    (None, "short item nobody asks this"), (9, "!!! ... ???"), (10, "short"), (11, "item short"),
]


def frames(spark):
    return (
        spark.createDataFrame(DOCS, "doc_id bigint, text string"),
        spark.createDataFrame(ITEMS, "item_id bigint, text string"),
    )


def test_edge_cases_match_brute_force(spark):
    docs, items = frames(spark)
    for window in (1, 4, 10):
        assert found(d.find_contamination(docs, items, window=window)) == brute(DOCS, ITEMS, window)


def test_blocks_give_the_same(spark):
    docs, items = frames(spark)
    one = d.find_contamination(docs, items, window=4)
    many = d.find_contamination(docs, items, window=4, block_bytes=40)
    key = lambda r: (str(r.doc_id), r.n_words, r.n_hit, r.hit_spans, r["items"], r.longest and r.longest.words)
    assert sorted(map(key, one.collect()), key=str) == sorted(map(key, many.collect()), key=str)


def longest(doc, items, window):
    """Words of the longest match that begins where a window of an item occurs, and its first place."""
    texts = [words(t) for i, t in items if i is not None]
    w, best = words(doc), (0, 0)
    heads = {tuple(t[k : k + window]) for t in texts for k in range(max(1, len(t) - window + 1)) if t}
    for at in range(len(w)):
        if any(tuple(w[at : at + n]) in heads for n in {len(h) for h in heads}):
            for t in texts:
                for k in range(len(t)):
                    n = 0
                    while at + n < len(w) and k + n < len(t) and w[at + n] == t[k + n]:
                        n += 1
                    best = max(best, (n, -at))
    return best[0], -best[1]


@pytest.mark.parametrize("block_bytes", [d.BLOCK_BYTES, 60])
def test_longest_matches_match_brute_force(spark, block_bytes):
    draw = random.Random(5)
    text = lambda n: " ".join(draw.choice("abc") for _ in range(n))
    items = [(k, text(draw.randrange(1, 40))) for k in range(12)]
    docs = [(k, f"{text(draw.randrange(60))} {draw.choice(items)[1]} x {text(9)}") for k in range(40)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    for window in (3, 8):
        rows = d.find_contamination(
            frame, spark.createDataFrame(items, "item_id bigint, text string"), window=window, block_bytes=block_bytes
        ).collect()
        own = dict(docs)
        for r in rows:
            if block_bytes == d.BLOCK_BYTES:
                assert (r.longest.words, r.longest.at) == longest(own[r.doc_id], items, window)
            at, n = r.longest.at, r.longest.words
            assert " ".join(words(own[r.doc_id])[at : at + n]) in dict(items)[int(r.longest["item"])]
        assert sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in rows) == brute(docs, items, window)


def test_repeated_items_are_collected_once(spark):
    items = spark.createDataFrame([(1, "a phrase of five words")] * 500, "item_id bigint, text string")
    n, blocks = d._blocks(items.selectExpr("cast(item_id as string) as item", "text").distinct(), 200)
    assert n == 1 and [len(b) for b in blocks] == [1]


def test_many_blocks_keep_columns_and_repeated_rows(spark):
    docs, items = frames(spark)
    docs = docs.union(docs).withColumn("number", F.lit(1)).withColumn("parts_found", F.lit("mine"))
    rows = d.find_contamination(docs, items, window=4, block_bytes=60)
    assert rows.columns[:4] == docs.columns
    assert found(rows) == sorted(brute(DOCS, ITEMS, 4) * 2)
    assert {(r.number, r.parts_found) for r in rows.collect()} == {(1, "mine")}
    assert d.find_contamination(docs.limit(0), items, window=4, block_bytes=60).count() == 0


def test_periodic_texts(spark):
    docs = spark.createDataFrame([(1, "to be " * 60_000)], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "be to " * 1_000)], "item_id bigint, text string")
    row = d.find_contamination(docs, items).first()
    assert (row.n_words, row.n_hit, row.longest.words, row.longest.at) == (120_000, 120_000, 2_000, 1)


def test_longest_match_and_spans(spark):
    docs, items = frames(spark)
    rows = {r.doc_id: r for r in d.find_contamination(docs.where("doc_id in (1, 3, 5)"), items, window=9).collect()}
    assert tuple(rows[1].longest) == ("1", 12, 1)
    assert [tuple(s) for s in rows[1].hit_spans] == [(1, 12)]
    assert rows[3].longest is None and rows[3].hit_spans == []


def test_documents_go_and_columns_stay(spark):
    docs, items = frames(spark)
    docs = docs.withColumn("items", F.lit("mine")).withColumn("N_WORDS", F.lit(5))
    kept = d.decontaminate(docs, items, window=10)
    assert kept.columns == docs.columns
    clean = {i for i, _, n, _ in brute(DOCS, ITEMS, 10) if n == 0}
    assert {str(r.doc_id) for r in kept.collect()} == clean | {"5"}
    assert {r["items"] for r in kept.collect()} == {"mine"}


def test_empty_tables(spark):
    docs, items = frames(spark)
    assert d.find_contamination(docs.limit(0), items).count() == 0
    assert d.decontaminate(docs, items.limit(0)).count() == len(DOCS)
