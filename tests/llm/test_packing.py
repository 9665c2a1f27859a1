import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from meshfeed.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(PATH)


def check_places(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for inside in bins.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= capacity
    return bins


USUAL = "It's we'll you'd I'm THE é ß İ ı ª º ² ¼ ½ 12 3a a1 ' '' 's 't ’ “ … — <|endoftext|> <| ~ _ _a \x1c\x1f\x85\xa0 Σίσυφος ΟΔΟΣ 中文 é ﬁ 😀 ​".split(" ")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=20), st.sampled_from(USUAL), st.text(alphabet="abÀéßÿŉſ'’ \n\t0²¾_", max_size=15)), max_size=6))
def test_ids_are_the_tokenizers_own(parts):
    tokenizer = packing.tokenizer(PATH)
    texts = [" ".join(parts), "".join(parts), ""]
    ids, cuts = tokenizer.encode(texts)
    for k, t in enumerate(texts):
        assert ids[cuts[k] : cuts[k + 1]].tolist() == tokenizer.whole.encode(t, add_special_tokens=False).ids


def test_cache_is_forgotten(monkeypatch, whole):
    monkeypatch.setattr(packing, "WORD_CACHE", 5)
    own = packing.WordTokenizer(PATH)
    for text in ("one two three four five six seven", "two seven eight", "one"):
        ids, _ = own.encode([text])
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 30), max_size=25))
def test_bins_hold_every_piece(counts):
    bins = packing.plan_bins(counts, 60)
    held = {}
    for many, inside in bins:
        assert sum(inside) <= 60
        assert sum(3 * n > 60 for n in inside) <= 2
        for n in inside:
            held[n] = held.get(n, 0) + many
    assert held == counts
    total = sum(n * c for n, c in counts.items())
    assert sum(m for m, _ in bins) <= 2 * -(-total // 60) + 1  # no two bins would fit into one


def test_documents(spark, whole):
    rows = [(1, "Hello world"), (1, "Hello world"), (2, None), (3, ""), (4, "word " * 9000), (None, "Σ unusual 😀"), (5, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("sequence_id", F.lit("mine"))
    packed = packing.pack_documents(docs, PATH, capacity=16).collect()
    check_places(packed, 16)
    want = []
    for i, t in rows:
        ids = whole.encode(t or "", add_special_tokens=False).ids + [1]
        want += [(str(i), k // 16, k, ids[k : k + 16]) for k in range(0, len(ids), 16)]
    got = [(str(r.doc_id), r.piece, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in packed]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert all(r.length == len(r.ids) // 4 for r in packed)


def test_hot_length_and_digest(spark):
    docs = spark.range(3000, numPartitions=7).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"))
    rows = packing.pack_documents(docs, PATH, capacity=10, content={"crc": F.crc32("ids")}).collect()
    bins = check_places(rows, 10)
    length = rows[0].length
    assert len(bins) == -(-3000 // (10 // length))
    ids = packing.tokenizer(PATH).whole.encode("same text", add_special_tokens=False).ids + [1]
    assert {r.crc for r in rows} == {zlib.crc32(np.array(ids, "<u4").tobytes())}


def test_empty_table_and_bad_lengths(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert packing.pack_documents(docs, PATH).count() == 0
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, None), (2, 3)], "doc_id int, length bigint"), 10)


def test_one_python_step_makes_and_numbers_the_pieces(spark, monkeypatch):
    """Two of them in one task are two Python workers for each core."""
    write, steps = packing.stage, []

    def stage(df, purpose):
        steps.append(df._jdf.queryExecution().executedPlan().toString().count("MapInArrow"))
        return write(df, purpose)

    monkeypatch.setattr(packing, "stage", stage)
    docs = spark.createDataFrame([(k, "word " * (k % 5 * 7)) for k in range(60)] + [(None, None), (3, "a b")], "doc_id bigint, text string")
    kept = {"pack_part": F.crc32("ids"), "pack_local": F.lit("own")}
    out = packing.pack_documents(docs.repartition(4), PATH, capacity=16, content=kept)
    assert steps == [1]
    assert out.columns == ["doc_id", "piece", "start", "length", "pack_part", "pack_local", "sequence_id", "offset"]
    rows = out.collect()
    check_places(rows, 16)
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows) == sum(-(-(k % 5 * 7 + 1) // 16) for k in range(60)) + 2


def test_numbers_go_on_from_batch_to_batch():
    seen, sizes = np.zeros(6, np.int64), [5, 1, 5, 5, 2, 1, 5]
    cuts = [0, 0, 2, 5, 7]
    got = [packing._numbers(np.array(sizes[a:b], np.int64), seen).tolist() for a, b in zip(cuts, cuts[1:], strict=False)]
    assert got == [[], [0, 0], [1, 2, 0], [1, 3]]
