"""The registered queries that SQL cannot express, run as registered, against plain Python."""

import hashlib
import re
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from meshfeed.llm import queries
from tests.llm.test_expressions import base
from tests.llm.test_extraction import article
from tests.llm.test_near_duplicates import brute

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII_LOWER = {k: k + 32 for k in range(65, 91)}
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def run(spark, name):
    return queries.queries()[name](spark, SF)


def remainder(doc_id, divisor):
    return zlib.crc32(str(doc_id).encode()) % divisor


def test_toxicity(spark, texts):
    df = run(spark, "op2_toxicity_scores")
    assert dict(df.dtypes).items() >= {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}.items()
    rows = df.collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert r.held_out == (remainder(r.doc_id, 4) == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)


def test_language(spark, texts):
    rows = run(spark, "op4_language_identification").collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    known = {r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("lang").distinct().collect()}
    for r in rows:
        assert r.held_out == (remainder(r.doc_id, 5) == 0)
        assert 0 <= r.score <= 1
        letters = any(c.isalpha() for c in texts[r.doc_id] or "")
        assert r.lang_pred in known if letters else r.lang_pred == "und"


def test_personal_data(spark, texts):
    rows = run(spark, "op3_personal_data").collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        want = [(kind, a, b) for a, _, b, kind in base(texts[r.doc_id])]
        line = ",".join(f"{kind}:{a}:{b}" for kind, a, b in want)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        for kind in ("email", "ip", "card", "phone"):
            assert r[f"n_{kind}"] == sum(k == kind for k, _, _ in want)
        all_spans = r.spans.split(",") if r.spans else []
        assert set(filter(None, line.split(","))) <= set(all_spans)
        assert [int(s.split(":")[1]) for s in all_spans] == sorted(int(s.split(":")[1]) for s in all_spans)


def test_licences(spark, texts):
    rows = run(spark, "op9_license_scan").collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        words = WORD.findall((texts[r.doc_id] or "").translate(ASCII_LOWER))
        at = [(k, label) for p, label in PHRASES.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        places = [k for k, _ in at]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == ((min(places), max(places)) if places else (None, None))
        own = sorted({label for _, label in at})
        assert r.base_labels == ",".join(own)
        labels = r.labels.split(",") if r.labels else []
        assert set(own) <= set(labels) and labels == sorted(set(labels))
        assert 0 <= r.score <= 1


def test_near_duplicates(spark, texts):
    rows = run(spark, "op10_simhash_near_duplicates").collect()
    want = [(i, f"{f:016x}", c) for i, f, c in brute(list(texts.items()))]
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows) == want


def test_packing(spark, texts):
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    rows = run(spark, "op5_best_fit_packing").collect()
    of = {}
    for r in rows:
        of.setdefault(r.doc_id, []).append(r)
    assert sorted(of) == sorted(texts)
    for doc_id, pieces in of.items():
        ids = tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids + [1]
        cuts = list(range(0, len(ids), 4096))
        want = [(k, a, min(4096, len(ids) - a), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[a : a + 4096]))) for k, a in enumerate(cuts)]
        assert sorted((p.piece, p.start, p.length, p.ids_crc32) for p in pieces) == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096


def test_main_text(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    df = run(spark, "op7_html_main_text")
    assert dict(df.dtypes).items() >= {"text": "string", "n_chars": "bigint"}.items()
    rows = df.collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    assert all(r.url == pages[r.page_id].url and r.n_chars == len(r.text) for r in rows)
    same = [r.text == article(pages[r.page_id].html) for r in rows if "<article>" in pages[r.page_id].html]
    assert same and sum(same) == len(same)


def test_neighbours_name_real_distances(spark):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    rows = run(spark, "op12_approximate_neighbours").orderBy("query_id", F.col("rank")).collect()
    assert {r.query_id for r in rows} == {v for v in vectors if v % 100 == 0 and any(vectors[v] or [])}
    for r in rows:
        assert r.query_id != r.vec_id
        assert r.score == pytest.approx(sum((float(a) - float(b)) ** 2 for a, b in zip(vectors[r.query_id], vectors[r.vec_id], strict=True)) ** 0.5)
