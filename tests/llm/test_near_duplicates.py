import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from meshfeed.llm import components as components_module
from meshfeed.llm import simhash
from meshfeed.llm.components import components

ASCII_LOWER = {k: k + 32 for k in range(65, 91)}


def fingerprint(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
    shingles = [" ".join(words[k : k + n]) for k in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows):
    prints = [(i, fingerprint(t)) for i, t in rows]
    distinct = sorted({f for _, f in prints})
    near = [(a, b) for k, a in enumerate(distinct) for b in distinct[:k] if (a ^ b).bit_count() <= 2]
    root = roots(distinct, near)
    least = {}
    for i, f in prints:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    return sorted((str(i), f, str(least.get(root[f]))) for i, f in prints)


def found(df):
    return sorted((str(r.doc_id), r.simhash % 2**64, str(r.component_id)) for r in df.collect())


ROWS = [
    (7, "One two three four five."), (3, "one TWO three four five."), (3, "one TWO three four five."), (9, None), (4, ""),
    (5, " \t\n"), (6, "only two"), (2, "Ünïcode wörds ÄÖ and\x0bmore\x0cspaces\rhere"), (None, "only two"),
    (None, "a text that nobody else has at all"), (11, "x " * 30_000 + "end"), (12, "x " * 30_000 + "end"),
]


def test_edge_cases_match_brute_force(spark):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string")
    assert found(simhash.near_duplicates(docs)) == brute(ROWS)


def test_small_tiles_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE_ROWS", 2)
    monkeypatch.setattr(simhash, "MET_ROWS", 3)
    rng = random.Random(1)
    values = [rng.getrandbits(64) for _ in range(40)]
    for _ in range(260):  # chains of near values, many in one tile
        values.append(values[rng.randrange(len(values))] ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    signed = [int(np.uint64(v).view(np.int64)) for v in values]
    prints = spark.createDataFrame([(k, v) for k, v in enumerate(signed)], "doc_id bigint, f bigint")
    got = {r.f: r.component_id for r in simhash.classes(prints, "doc_id", "f").collect()}
    distinct = sorted(set(values))
    near = [(a, b) for k, a in enumerate(distinct) for b in distinct[:k] if (a ^ b).bit_count() <= 2]
    root = roots(distinct, near)
    least = {}
    for k, v in enumerate(values):
        least[root[v]] = min(k, least.get(root[v], k))
    assert got == {int(np.uint64(v).view(np.int64)): least[root[v]] for v in distinct}


def test_table_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(simhash.near_duplicates(docs)) == brute(rows)


def test_one_of_each_group_stays(spark):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string")
    docs = docs.withColumn("simhash", F.lit("mine")).withColumn("component_id", F.lit(1))
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert {r.simhash for r in rows} == {"mine"}
    classes = {c for _, _, c in brute(ROWS)} - {"None"}
    assert sorted(str(r.doc_id) for r in rows) == sorted([*classes, "None"])
    assert [r.text for r in rows if r.doc_id is None] == ["a text that nobody else has at all"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.drop_near_duplicates(docs).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_union_find(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    links += [(100 + k, 101 + k) for k in range(30)] + [(200, 200 + k) for k in range(40)] + [(300, 300)]
    frame = spark.createDataFrame([*links, *links[:5], (None, 1)], "a bigint, b bigint")
    nodes = {n for link in links for n in link}
    assert {r.node: r.root for r in components(frame).collect()} == roots(nodes, links)
    assert components(frame.limit(0)).count() == 0


def test_an_id_in_several_classes_is_kept_in_each(spark):
    """Repeated and null ids over several classes: every class keeps one row, and no class is lost."""
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdefghijklmnop") * rng.randrange(1, 4) for _ in range(30)) for _ in range(12)]
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[2]), (1, texts[1]), (None, texts[3]), (None, texts[4]), (7, texts[4])]
    rows += [(rng.choice([None, 1, 2, 3, 4, 5]), rng.choice(texts)) for _ in range(80)] + [(9, None), (None, ""), (8, "  ")]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id bigint, text string, simhash_of_row int")
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    values = {r.text: r.simhash for r in simhash.add_fingerprint(docs.select("text")).distinct().collect()}
    distinct = sorted({int(np.int64(v).view(np.uint64)) for v in values.values()})
    near = [(a, b) for k, a in enumerate(distinct) for b in distinct[:k] if (a ^ b).bit_count() <= 2]
    root = roots(distinct, near)
    of = {t: root[int(np.int64(v).view(np.uint64))] for t, v in values.items()}
    least = {}
    for i, t in rows:
        key = (i is None, i or 0)
        least[of[t]] = min(least.get(of[t], key), key)
    assert sorted(of[t] for _, t in got) == sorted(least)
    assert all((i is None, i or 0) == least[of[t]] for i, t in got)


def test_fingerprints_are_computed_once_when_rows_are_dropped(spark):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string")
    plan = simhash.drop_near_duplicates(docs)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan


def test_comparisons_link_to_the_least_member():
    home, met = np.array([7, 3, 1 << 40]), np.array([1, -1])
    a, b = simhash._linked(home, met, 1, inner=True)
    assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == [(3, 1), (7, 1)]


def test_links_are_made_distinct_once_a_round(spark, monkeypatch):
    write, distinct = components_module.stage, []

    def stage(df, purpose):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        distinct.append(len(re.findall(r"Aggregate \[a#\d+L, b#\d+L\], \[a#\d+L, b#\d+L\]", plan)))
        return write(df, purpose)

    monkeypatch.setattr(components_module, "stage", stage)
    links = spark.createDataFrame([(k, k + 1) for k in range(9)] * 2 + [(20, 20), (31, 30)], "a long, b long")
    assert dict(components(links).collect()) == {**dict.fromkeys(range(10), 0), 20: 20, 30: 30, 31: 30}
    assert distinct[0] == 0 and set(distinct[1:]) == {1}


def test_few_links_are_written_to_few_files(spark, monkeypatch):
    write, files = components_module.stage, []

    def stage(df, purpose):
        table = write(df, purpose)
        files.append(len(table.inputFiles()))
        return table

    monkeypatch.setattr(components_module, "stage", stage)
    changed = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        links = spark.createDataFrame([(k, k + 1) for k in range(0, 900) if k % 3 < 2], "a long, b long")
        found = dict(components(links).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == {k: k - k % 3 for k in range(900)}
    assert len(files) > 2 and max(files[1:]) <= spark.sparkContext.defaultParallelism
