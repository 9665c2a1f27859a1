"""The registered queries against their SQL, and the pipeline stage by stage."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from meshfeed.llm import decontaminate, pii, queries, simhash, toxicity
from tests import oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect()


def test_one_query_for_each_operator():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert contract.queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = queries.queries()[name](spark, oracle.SF_DIR)
    described = duck.execute(f"describe {queries.oracle_sql()[name]}").fetchall()
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}
    assert {n: kinds[t] for n, t in df.dtypes} == {row[0]: row[1] for row in described}
    assert oracle.actual(df) == oracle.expected(duck, queries.oracle_sql()[name])


@pytest.mark.parametrize("name", ["op3_personal_data", "op6_extendible_sharding", "op9_license_scan"])
def test_native_queries_run_no_python(spark, name):
    plan = queries.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"):
        assert word not in plan


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = docs
    for name, step in corpus_pipeline.STAGES:
        before, out = kept, step(spark, kept, SF)
        out.write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert kept.columns == columns
        if name == "toxicity":
            model = queries.toxicity_model(spark, before, SF)
            scored = toxicity.score(before, model)
            assert ids(kept) == ids(scored.where("toxicity < 0.3"))
        elif name == "near_duplicates":
            found = simhash.near_duplicates(before)
            assert ids(kept) == sorted(r[0] for r in found.select("component_id").distinct().collect())
        elif name == "decontamination":
            bench = spark.read.parquet(f"{SF}/benchmark.parquet")
            assert ids(kept) == ids(decontaminate.find_contamination(before, bench).where("n_hit = 0"))
        elif name == "personal_data":
            assert ids(kept) == ids(before)
            left = pii.find(kept.select("doc_id", "text"), pii.Model([], {}))
            assert left.where(F.size("base_spans") > 0).count() == 0
            assert kept.where("n_chars <> length(text)").count() == 0
        else:
            assert sorted(set(ids(kept))) == ids(before)
    assert kept.count() == corpus_pipeline.run(spark, SF).count()


def test_pipeline_leaves_only_what_its_result_reads(spark):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = {p.name for p in shared.iterdir()}
    rows = corpus_pipeline.run(spark, SF).count()
    left = {p.name.split("-")[0] for p in shared.iterdir() if p.name not in before}
    assert rows and "pipeline" in left
    assert left.isdisjoint({"toxicity", "fingerprinted", "candidates", "links", "tiles", "simhash"})
    assert sum(p.name.startswith("pipeline-") for p in shared.iterdir() if p.name not in before) == 1
