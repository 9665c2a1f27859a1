"""Nearest neighbours against all distances."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from meshfeed.llm import neighbours, queries

FLOATS = "vec_id bigint, embedding array<float>"


def brute(rows, k, divisor):
    good = {
        (i, tuple(v))
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    out = {}
    for i, q in good:
        if i % divisor == 0:
            far = sorted((math.dist(q, v), j) for j, v in good if j != i and len(v) == len(q))
            out[i, q] = far[:k]
    return out


def found(spark, rows, k, divisor, **options):
    vectors = neighbours.usable(spark.createDataFrame(rows, FLOATS))
    return neighbours.nearest(vectors, F.col("id") % divisor == 0, k, **options).collect()


def as_lists(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, round(r.score, 9)))
    return out


@pytest.mark.parametrize("block", [8192, 16])
def test_all_leaves_give_the_exact_result(spark, monkeypatch, block):
    """With as many probes as leaves the search is exact, whatever the trees; one vector is very common."""
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", block)
    rng = np.random.default_rng(3)
    rows = [(n, np.float32(rng.normal(size=6)).tolist()) for n in range(150)]
    rows += [(1000 + n, rows[0][1]) for n in range(80)] + [(2000 + n, rows[5][1]) for n in range(3)]
    got = as_lists(found(spark, rows, 7, 10, trees=3, probes=10**6, leaf_rows=8))
    want = {i: [(n, j, round(d, 9)) for n, (d, j) in enumerate(best, 1)] for (i, _), best in brute(rows, 7, 10).items()}
    assert got == want


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]),
        (None, [1.0, 1.0]), (7, [1.0]), (8, [1.0, 2.0]), (8, [1.0, 2.0]), (9, []), (10, [0.0, -0.0]), (20, [-0.0, 3.0]),
        (30, [0.0, 3.0]), (0, [1.0, 0.0]), (40, [5.0]), (50, [1.0, 1.0, 1.0]),
    ]
    got = as_lists(found(spark, rows, 3, 10))
    want = {i: [(n, j, round(d, 9)) for n, (d, j) in enumerate(best, 1)] for (i, _), best in brute(rows, 3, 10).items() if best}
    assert got == want
    assert found(spark, rows[3:4], 3, 10) == []
    assert found(spark, [], 3, 10) == []


def test_an_id_with_two_vectors_asks_twice(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 0.1]), (2, [0.1, 1.0])]
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in found(spark, rows, 1, 10))
    assert got == [(0, 1, 1), (0, 1, 2)]


def test_the_queue_is_shared_by_all_trees():
    rng = np.random.default_rng(0)
    points = rng.normal(size=(400, 5))
    forest = neighbours.grow(points, trees=4, leaf_rows=20)
    leaves = forest.leaves_of(points)
    others = rng.normal(size=(300, 5))
    first = np.array(forest.probes(others, 4))
    # no plane separates a point from its own leaf, so each tree's own leaf comes before any other
    assert (np.sort(first, axis=1) == np.sort(forest.leaves_of(others), axis=1)).all()
    assert all(len(set(p)) == len(p) for p in forest.probes(others, 30))
    sizes = np.bincount(leaves.ravel())
    assert sizes.max() <= 20 and len(forest.probes(points[:1], 10**6)[0]) == len(sizes)


def test_equal_points_end_in_one_leaf():
    forest = neighbours.grow(np.ones((100, 3)), trees=2, leaf_rows=8)
    assert forest.leaves_of(np.ones((5, 3))).tolist() == [[0, 1]] * 5


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
def test_recall_of_the_registered_query(spark, scale):
    table = spark.read.parquet(f"/root/testdata/{scale}/embeddings.parquet").collect()
    want = brute([(r.vec_id, r.embedding) for r in table], 10, 100)
    rows = queries.queries()["op12_approximate_neighbours"](spark, f"/root/testdata/{scale}")
    assert rows.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    got = as_lists(rows.collect())
    vectors = {r.vec_id: r.embedding for r in table}
    hits = total = 0
    for (i, q), best in want.items():
        assert [r[0] for r in got[i]] == list(range(1, len(best) + 1))
        for _, j, score in got[i]:
            assert abs(score - math.dist(q, vectors[j])) < 1e-6
        hits += len({j for _, j in best} & {j for _, j, _ in got[i]})
        total += len(best)
    assert hits >= 0.9 * total


def test_recall_on_clusters_beyond_the_sample(spark):
    """More rows than the trees were grown on, and a third of them in one tight group."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 16))
    rows = [(n, (centres[0 if n % 3 == 0 else n % 40] + 0.3 * rng.normal(size=16)).tolist()) for n in range(6000)]
    schema = "vec_id bigint, embedding array<double>"
    vectors = neighbours.usable(spark.createDataFrame(rows, schema))
    found_ = neighbours.nearest(vectors, F.col("id") % 100 == 0, 10, trees=8, probes=48, sample_rows=2000, leaf_rows=32).collect()
    points = np.array([v for _, v in rows])
    hits = 0
    for i in range(0, 6000, 100):
        far = ((points - points[i]) ** 2).sum(axis=1)
        far[i] = np.inf
        hits += len(set(np.argsort(far)[:10].tolist()) & {r.vec_id for r in found_ if r.query_id == i})
    assert hits >= 0.9 * 600
