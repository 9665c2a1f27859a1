"""Approximate nearest neighbours: a forest of random-projection trees and exact reranking."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meshfeed.session import stage

#: Vectors that the trees are grown on, at most, and those of a leaf, at most.
SAMPLE_ROWS, LEAF_ROWS = 32768, 128
#: Trees, and leaves of all trees together that a query looks into.
TREES, PROBES = 6, 184
#: Rows of a leaf that a task holds at once.
BLOCK_ROWS = 8192
#: Numbers that are in memory at once while distances are computed.
_NUMBERS = 1 << 21


@dataclass(frozen=True)
class Forest:
    """Trees over vectors of one length. A child or root n >= 0 is a node, otherwise leaf ~n; leaves
    are numbered over all trees."""

    normals: np.ndarray
    offsets: np.ndarray
    children: np.ndarray
    roots: np.ndarray

    def leaves_of(self, points: np.ndarray) -> np.ndarray:
        """The leaf of every point in every tree."""
        out = np.empty((len(points), len(self.roots)), np.int64)
        for tree, root in enumerate(self.roots):
            node = np.full(len(points), root)
            open_ = np.flatnonzero(node >= 0)
            while len(open_):
                at = node[open_]
                side = np.einsum("ij,ij->i", points[open_], self.normals[at]) >= self.offsets[at]
                node[open_] = self.children[at, side.astype(np.int64)]
                open_ = open_[node[open_] >= 0]
            out[:, tree] = ~node
        return out

    def probes(self, points: np.ndarray, most: int) -> list[list[int]]:
        """The ``most`` leaves that each point looks into.

        All trees share one priority queue. A node's priority is the least distance to the planes on
        its way, negative where the point lies on the other side; the best node is opened next,
        whichever tree it belongs to.
        """
        found = []
        step = max(1, _NUMBERS // max(1, len(self.normals)))
        roots = self.roots.tolist()
        children = self.children.tolist()
        for k in range(0, len(points), step):
            margins = points[k : k + step] @ self.normals.T - self.offsets
            for margin in margins.tolist():
                queue = [(-np.inf, root) for root in roots]
                heapq.heapify(queue)
                leaves: list[int] = []
                while queue and len(leaves) < most:
                    cost, node = heapq.heappop(queue)
                    if node < 0:
                        leaves.append(~node)
                        continue
                    m, (below, above) = margin[node], children[node]
                    heapq.heappush(queue, (max(cost, m), below))
                    heapq.heappush(queue, (max(cost, -m), above))
                found.append(leaves)
        return found


def grow(sample: np.ndarray, trees: int = TREES, leaf_rows: int = LEAF_ROWS, seed: int = 7) -> Forest:
    """Every node projects its points onto the line through two of them, drawn at random, and halves
    them at the median, until a leaf is small enough or all its points project alike."""
    rng = np.random.default_rng(seed)
    normals, offsets, children, roots = [], [], [], []
    leaves = 0
    for _ in range(trees):
        roots.append(0)
        todo = [(np.arange(len(sample)), roots, len(roots) - 1)]
        while todo:
            rows, parent, slot = todo.pop()
            plane = _plane(sample[rows], rng) if len(rows) > leaf_rows else None
            if plane is None:
                parent[slot] = ~leaves
                leaves += 1
                continue
            normal, offset, above = plane
            parent[slot] = len(normals)
            normals.append(normal)
            offsets.append(offset)
            children.append([0, 0])
            todo += [(rows[~above], children[-1], 0), (rows[above], children[-1], 1)]
    width = sample.shape[1]
    return Forest(
        np.array(normals, np.float64).reshape(-1, width),
        np.array(offsets, np.float64),
        np.array(children, np.int64).reshape(-1, 2),
        np.array(roots, np.int64),
    )


def _plane(points: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, float, np.ndarray] | None:
    for _ in range(4):
        a, b = points[rng.integers(len(points), size=2)]
        scale = np.abs(a - b).max()
        if scale == 0 or not np.isfinite(scale):
            continue
        normal = (a - b) / scale
        normal /= np.sqrt(normal @ normal)
        along = np.einsum("ij,j->i", points, normal)
        offset = float(np.median(along))
        above = along >= offset
        if above.any() and not above.all():
            return normal, offset, above
    return None


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``id`` and ``v`` (floats stay floats, other numbers are doubles), repeated rows once. Rows with a null id or vector, vectors that are
    empty or all zero, and those with a null, infinite or not-a-number component are left out."""
    name = f"`{vector.replace('`', '``')}`"
    finite = F.forall(name, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    some = F.exists(name, lambda x: x != 0)
    key = F.col(f"`{vec_id.replace('`', '``')}`")
    fit_ = vectors.where(key.isNotNull() & F.col(name).isNotNull() & finite).where(some)
    kind = vectors.select(name).schema[0].dataType.elementType.simpleString()
    kind = kind if kind == "float" else "double"
    # -0.0 and 0.0 are the same number but not the same bits
    same = F.transform(name, lambda x: x.cast(kind) + F.lit(0.0).cast(kind))
    return fit_.select(key.cast("long").alias("id"), same.alias("v")).distinct()


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def fit_forests(
    vectors: DataFrame, trees: int = TREES, sample_rows: int = SAMPLE_ROWS, leaf_rows: int = LEAF_ROWS, seed: int = 7
) -> dict[int, Forest]:
    """A forest for each length among a sample of ``vectors`` (those of :func:`usable`).

    The sample is at most ``sample_rows`` different vectors: those with the least hashes. Copies share
    a hash and count once, so a vector with a third of the rows is one. So a model has at most about
    2 * ``sample_rows`` / ``leaf_rows`` planes a tree, whatever the size of the table.
    """
    hashed = vectors.select("v", F.xxhash64("v", F.lit(seed)).bitwiseAND((1 << 40) - 1).alias("h"))
    n = hashed.agg(F.approx_count_distinct("h")).first()[0]
    drawn = hashed.where(F.col("h") < int((1 << 40) * min(1.0, 1.5 * sample_rows / max(1, n)))).distinct()
    sample = drawn.orderBy("h", F.size("v"), "v").limit(sample_rows).select("v").toArrow()
    columns = sample.column("v").combine_chunks()
    lengths = columns.value_lengths().to_numpy(zero_copy_only=False)
    return {
        int(width): grow(_matrix(columns.filter(pa.array(lengths == width)), int(width)), trees, leaf_rows, seed)
        for width in np.unique(lengths)
    }


def _by_width(rows: pa.RecordBatch, vector: str) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    column = rows.column(rows.schema.get_field_index(vector))
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    for width in np.unique(lengths):
        part = rows.filter(pa.array(lengths == width))
        yield int(width), part, _matrix(part.column(part.schema.get_field_index(vector)), int(width))


def _nearest(
    q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, points: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query place, candidate place and distance of each query's ``k`` nearest rows of another id, ties
    to the earlier row."""
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    step = max(1, _NUMBERS // max(1, points.size))
    for n in range(0, len(q), step):
        far = np.sqrt(((q[n : n + step, None, :] - points[None, :, :]) ** 2).sum(axis=2))
        far[q_ids[n : n + step, None] == ids[None, :]] = np.inf
        best = np.argsort(far, axis=1, kind="stable")[:, :k]
        distance = np.take_along_axis(far, best, axis=1)
        place, slot = np.nonzero(np.isfinite(distance))
        out.append((place + n, best[place, slot], distance[place, slot]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _compare(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a group stand together, those of the index first, ordered by id; they are kept while
        the queries pass."""
        key, held, index = None, [], None
        for batch in batches:
            group = np.stack([batch.column(n).to_numpy() for n in range(3)], axis=1)
            asking = batch.column(3).to_numpy(zero_copy_only=False)
            change = (np.diff(group, axis=0) != 0).any(axis=1) | (np.diff(asking.astype(np.int8)) != 0)
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                now, rows = tuple(group[a].tolist()), batch.slice(a, b - a)
                if now != key:
                    key, held, index = now, [], None
                ids, keys = rows.column(4).to_numpy(), rows.column(5).to_numpy()
                points = _matrix(rows.column(6), now[0])
                if not asking[a]:
                    held.append((ids, keys, points))
                    index = None
                    continue
                if not held:
                    continue
                if index is None:
                    index = tuple(np.concatenate(x) for x in zip(*held, strict=True))
                i, j, distance = _nearest(ids, points, index[0], index[2], k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (ids[i], keys[i], index[0][j], index[1][j], distance)],
                    ["query_id", "query_key", "vec_id", "row", "score"],
                )

    return run


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    trees: int = TREES,
    probes: int = PROBES,
    sample_rows: int = SAMPLE_ROWS,
    leaf_rows: int = LEAF_ROWS,
    seed: int = 7,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score``, the Euclidean distance in doubles: the
    ``k`` nearest rows found for each query.

    ``vectors`` are those of :func:`usable`; ``is_query`` picks queries among them. Every row is a
    candidate for all queries but those of its own id; only vectors of equal length are compared;
    rows of one id with different vectors are different candidates. Ties go to the smaller id. With
    fewer candidates than ``k`` in the leaves looked into, there are fewer rows. An empty table gives
    no rows.

    The forest is grown on a bounded sample and broadcast; every row is put into its leaf of each
    tree. A query pops leaves from one priority queue over all trees until it has ``probes`` of them;
    all rows of those leaves are compared exactly. A leaf holds a share of the table, so a query sees
    the same share of it at every size. Of equal vectors the k + 1 least ids are indexed: no other
    copy can be among the k nearest of any query. Leaves are dealt to tasks in blocks of about
    ``BLOCK_ROWS`` rows; queries pass by the held block, so neither side of a hot leaf is held whole.
    """
    order = Window.partitionBy("v").orderBy("id")
    few = vectors.withColumn("copy", F.row_number().over(order)).where(F.col("copy") <= k + 1).drop("copy")
    forests = fit_forests(vectors, trees, sample_rows, leaf_rows, seed)
    model = vectors.sparkSession.sparkContext.broadcast(forests)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, rows, points in _by_width(batch, "v"):
                forest = model.value.get(width)
                found = forest.leaves_of(points) if forest else np.zeros((rows.num_rows, 1), np.int64)
                yield _with_leaves(rows, found.tolist())

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, rows, points in _by_width(batch, "v"):
                forest = model.value.get(width)
                yield _with_leaves(rows, forest.probes(points, probes) if forest else [[0]] * rows.num_rows)

    shape = f"id bigint, v {vectors.schema['v'].dataType.simpleString()}, leaves array<bigint>"
    placed = stage(few.select("id", "v").mapInArrow(place, shape), "placed")
    width = F.size("v").cast("long").alias("width")
    inside = placed.select("id", "v", width, F.explode("leaves").alias("leaf"))
    sizes = inside.groupBy("width", "leaf").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("blocks"))
    sizes = stage(sizes, "leaves")
    asked = vectors.where(is_query).select("id", "v").mapInArrow(look, shape)
    asked = asked.select("id", "v", width, F.explode("leaves").alias("leaf")).join(sizes, ["width", "leaf"])
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    spread = F.pmod(F.xxhash64("id", "v"), F.col("blocks")).alias("block")
    home = inside.join(sizes, ["width", "leaf"]).select("width", "leaf", spread, "id", "v")

    def marked(rows: DataFrame, asking: bool) -> DataFrame:
        row = F.xxhash64("id", "v", F.lit(1)).alias("row")
        return rows.select("width", "leaf", "block", F.lit(asking).alias("asking"), "id", row, "v")

    dealt = marked(home, False).union(marked(asked, True)).repartition("width", "leaf", "block")
    dealt = dealt.sortWithinPartitions("width", "leaf", "block", "asking", "id")
    found = dealt.mapInArrow(
        _compare(k), "query_id bigint, query_key bigint, vec_id bigint, row bigint, score double"
    ).distinct()
    best = Window.partitionBy("query_id", "query_key").orderBy("score", "vec_id")
    best_rows = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return best_rows.select("query_id", "rank", "vec_id", "score")


def _with_leaves(rows: pa.RecordBatch, leaves: list[list[int]]) -> pa.RecordBatch:
    lists = pa.array(leaves, pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), lists], ["id", "v", "leaves"])
