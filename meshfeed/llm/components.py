"""Connected components of a large graph of links, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshfeed.session import stage

#: Links that a round writes to a file, or fewer.
FILE_ROWS = 1 << 18


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").bitwiseAND((1 << 40) - 1)).alias("h")
    ).first()
    return row.n, row.h or 0


def _files(edges: DataFrame, links: int) -> int:
    """Files to write about so many links in; enough for all cores."""
    return max(edges.sparkSession.sparkContext.defaultParallelism, -(-links // FILE_ROWS))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest node it knows."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("u", "m"))


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node that ``links`` (two long columns) names: the smallest node
    that can be reached.

    Large-star and small-star rounds (Kiveris et al., 2014) until nothing changes, about as many as
    the logarithm of the longest chain. Each round is a written table in the shared folder, so a
    lost executor costs a task. Neither star has more rows than links and nodes, so links are made
    distinct once a round. A node with very many links is summed on the map side, and its
    links are joined with one row, which adaptive execution splits. A round writes files of some
    ``FILE_ROWS`` links, so few links are not a file for each shuffle partition. No links give no rows; links
    from a node to itself and repeated links change nothing; links with a null are left out.
    """
    a, b = links.columns
    edges = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    edges = stage(edges.where("a is not null and b is not null"), "links")
    alone = edges.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("root"))
    edges = edges.where("a <> b")
    last, now = None, _state(edges)
    while now[0] and now != last:
        edges = stage(_small_star(_large_star(edges)).distinct().coalesce(_files(edges, now[0])), "links")
        last, now = now, _state(edges)
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root"))
    return found.union(roots).union(alone).groupBy("node").agg(F.min("root").alias("root"))
