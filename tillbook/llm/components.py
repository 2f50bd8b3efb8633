"""Connected components of a link table, without gathering links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(u, v)``; the root is the least node.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): each hangs the
    neighbours of a node on its least neighbour, until only stars remain.  A hub is one hot
    join key, which adaptive execution splits; minima combine inside each task.
    """
    edges = stored(
        links.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "links",
    )
    mark = _mark(edges)
    while mark[0]:
        edges = stored(_small_star(_large_star(edges)), "links")
        last, mark = mark, _mark(edges)
        if mark == last:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select("v", "v").distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    hung = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(least, "u").where("v <> m").select("v", "m")
    return hung.union(least).toDF("u", "v").distinct()


def _mark(edges: DataFrame) -> tuple[int, int | None]:
    """Row count and an order-free digest: equal when a round changed nothing."""
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]
