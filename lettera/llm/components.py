"""Connected components by alternating large-star and small-star rounds."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: A node with more than this share (1 / HUBS) of a round's rows is a hub; there are fewer than HUBS of them.
HUBS = 1024


def _around(rows: DataFrame, n_rows: int) -> DataFrame:
    """`rows` (u, v) with m, the smallest v of u.

    The rows of a hub stay where they are: the list of hubs is shorter than `HUBS`, so it is broadcast. All other nodes
    are joined by a shuffle, in which none brings more than a share of 1 / `HUBS`.
    """
    least = rows.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    hubs = F.broadcast(least.filter(F.col("n") * HUBS > n_rows).select("u", "m"))
    others = least.filter(F.col("n") * HUBS <= n_rows).select("u", "m")
    return rows.join(hubs, "u").union(rows.join(hubs, "u", "left_anti").join(others, "u"))


def _large(edges: DataFrame, n_edges: int) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around; as many rows as edges."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    return (_around(both, 2 * n_edges).filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("a"), F.least("u", "m").alias("b")))


def _small(edges: DataFrame, n_edges: int) -> DataFrame:
    """The smaller neighbours of a node, and the node, are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    links = _around(down, n_edges)
    return (links.filter(F.col("v") != F.col("m")).select(F.col("v").alias("a"), F.col("m").alias("b"))
            .union(links.select("u", "m")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of its component, for each node of `edges` (a, b).

    Only sums come to the driver; every round is stored, so a lost executor costs that round at most.
    Loops (a = b) and repeated edges do no harm; an empty table gives an empty one.
    """
    state = lambda d: tuple(d.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
    d = stored(edges.toDF("a", "b").filter(F.col("a") != F.col("b")).distinct(), "edges")
    now, seen = state(d), None
    while now != seen:
        n, seen = now[0], now
        d = stored(_small(stored(_large(d, n), "edges"), n), "edges")
        now = state(d)
    nodes = d.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(d.select("b", "b").distinct())
