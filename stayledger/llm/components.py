"""Connected components of an edge table, by the large-star / small-star iteration of Kiveris and others (2014).

Each round hangs every node's neighbours on the smallest one it knows, first those larger than the node, then the
others; the forest becomes stars after about log(n) rounds. The smallest neighbour is found by an aggregation, which
combines inside map tasks, and is joined back on a renamed key, so that adaptive execution can split the edges of a hub.
Each half of a round is a query of its own over files: planned as one, every table would appear in it up to sixteen times,
and the driver would plan, compile and keep all of them in every round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .storage import written


def _with_least(edges: DataFrame) -> DataFrame:
    """Directed edges (u, v) with ``least``, the smallest of u and its neighbours."""
    least = edges.groupBy("u").agg(F.least("u", F.min("v")).alias("least"))
    return edges.withColumn("at", F.struct("u")).join(least.select(F.struct("u").alias("at"), "least"), "at").drop("at")


def _both(u: str, v: str, w: str, x: str) -> Column:
    """Two edges (u, v) and (w, x) from each row."""
    return F.inline(F.array(F.struct(F.col(u).alias("u"), F.col(v).alias("v")), F.struct(F.col(w).alias("u"), F.col(x).alias("v"))))


def components(edges: DataFrame) -> DataFrame:
    """For every node of the undirected ``edges`` (u, v): node and component, the smallest node it can reach.

    Loops and repeated edges do no harm; an edge with a null end is ignored. A node without edges to others does not
    appear. An empty table gives no rows.
    """
    current = written(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = current.select(_both("u", "v", "v", "u"))
        large = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        down = _with_least(written(large, "edges"))
        small = down.select(_both("v", "least", "u", "least"))
        following = written(small.filter("u <> v").distinct(), "edges")
        state = following.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        current, before = following, state
    nodes = following.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionAll(following.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
