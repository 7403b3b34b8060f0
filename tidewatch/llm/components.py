"""Connected components of an edge table by alternating star contraction.

After Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Every round is
two groupings (combined on the map side) and two equi-joins whose large side Spark may split,
so a node with a third of all edges is no bottleneck. Nothing is collected but whether a
round moved any edge; the first that moves none is the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint


#: Ways the edges of one node are dealt, so that the join of a hub is no single task's.
SALTS = 16


def _with_low(edges: DataFrame, low: DataFrame) -> DataFrame:
    """Edges with ``m``, the smallest node around ``a``."""
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")
    return salted.join(low.select("a", "m", every), ["a", "salt"]).drop("salt")


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _with_low(both.filter("b > a"), low).select(F.col("b").alias("a"), F.col("m").alias("b"), F.expr("m <> a").alias("moved"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them; edges have a > b."""
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    pair = lambda name: F.struct(F.col(name).alias("a"), F.col("m").alias("b"))
    hung = _with_low(edges, low).select(F.explode(F.array(pair("a"), pair("b"))).alias("e"), F.expr("moved or b <> m").alias("moved"))
    return hung.filter("e.a <> e.b").groupBy("e.a", "e.b").agg(F.max("moved").alias("moved"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node with an edge to another; component is the smallest node.

    ``edges`` has two columns of one orderable type. Edges with a null end, loops and repeats
    are allowed and ignored. No edges: no rows.
    """
    a, b = edges.columns
    edges = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    edges = checkpoint(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    moving = not edges.isEmpty()
    while moving:
        edges = checkpoint(_small_star(_large_star(edges)))
        moving = not edges.filter("moved").isEmpty()
        edges = edges.drop("moved")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
