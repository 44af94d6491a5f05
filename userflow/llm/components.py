"""Connected components of an edge table, by alternating large-star and
small-star steps.

Every step is a pre-aggregated minimum per node and an equality join, written
to the shared folder, so no node's neighbours meet in one task or one group,
an executor can be lost at any time, and AQE can split the partition of a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from userflow.session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (a, b): larger node a, smaller node b.

    Large star links every larger neighbour of a node to the smallest node
    around it; small star does so for the smaller neighbours and the node."""
    if large:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = materialize(around.groupBy("u").agg(F.min("v").alias("m"))
                        .select("u", F.least("u", "m").alias("m")))
    joined = around.join(least, "u")
    if large:
        linked = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        linked = joined.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.where("u <> m").select(F.col("u").alias("a"), F.col("m").alias("b")))
    return linked.distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): for every node of an edge the smallest node it reaches.

    Loops and repeated edges are allowed, edges with a null end are ignored,
    an empty edge table gives an empty result.  Node ids are longs.
    """
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    now = materialize(edges.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b"), x.alias("p"), y.alias("q"))
                      .where("p <> q").select("a", "b").distinct())
    mark = None
    while True:
        seen = now.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("h"),
                       F.expr("sum(cast(b as decimal(38, 0)))").alias("s")).head()
        if mark == tuple(seen):  # a star forest stays as it is
            break
        mark = tuple(seen)
        if not seen["n"]:
            break
        now = materialize(_star(_star(now, True), False))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
