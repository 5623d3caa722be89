"""Connected components of an edge table, without any driver-side graph.

Alternating large-star and small-star steps; each is a minimum per node and an
equi-join, whose hot keys Spark can split.  Every round is written to the
shared folder, so a lost executor costs one round at most; the rounds before
the last are removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import materialize, remove, shared_dir, stored


def _relink(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """Per node u with least neighbour m: link its neighbours (only those above u, or all) to m."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    joined = pairs.join(least, pairs["u"] == least["w"])
    return joined.filter("v > u" if larger_only else "v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``; root is the component's least node.

    A round only ever moves links to smaller nodes, so the rounds end; they are
    known to be at most of the order of the squared logarithm of the nodes.
    """
    spark, mark = edges.sparkSession, None
    folder = shared_dir(spark)
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{folder}/edges")
    while True:
        before, folder = folder, shared_dir(spark)
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(_relink(both, True).filter("u <> v").distinct(), f"{folder}/large")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        small = _relink(down, False)
        kept = down.groupBy("u").agg(F.min("v").alias("v"))
        now = stored(small.union(kept).filter("u > v").distinct(), f"{folder}/small")
        remove(before)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    found = materialize(nodes.union(nodes.select(F.col("root").alias("node"), "root").distinct()), "roots")
    remove(folder)
    return found
