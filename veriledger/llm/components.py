"""Connected components by alternating stars.

Each round first ties every larger neighbour of a node, then every smaller one, to the smallest node
it sees. Rounds grow with the logarithm of the longest chain; every round is two grouped minima and two
joins over edges. In the last rounds most edges of a component hang on one node: minima are taken before rows are
shuffled, and the joins are such that adaptive execution splits that node's edges among tasks. So no component is
ever gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriledger.llm.frames import stored
from veriledger.operators.skew import join_parent


def _mark(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), total).first())


def components(links: DataFrame) -> DataFrame:
    """`node` and `label`, the smallest node of its component, for every node with a link to another.

    `links` has columns `a` and `b`; repeated links and links of a node to itself change nothing, and
    without links there are no rows.
    """
    edges = stored(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges")
    mark = _mark(edges)
    while mark[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (join_parent(both, least, [("u", "u")], "inner").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (join_parent(large, least, [("u", "u")], "inner").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        edges = stored(small, "edges")
        before, mark = mark, _mark(edges)
        if before == mark:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
