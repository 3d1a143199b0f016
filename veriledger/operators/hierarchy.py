"""Whole hierarchies: the true root and level of every row, loops and chains that lead nowhere.

Every row points to its parent. In each round a row takes over the pointer of the row it points to, and the distance
with it, so pointers double their length: a chain of a thousand levels ends after ten rounds, whatever the number
of chains. Rows whose pointer has reached an end are done and written aside; only the others go on. A chain that ends
has rows at every distance from its end, and each round finishes those up to twice the distance of the round before: when a
round finishes none, what is still open runs in a circle. So rounds follow the longest chain, not the number of rows in circles.

A round is one join of the open rows with the rows they point to. Many rows may point to one, a root above all;
the join is such that adaptive execution splits them among tasks. Rows are stored after each round in the shared folder, so lineage
stays short and a lost executor costs no more than a round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriledger.functions import blank
from veriledger.operators.skew import join_parent
from veriledger.sources.shared import shared_folder

ENDS, LOOPS, MISSING = "ends", "loops", "missing"
COLUMNS = ["node", "root", "depth", "state"]


def _stored(df: DataFrame) -> DataFrame:
    folder = shared_folder(df.sparkSession, "hierarchy")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def links(df: DataFrame, key: str, parent: str) -> DataFrame:
    """``node`` and its parent ``up``: one row per key that is not blank. Of rows that repeat a key the smallest parent
    counts; a blank parent is none."""
    up = F.when(blank(F.col(parent), df.schema[parent].dataType), None).otherwise(F.col(parent))
    return (df.filter(~blank(F.col(key), df.schema[key].dataType))
            .groupBy(F.col(key).alias("node")).agg(F.min(up).alias("up")))


def resolved(df: DataFrame, key: str, parent: str) -> DataFrame:
    """Per key its ``node``, ``root``, ``depth`` and ``state``.

    ``ends``: the chain of parents ends at ``root``, ``depth`` steps up; 0 for a root itself. ``missing``: it ends at
    a parent that is no row; ``root`` is that parent. ``loops``: it comes back to a row; root and depth are NULL.
    Building it runs jobs, as the number of rounds depends on the rows. An empty table gives no rows.
    """
    start = _stored(links(df, key, parent))
    known = start.select(F.col("node").alias("up"), F.lit(True).alias("known"))
    nodes = _stored(join_parent(start, known, [("up", "up")], "left").select(
        "node", "up", F.lit(1).alias("steps"),
        F.when(F.col("up").isNull(), F.lit(ENDS)).when(F.col("known").isNull(), F.lit(MISSING)).alias("state")))
    done = [nodes.filter("state is not null").select(
        "node", F.coalesce("up", "node").alias("root"), F.when(F.col("up").isNull(), 0).otherwise(1).alias("depth"), "state")]
    open_ = nodes.filter("state is null").drop("state")
    left, before = open_.count(), None
    while left and left != before:
        ends = reduce(DataFrame.union, done).select(
            F.col("node").alias("at"), F.col("root").alias("next"), F.col("depth").alias("more"), F.col("state"))
        steps = open_.select(F.col("node").alias("at"), F.col("up").alias("next"), F.col("steps").alias("more"),
                             F.lit(None).cast("string").alias("state"))
        moved = _stored(join_parent(open_, ends.union(steps), [("up", "at")], "inner").select(
            "node", F.col("next").alias("up"), (F.col("steps") + F.col("more")).alias("steps"), "state"))
        done.append(moved.filter("state is not null").select(
            "node", F.col("up").alias("root"), F.col("steps").alias("depth"), "state"))
        open_ = moved.filter("state is null").drop("state")
        left, before = open_.count(), left
    kind = dict(start.dtypes)["node"]
    return reduce(DataFrame.union, done).union(open_.select(
        "node", F.lit(None).cast(kind), F.lit(None).cast("int"), F.lit(LOOPS)))
