"""Whole hierarchies against a walk from row to row."""

import random

import pytest
from pyspark.sql import functions as F

from veriledger.operators import hierarchy

SCHEMA = "id string, parent string, state int"


def walk(rows):
    up = {}
    for i, p in rows:
        if i is None or not i.strip():
            continue
        p = None if p is None or not p.strip() else p
        up[i] = min((x for x in (up.get(i), p) if x is not None), default=None)
    found = set()
    for i in up:
        at, steps, seen = i, 0, {i}
        while True:
            if at not in up:
                found.add((i, at, steps, "missing"))
            elif up[at] is None:
                found.add((i, at, steps, "ends"))
            elif up[at] in seen:
                found.add((i, None, None, "loops"))
            else:
                at, steps = up[at], steps + 1
                seen.add(at)
                continue
            break
    return found


def run(spark, rows):
    df = spark.createDataFrame([(i, p, 1) for i, p in rows], SCHEMA)
    found = hierarchy.resolved(df, "id", "parent")
    assert found.columns == hierarchy.COLUMNS
    listed = [tuple(r) for r in found.collect()]
    assert len(listed) == len(set(listed))
    return set(listed)


@pytest.fixture
def rounds(monkeypatch):
    counted = []
    plain = hierarchy._stored
    monkeypatch.setattr(hierarchy, "_stored", lambda df: counted.append(1) or plain(df))
    return counted


@pytest.mark.parametrize("seed", range(3))
def test_against_a_walk(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        kind = rng.random()
        parent = (None if kind < 0.1 else f"n{rng.randrange(400)}" if kind < 0.3 else f"x{i}" if kind < 0.35
                  else " " if kind < 0.4 else f"n{max(0, i - rng.randint(1, 9))}")
        rows.append((f"n{i}", parent))
    assert run(spark, rows) == walk(rows)


def test_odd_rows(spark):
    rows = [("a", "a"), ("b", "c"), ("c", "b"), ("d", "b"), ("e", None), ("e", "f"), ("e", "g"), ("f", ""), ("g", None),
            (None, "a"), (" ", "a"), ("h", "nowhere"), ("i", "h"), ("h", "nowhere")]
    assert run(spark, rows) == walk(rows)
    assert run(spark, []) == set()
    assert run(spark, [("a", None)]) == {("a", "a", 0, "ends")}
    assert run(spark, [("a", "b")]) == {("a", "b", 1, "missing")}


def test_rounds_grow_with_the_logarithm(spark, rounds):
    """A chain of 1000 levels takes ten rounds; so do many of them. Loops take as many as pass all rows."""
    chain = [(f"{k}", f"{k - 1}" if k else None) for k in range(1000)]
    assert run(spark, chain) == walk(chain)
    assert len(rounds) <= 2 + 10
    rounds.clear()
    short = [(f"{c}-{k}", f"{c}-{k - 1}" if k else None) for c in range(300) for k in range(10)]
    assert run(spark, short) == walk(short)
    assert len(rounds) <= 2 + 4
    rounds.clear()
    loop = [(f"{k}", f"{(k + 1) % 500}") for k in range(500)]
    assert {s for *_, s in run(spark, loop)} == {"loops"}
    assert len(rounds) <= 2 + 10


def test_a_root_with_very_many_rows_is_split(spark, monkeypatch):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    tasks, plain = [], hierarchy.join_parent

    def watched(child, parent, on, how):
        joined = plain(child, parent, on, how)
        if on == [("up", "at")]:
            spread = joined.withColumn("task", F.spark_partition_id()).groupBy("next").agg(
                F.countDistinct("task").alias("n"), F.max("node"))
            tasks.append(max((r["n"] for r in spread.collect()), default=0))
        return joined

    monkeypatch.setattr(hierarchy, "join_parent", watched)
    try:
        # every row hangs on one middle row, which hangs on the root
        df = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") < 2, F.col("id").cast("string")).otherwise(F.sha1(F.col("id").cast("string"))).alias("id"),
            F.when(F.col("id") == 0, None).when(F.col("id") == 1, "0").otherwise("1").alias("parent"))
        found = hierarchy.resolved(df, "id", "parent")
        assert {tuple(r) for r in found.groupBy("root", "depth", "state").count().collect()} == {
            ("0", 0, "ends", 1), ("0", 1, "ends", 1), ("0", 2, "ends", 59_998)}
        assert max(tasks) > 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_rows_in_circles_cost_no_rounds(spark, rounds):
    """Rounds follow the longest chain that ends; what runs in a circle is told by a round that finishes nothing."""
    loops = [(f"l{k}", f"l{(k + 1) % 500}") for k in range(500)] + [(f"t{k}", f"l{k}") for k in range(100)]
    chains = [(f"{c}-{k}", f"{c}-{k - 1}" if k else None) for c in range(50) for k in range(7)]
    for rows, most in ((loops, 1), (loops + chains, 3 + 1)):
        assert run(spark, rows) == walk(rows)
        assert len(rounds) <= 2 + most
        rounds.clear()
