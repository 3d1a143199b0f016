import zlib

from odd import ODD_TEXTS
from pyspark.sql import functions as F

from veriledger.llm import shards


def check(rows, expected, count):
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == sorted(
        (str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in expected)
    by = {}
    for r in rows:
        assert r["law"] == "bytes" and r["grown_shard"] is None
        by.setdefault(r["shard"], []).append(r)
    assert set(by) <= set(range(count))
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    sizes = [sum(r["size"] for r in own) for own in by.values()]
    largest = max(r["size"] for r in rows)
    target = sum(r["size"] for r in rows) / count
    assert all(abs(s - target) <= largest for s in sizes) or len(by) < count
    # contiguous: the last key of a shard is not above the first of the next
    order = sorted((r for r in rows), key=lambda r: (r["shard"], r["slot"]))
    keys = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in order]
    assert keys == sorted(keys)


def test_against_brute_force(spark, documents):
    df = spark.createDataFrame(documents, "doc_id long, text string").repartition(7)
    check(shards.placements(df).collect(), documents, 8)


def test_odd_rows(odd):
    check(shards.placements(odd).collect(), ODD_TEXTS, 8)


def test_empty_table(nothing):
    assert shards.placements(nothing).collect() == []


def test_a_key_that_fills_the_table_is_cut(spark):
    df = spark.range(4000).select(F.lit(1).alias("doc_id"), F.lit("same text").alias("text"))
    rows = shards.sharded(df, 4, "doc_id", "text").groupBy("shard").count().collect()
    assert sorted(r["count"] for r in rows) == [1000] * 4


def test_written_shards(spark, documents, tmp_path):
    df = spark.createDataFrame(documents, "doc_id long, text string")
    shards.write_shards(df, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r["doc_id"], r["text"]) for r in back.collect()) == sorted(documents)
