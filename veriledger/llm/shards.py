"""Contiguous shards of near equal size, cut from the running sum of the documents' sizes.

Documents are put in one order, each part of that order sums its own sizes, and the parts' totals, one
number a part, give where a part begins in the whole. A document goes to the shard in which its middle
falls when the whole is cut into equal lengths, so a shard misses its target by at most the size of
one document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veriledger.llm.frames import quoted, stored


def sized(df: DataFrame, key: str, column: str) -> DataFrame:
    """Per row its key, size (UTF-8 bytes plus 1) and checksum; a null text is sized as none."""
    text = F.coalesce(quoted(column).cast("string"), F.lit(""))
    return df.select(
        quoted(key).alias("key"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("crc"),
        F.monotonically_increasing_id().alias("row"),
    )


def _running(batches):
    """Numbers the rows of one part and sums the sizes before each."""
    part, rows, total = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        sizes = batch.column(1).to_numpy()
        ends = total + np.cumsum(sizes)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(np.full(len(sizes), part), pa.int32()),
             pa.array(rows + np.arange(len(sizes)), pa.int64()), pa.array(ends - sizes, pa.int64())],
            names=["key", "size", "crc", "part", "nth", "before"])
        rows += len(sizes)
        total = int(ends[-1]) if len(ends) else total


def sharded(df: DataFrame, shards: int, key: str = "doc_id", column: str = "text") -> DataFrame:
    """Per row `key`, `size`, `crc`, `shard` (from 0) and `slot`, its place in the shard (from 0).

    The order is by key (null first), then checksum and size; rows equal in all three are
    interchangeable and follow the order in which they were read. Only these few bytes a row are
    shuffled, never the text, and equal keys may lie in several parts, so one key cannot fill a task.
    An empty table gives no rows. Only the named columns are read, so no other column can clash.
    """
    slim = stored(sized(df, key, column), "sizes")
    order = ["key", "crc", "size", "row"]
    parts = slim.repartitionByRange(*order).sortWithinPartitions(*order).drop("row")
    schema = ("key " + dict(slim.dtypes)["key"] + ", size long, crc long, part int, nth long, before long")
    placed = stored(parts.select("key", "size", "crc").mapInArrow(_running, schema), "running")
    # One row a part: few enough for one ordered sum.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(whole).alias("total"),
    )
    middle = 2 * (F.col("bytes_before") + F.col("before")) + F.col("size")
    cut = placed.join(starts, "part").select(
        "key", "size", "crc",
        (F.col("rows_before") + F.col("nth")).alias("place"),
        F.least(F.lit(shards - 1), F.floor(middle.cast("decimal(38,0)") * shards / (2 * F.col("total"))))
        .cast("int").alias("shard"),
    )
    firsts = cut.groupBy("shard").agg(F.min("place").alias("first"))
    return cut.join(F.broadcast(firsts), "shard").select(
        "key", "size", "crc", "shard", (F.col("place") - F.col("first")).alias("slot"))


def placements(df: DataFrame, shards: int = 8) -> DataFrame:
    """Where each document goes; the law is near equal `bytes`, so growing by a shard moves the cuts
    and `grown_shard` is null."""
    return sharded(df, shards).select(
        F.col("key").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(df: DataFrame, folder: str, shards: int, key: str = "doc_id", column: str = "text") -> None:
    """Writes the documents as `shard=<n>` folders; each key must be one row's."""
    places = sharded(df, shards, key, column).select(F.col("key").alias(key), "shard", "slot")
    kept = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    (df.select(*[quoted(c) for c in kept]).join(places, key)
     .repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(folder))
