"""Tables laid out by a key, so that joins on the key move no rows.

Rows lie in a fixed number of buckets by the hash of their key and part, sorted by both within a bucket. The part is
0, but for hot keys: a key with more rows than a bucket's fair share gets as many parts as it holds fair shares, and
NULL is treated as any key. There are never more hot keys than buckets, so their list is small whatever the table's
size; it belongs to the layout. A table that is joined on the key is laid out by the same layout with the
rows of hot keys repeated for each part. Both sides of a join then have the same buckets, and no bucket holds more than its fair
share of a key, so there is nothing for an exchange to do.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The column that numbers the parts of a key.
PART = "__part"


@dataclass(frozen=True)
class Layout:
    """``hot`` has the parts of hot keys, which are few; ``null_parts`` those of rows without a key."""

    key: str
    buckets: int
    hot: tuple[tuple[object, int], ...] = ()
    null_parts: int = 1

    def parts(self, spark: SparkSession, kind: T.DataType) -> DataFrame:
        schema = T.StructType([T.StructField("__hot", kind), T.StructField("__parts", T.IntegerType())])
        return spark.createDataFrame(list(self.hot), schema)


def layout_of(df: DataFrame, key: str, buckets: int) -> Layout:
    """The layout that a table needs. Counts are combined before they are shuffled, and at most ``buckets`` of
    them come to the driver."""
    counts = df.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n"))
    total = df.count()
    rows = counts.filter(F.col("n") * buckets > total).collect()
    parts = {r["k"]: -(-r["n"] * buckets // total) for r in rows}
    null_parts = parts.pop(None, 1)
    return Layout(key, buckets, tuple(sorted(((k, n) for k, n in parts.items()), key=lambda p: str(p[0]))), null_parts)


def merged(layouts: Sequence[Layout]) -> Layout:
    """One layout for several tables with the same key: a key has as many parts as it needs in any of them. Its hot keys
    are at most as many as those tables have buckets together."""
    first = layouts[0]
    if any((l.key, l.buckets) != (first.key, first.buckets) for l in layouts):
        raise ValueError("layouts of one key and number of buckets can be merged")
    hot: dict = {}
    for l in layouts:
        for k, n in l.hot:
            hot[k] = max(n, hot.get(k, 1))
    return Layout(first.key, first.buckets, tuple(sorted(hot.items(), key=lambda p: str(p[0]))),
                  max(l.null_parts for l in layouts))


def dealt(df: DataFrame, layout: Layout) -> DataFrame:
    """The rows with their part. A row's part follows from its values, so a task that is run again deals alike;
    rows that are equal in all columns stay together."""
    # maps have no hash, and no entity has a map
    mix = F.xxhash64(*[F.col(c) for c in df.columns])
    hot = layout.parts(df.sparkSession, df.schema[layout.key].dataType)
    # at most as many rows as buckets
    known = df.join(F.broadcast(hot), F.col(layout.key) == F.col("__hot"), "left").drop("__hot")
    parts = F.when(F.col(layout.key).isNull(), F.lit(layout.null_parts)).otherwise(F.coalesce("__parts", F.lit(1)))
    return known.withColumn(PART, F.pmod(mix, parts).cast("int")).drop("__parts")


def replicated(df: DataFrame, key: str, layout: Layout) -> DataFrame:
    """Rows to join with, those of hot keys once for each part. Rows without a key match nothing and stay once."""
    hot = layout.parts(df.sparkSession, df.schema[key].dataType)
    known = df.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left").drop("__hot")
    last = F.coalesce("__parts", F.lit(1)) - 1
    return known.withColumn(PART, F.explode(F.sequence(F.lit(0), last))).drop("__parts")


def write_buckets(df: DataFrame, table: str, key: str, layout: Layout, location: str | None = None) -> DataFrame:
    """Replaces a table by the rows, which have their part, in the layout's buckets; one file a bucket."""
    writer = (df.repartition(layout.buckets, key, PART).sortWithinPartitions(key, PART).write.mode("overwrite")
              .format("parquet").bucketBy(layout.buckets, key, PART).sortBy(key, PART))
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def bucket_rows(df: DataFrame, key: str, layout: Layout) -> DataFrame:
    """How many rows each bucket has: what a task of a join would read."""
    bucket: Column = F.pmod(F.hash(key, PART), F.lit(layout.buckets))
    return df.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("rows"))
