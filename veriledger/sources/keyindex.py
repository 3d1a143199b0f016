"""An index of the keys that a table's periods hold, so that a load reads only periods that may hold one of its keys.

Beside a table lies another with a Bloom filter per period: blocks of 32768 bits, 32 to 64 bits a key. A key belongs to
one block of a period and sets eight bits there. A key that a period holds always finds its bits; one that it does not
hold finds all eight with a chance below 1 in 100,000. New keys are first held against the filters, then, with the few
periods that may hold them, against the stored keys themselves: the filters decide what is read, never what is
stored. A period's filter is replaced with its rows.

All of it is built-in expressions. Keys are dealt out by block before bits are set, so a task holds the blocks it
builds and no key is gathered.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veriledger.operators.keys import skip_stored
from veriledger.operators.skew import has_null
from veriledger.sources import tables
from veriledger.sources.shared import remove_folder, shared_folder
from veriledger.sources.tables import PERIOD

BLOCK_BITS = 1 << 15
BITS_PER_KEY = 32
HASHES = 8

SCHEMA = f"blocks int, block int, bits binary, {PERIOD} string"


def index_table(table: str) -> str:
    return f"{table}_keys"


def _positions(keys: Sequence[str]) -> Column:
    """Eight bits of a block, by two hashes of the key."""
    first = F.pmod(F.xxhash64(F.lit(1), *keys), F.lit(BLOCK_BITS))
    step = F.pmod(F.xxhash64(F.lit(2), *keys), F.lit(BLOCK_BITS // 2)) * 2 + 1
    return F.array(*[F.pmod(first + step * i, F.lit(BLOCK_BITS)) for i in range(HASHES)])


def _block(keys: Sequence[str], blocks: Column | int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(blocks) if isinstance(blocks, int) else blocks).cast("int")


def built(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The filter of some rows' keys: ``blocks`` (a power of two), ``block`` and ``bits``. Keys with a NULL are in no filter, as
    they equal nothing."""
    distinct = rows.filter(~has_null([F.col(k) for k in keys])).select(*keys).distinct()
    count = distinct.count()
    blocks = 1 << max(0, -(-count * BITS_PER_KEY // BLOCK_BITS) - 1).bit_length()
    dealt = distinct.select(_block(keys, blocks).alias("block"), _positions(keys).alias("at")).repartition("block")
    return (dealt.select("block", F.explode("at").alias("bit")).groupBy("block")
            .agg(F.bitmap_construct_agg("bit").alias("bits"))
            .select(F.lit(blocks).alias("blocks"), "block", "bits"))


def replace_index(spark: SparkSession, table: str, period: str, keys: Sequence[str]) -> None:
    """Makes the filter of a stored period anew."""
    name = index_table(table)
    if not spark.catalog.tableExists(name):
        spark.sql(f"create table if not exists {name} ({SCHEMA}) using parquet partitioned by ({PERIOD})")
    rows = tables.read_period(spark, table, period)
    tables.replace_period(built(rows, keys).withColumn(PERIOD, F.lit(period)), name, period)


def may_hold(new: DataFrame, index: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``new`` with the periods whose filter has all their bits."""
    sizes = [r["blocks"] for r in index.select("blocks").distinct().collect()]  # powers of two: a few dozen at most
    if not sizes:
        return new.select(*keys).limit(0).withColumn(PERIOD, F.lit(""))
    distinct = new.filter(~has_null([F.col(k) for k in keys])).select(*keys).distinct()
    asked = distinct.withColumn("blocks", F.explode(F.array(*[F.lit(n) for n in sizes])))
    asked = asked.select(*keys, "blocks", _block(keys, F.col("blocks")).alias("block"), _positions(keys).alias("at"))
    met = asked.join(index, ["blocks", "block"])
    return met.filter(reduce(and_, [_is_set("bits", f"at[{i}]") for i in range(HASHES)])).select(*keys, PERIOD)


def _is_set(bits: str, at: str) -> Column:
    """Whether a bitmap has a bit; Spark puts the first bit of a byte last."""
    byte = f"cast(conv(hex(substring({bits}, cast({at} div 8 + 1 as int), 1)), 16, 10) as int)"
    return F.expr(f"(shiftright({byte}, cast({at} % 8 as int)) & 1) = 1")


def periods_to_read(new: DataFrame, table: str, keys: Sequence[str], besides: str | None = None) -> list[str]:
    """The periods that may hold a new key: those whose filter says so, and those that have none. ``besides`` is
    a period that is replaced anyway."""
    spark = new.sparkSession
    if not spark.catalog.tableExists(index_table(table)):
        index, indexed = None, set()
    else:
        index = spark.table(index_table(table))
        indexed = {r[PERIOD] for r in index.select(PERIOD).distinct().collect()}
    stored = {r["partition"].split("=", 1)[1] for r in spark.sql(f"show partitions {table}").collect()}
    found = {r[PERIOD] for r in may_hold(new, index, keys).select(PERIOD).distinct().collect()} if index is not None else set()
    return sorted((found & stored | stored - indexed) - {besides})


def skip_stored_keys(new: DataFrame, table: str, keys: Sequence[str], besides: str | None = None) -> DataFrame:
    """The rows of ``new`` whose key no stored period has; only periods that may hold one are read.

    Keys of ``new`` must have the types of the table's, as both hash alike only then.
    """
    spark = new.sparkSession
    types = spark.table(table).schema
    other = [k for k in keys if new.schema[k].dataType != types[k].dataType]
    if other:
        raise ValueError(f"keys {other} have other types than in {table}")
    periods = periods_to_read(new, table, keys, besides)
    if not periods:
        return new
    return skip_stored(new, spark.table(table).filter(F.col(PERIOD).isin(periods)), keys)


def append_new(new: DataFrame, table: str, keys: Sequence[str], period: str) -> None:
    """Stores, as a period of the table, the rows whose key no other period has, and indexes them."""
    spark = new.sparkSession
    rows = skip_stored_keys(tables.align(new, spark.table(table).schema), table, keys, period)
    # a table cannot be overwritten while it is read, so the new rows are written aside first
    aside = shared_folder(spark, "new")
    rows.write.parquet(aside)
    try:
        tables.replace_period(spark.read.schema(rows.schema).parquet(aside), table, period)
    finally:
        remove_folder(spark, aside)
    replace_index(spark, table, period, keys)
