"""Reports in order, the index of stored keys and tables published together, as queries with their SQL."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriledger.plans.acceptance import table
from veriledger.sources import keyindex, ordered, publish, tables
from veriledger.sources.shared import shared_folder

ROWS_PER_PART = 4000
REPORT = {"Account": "ac_id", "Amount": "amt", "Status": "o_orderstatus"}
SCHEMA = T.StructType([T.StructField("ac_id", T.LongType()), T.StructField("amt", T.DecimalType(18, 2)),
                       T.StructField("msr_prd_id", T.StringType())])
TOTALS = T.StructType([T.StructField("o_orderstatus", T.StringType()), T.StructField("amt", T.DecimalType(28, 2)),
                       T.StructField("msr_prd_id", T.StringType())])
NEW_PERIOD, SEEN_BEFORE = "20031231", "19951231"


def _accounts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("ac_id"), F.col("o_totalprice").cast("decimal(18,2)").alias("amt"),
        F.date_format("o_orderdate", "yyyy1231").alias("msr_prd_id"), "o_orderstatus")


def _report(spark: SparkSession, sf: str) -> str:
    return ordered.export_ordered(_accounts(spark, sf), shared_folder(spark, "reports"), NEW_PERIOD, REPORT, ["ac_id"],
                                  ROWS_PER_PART)


def ordered_report(spark: SparkSession, sf: str) -> DataFrame:
    """The report read back by its manifest, with the part of each row."""
    return ordered.read_report(spark, _report(spark, sf), list(REPORT))


def ordered_report_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """The manifest beside what the parts hold: rows, the first row's place, the first and last key."""
    path = _report(spark, sf)
    key = F.col("Account").cast("long")
    held = ordered.read_report(spark, path, list(REPORT)).groupBy("part").agg(
        F.min(key).alias("first_key"), F.max(key).alias("last_key"))
    return ordered.read_manifest(spark, path).drop("checksum").join(held, "part")


class _Tables:
    """Period tables of this call; their catalog entries go when the block ends."""

    def __init__(self, spark: SparkSession, *schemas: T.StructType):
        self.spark, self.schemas = spark, schemas

    def __enter__(self) -> list[str]:
        self.names = [f"stored_{uuid.uuid4().hex}" for _ in self.schemas]
        for name, schema in zip(self.names, self.schemas):
            tables.create_table(self.spark, name, schema, shared_folder(self.spark, "table"))
        return self.names

    def __exit__(self, *_):
        for name in self.names:
            self.spark.sql(f"drop table {name}")
            self.spark.sql(f"drop table if exists {keyindex.index_table(name)}")


def _aside(df: DataFrame) -> DataFrame:
    folder = shared_folder(df.sparkSession, "result")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def stored_key_index(spark: SparkSession, sf: str) -> DataFrame:
    """Accounts of many periods, indexed; a load of known and new accounts adds the new ones, reading only the
    period that has the known ones."""
    accounts = _accounts(spark, sf).drop("o_orderstatus")
    with _Tables(spark, SCHEMA) as (name,):
        tables.write_period(accounts, name)
        for row in spark.sql(f"show partitions {name}").collect():
            keyindex.replace_index(spark, name, row["partition"].split("=")[1], ["ac_id"])
        known = accounts.filter(F.col("msr_prd_id") == SEEN_BEFORE)
        load = known.union(accounts.withColumn("ac_id", F.col("ac_id") + 10_000_000)).withColumn("amt", -F.col("amt"))
        keyindex.append_new(load.withColumn("msr_prd_id", F.lit(NEW_PERIOD)), name, ["ac_id"], NEW_PERIOD)
        return _aside(spark.table(name))


def published_together(spark: SparkSession, sf: str) -> DataFrame:
    """Accounts and their totals by status, as readers see them before, during and after loads that write both. A load that
    fails after its first table changes nothing."""
    accounts = _accounts(spark, sf)
    folder, seen = shared_folder(spark, "releases"), []

    def totals(rows: DataFrame) -> DataFrame:
        return rows.join(accounts.select("ac_id", "o_orderstatus"), "ac_id").groupBy("o_orderstatus").agg(
            F.sum("amt").alias("amt"))

    with _Tables(spark, SCHEMA, TOTALS) as (detail, total):
        def look(moment: str) -> None:
            rows = spark.table(detail).select(F.lit(moment).alias("moment"), F.col("ac_id").cast("string").alias("key"),
                                              F.col("amt").cast("decimal(28,2)").alias("amt"))
            sums = spark.table(total).select(F.lit(moment), "o_orderstatus", "amt")
            seen.append(_aside(rows.union(sums)))

        def load(factor: int, fails: bool = False) -> publish.Release:
            release = publish.Release(spark, folder)
            rows = accounts.select("ac_id", (F.col("amt") * factor).cast("decimal(18,2)").alias("amt"))
            stored = release.stage(detail, NEW_PERIOD, rows)
            if fails:
                return release
            release.stage(total, NEW_PERIOD, totals(stored))
            return release

        load(1).publish()
        second = load(2)
        look("before")
        second.publish()
        look("after")
        load(3, fails=True).drop()
        look("after a failed load")
        return reduce(DataFrame.union, seen)


QUERIES = {q.__name__: q for q in (ordered_report, ordered_report_manifest, stored_key_index, published_together)}

_ACCOUNTS = ("(select o_orderkey as ac_id, cast(o_totalprice as decimal(18,2)) as amt, "
             "strftime(o_orderdate, '%Y') || '1231' as msr_prd_id, o_orderstatus from orders)")
_PARTS = (f"(select cast(floor((row_number() over (order by ac_id) - 1) / {ROWS_PER_PART}) as int) as part, * "
          f"from {_ACCOUNTS})")


def _seen(moment: str, factor: int) -> str:
    return (f"select '{moment}' as moment, cast(ac_id as varchar) as key, cast({factor} * amt as decimal(28,2)) as amt "
            f"from {_ACCOUNTS} union all select '{moment}', o_orderstatus, cast(sum({factor} * amt) as decimal(28,2)) "
            f"from {_ACCOUNTS} group by o_orderstatus")


STORAGE_SQL = {
    "ordered_report": 'select part, cast(ac_id as varchar) as "Account", cast(amt as varchar) as "Amount", '
                      f'o_orderstatus as "Status" from {_PARTS}',
    "ordered_report_manifest": f"select part, count(*) as rows, cast(part as bigint) * {ROWS_PER_PART} as first_place, "
                               f"min(ac_id) as first_key, max(ac_id) as last_key from {_PARTS} group by part",
    "stored_key_index": f"select ac_id, amt, msr_prd_id from {_ACCOUNTS} union all select ac_id + 10000000, -amt, "
                        f"'{NEW_PERIOD}' from {_ACCOUNTS}",
    "published_together": " union all ".join(
        _seen(*m) for m in (("before", 1), ("after", 2), ("after a failed load", 2))),
}
