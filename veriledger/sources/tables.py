"""Entity tables in the catalog: Parquet, partitioned by reporting period."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PERIOD = "msr_prd_id"


def create_table(spark: SparkSession, table: str, schema: T.StructType,
                 location: str | None = None) -> None:
    """Create an entity table if it is missing. The period is the last column, as partitions are.

    With a location the files outlive the catalog: a new session finds the stored periods again.
    """
    if spark.catalog.tableExists(table):
        return
    fields = [f for f in schema.fields if f.name != PERIOD]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    place = f" location '{location}'" if location else ""
    spark.sql(
        f"create table if not exists {table} ({columns}, {PERIOD} string) "
        f"using parquet partitioned by ({PERIOD}){place}"
    )
    if location:
        folder = spark._jvm.org.apache.hadoop.fs.Path(location)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
        spark.catalog.recoverPartitions(table)


def read_period(spark: SparkSession, table: str, period: str) -> DataFrame:
    """One period; the filter prunes partitions."""
    return spark.table(table).filter(F.col(PERIOD) == period)


def read_until(spark: SparkSession, table: str, period: str) -> DataFrame:
    """All periods up to one, for entities that are stored once when they occur."""
    return spark.table(table).filter(F.col(PERIOD) <= period)


def query(spark: SparkSession, text: str, values: Mapping[str, object] | None = None,
          frames: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """SQL with named parameters (`:name`) and nested queries (`{name}`).

    Values are bound by Spark as literals, never pasted into the text.
    """
    return spark.sql(text, args=dict(values or {}), **dict(frames or {}))


def write_period(df: DataFrame, table: str) -> None:
    """Replace the periods that ``df`` holds and leave all others. Running it twice changes nothing.

    Rows are rebalanced by period, so a period gets files of a good size and not one per task; a large
    period is split over several tasks. Spark commits the files together, so a lost executor leaves no
    half-written period. The mode is a session setting because `insertInto` takes no writer option for it.
    """
    spark = df.sparkSession
    columns = spark.table(table).columns
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows = df.select(*columns).hint("rebalance", F.col(PERIOD))
        rows.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def replace_period(df: DataFrame, table: str, period: str) -> None:
    """As :func:`write_period` for a single named period, also when ``df`` has no rows.

    A dynamic overwrite leaves a period alone that gets no row, so an empty load is a drop.
    """
    spark = df.sparkSession
    if not re.fullmatch(r"[0-9]{8}", period):
        raise ValueError(f"not a period: {period!r}")
    columns = [c for c in spark.table(table).columns if c != PERIOD]
    # the period is stated, so this overwrites exactly this partition, empty or not
    spark.sql(
        f"insert overwrite table {table} partition ({PERIOD} = '{period}') select * from {{rows}}",
        rows=df.select(*columns).hint("rebalance"),
    )


def append_rows(df: DataFrame, table: str) -> None:
    df.select(*df.sparkSession.table(table).columns).write.insertInto(table)


def insert_select(spark: SparkSession, table: str, text: str,
                  values: Mapping[str, object] | None = None) -> None:
    """Fill a table from a query inside the catalog, replacing the periods the query returns."""
    write_period(query(spark, text, values), table)


def align(df: DataFrame, schema: T.StructType, extra: Sequence[str] = ()) -> DataFrame:
    """Columns and types of a target table; a column the frame lacks is NULL."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).try_cast(f.dataType).alias(f.name)
        for f in schema.fields
    ], *extra)
