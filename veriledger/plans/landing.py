"""Landing: rows of one source and period into the source's own table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriledger.functions.periods import load_time
from veriledger.operators import observed, reshape
from veriledger.plans.jobs import Landing
from veriledger.sources import tables, text
from veriledger.sources.shared import remove_folder, shared_folder
from veriledger.specs.entities import ENTITIES

LOAD_COLUMNS = ("msr_prd_id", "src_stm", "ppn_tm")

REJECTS = T.StructType([T.StructField(n, T.StringType()) for n in ("file", "record", "reasons", "msr_prd_id")])


class CountMismatch(ValueError):
    """The files hold another number of records than the control total says."""


def staging_table(database: str, landing: Landing) -> str:
    return f"{database}.{landing.table.lower()}"


def file_schema(landing: Landing):
    """Columns a source's file has: the table's, without what the load and placeholders add."""
    added = {*LOAD_COLUMNS, *landing.placeholders}
    schema = ENTITIES[landing.entity].schema
    return type(schema)([f for f in schema.fields if f.name not in added])


def delivered_schema(spark: SparkSession, landing: Landing, database: str):
    """The columns of a source's file: those of its stored table, or of the entity before the first load."""
    table = staging_table(database, landing)
    if not spark.catalog.tableExists(table):
        return file_schema(landing)
    return text.table_schema(spark, table, (*LOAD_COLUMNS, *landing.placeholders))


@dataclass(frozen=True)
class Load:
    """How many records were stored and how many rejected; ``rejects`` are the stored ones of the period."""

    kept: int
    rejected: int
    rejects: DataFrame


def land_text(spark: SparkSession, landing: Landing, folder: str, file_name: str, period: str,
              moment: datetime, expected: int, database: str = "default") -> Load:
    """Read the files of a period, check their number of records and replace the period.

    The files are parsed once, into the shared folder, and that write counts the records and the rejected ones; they
    are stored from there. Rejected records go to a table beside the source's, with their file and reasons.
    """
    pattern = text.landed_pattern(folder, file_name, period)
    aside = shared_folder(spark, "landed")
    parsed = text.read_pipe_text(spark, pattern, delivered_schema(spark, landing, database)).records
    counts = observed.write_parquet(parsed, aside, {
        "records": observed.rows(), "rejected": F.count_if(F.size(text.REASONS) > 0)})
    try:
        check(counts["records"], file_name, period, expected)
        landed = text.Landed(spark.read.schema(parsed.schema).parquet(aside))
        store(landing, landed.rows, period, moment, database)
        rejects = store_rejects(landing, landed.rejects, period, database)
        return Load(expected - counts["rejected"], counts["rejected"], rejects)
    finally:
        remove_folder(spark, aside)


def check(records: int, file_name: str, period: str, expected: int) -> None:
    """Holds the number of records, rejected ones too, against the control total."""
    if records != expected:
        raise CountMismatch(f"{file_name} {period}: {records} records, expected {expected}")


def store_rejects(landing: Landing, rejects: DataFrame, period: str, database: str) -> DataFrame:
    spark = rejects.sparkSession
    table = f"{staging_table(database, landing)}_rejects"
    tables.create_table(spark, table, REJECTS)
    tables.replace_period(rejects, table, period)
    return tables.read_period(spark, table, period)


def land_query(landing: Landing, rows: DataFrame, period: str, moment: datetime,
               database: str = "default") -> None:
    """Rows of a warehouse query into the source's table."""
    store(landing, rows, period, moment, database)


def store(landing: Landing, rows: DataFrame, period: str, moment: datetime, database: str) -> None:
    spark = rows.sparkSession
    schema = ENTITIES[landing.entity].schema
    table = staging_table(database, landing)
    tables.create_table(spark, table, schema)
    staged = reshape.with_constants(rows, {
        "msr_prd_id": period, "src_stm": landing.source, "ppn_tm": load_time(moment),
        **landing.placeholders})
    tables.replace_period(tables.align(staged, schema), table, period)


def staged_rows(spark: SparkSession, landings: list[Landing], period: str,
                database: str = "default") -> DataFrame:
    """The slices of all sources of an entity for a period, as one frame."""
    return reshape.stack_sources({
        l.source: tables.read_period(spark, staging_table(database, l), period).drop("src_stm")
        for l in landings
    })
