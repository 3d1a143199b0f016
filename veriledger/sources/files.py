"""Files: Parquet in row chunks, period reports, violation files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriledger.operators.reshape import in_order

ROWS_PER_FILE = 5_000_000


def write_chunks(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)


def read_chunks(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All Parquet chunks of a folder or glob. A known schema saves reading a footer first."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def export_report(df: DataFrame, folder: str, period: str, names: Mapping[str, str],
                  rows_per_file: int = ROWS_PER_FILE) -> str:
    """The report of a period: CSV parts with report column names under ``folder/period``."""
    path = f"{folder.rstrip('/')}/{period}"
    report = in_order(df, names)
    report.write.mode("overwrite").option("header", True).option(
        "maxRecordsPerFile", rows_per_file
    ).option("emptyValue", "").csv(path)
    return path


def write_violations(violations: DataFrame, folder: str, run_id: str,
                     by: Sequence[str] = ("rule", "src_stm"),
                     rows_per_file: int = ROWS_PER_FILE) -> str:
    """Violation files of a run, one folder per rule (and source).

    The rebalance gathers a rule's rows into few files and still splits a rule that holds most rows.
    """
    path = f"{folder.rstrip('/')}/{run_id}"
    gathered = violations.hint("rebalance", *[F.col(c) for c in by])
    gathered.write.mode("overwrite").partitionBy(*by).option("header", True).option(
        "maxRecordsPerFile", rows_per_file
    ).csv(path)
    return path


def empty_report(spark: SparkSession, schema: T.StructType, row: Sequence) -> DataFrame:
    """A report without data: the columns and one template row."""
    return spark.createDataFrame([tuple(row)], schema)
