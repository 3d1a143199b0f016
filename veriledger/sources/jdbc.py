"""Warehouse queries over JDBC, read in parallel ranges of a numeric or date column."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Ranges:
    """Split of a query: ``parts`` ranges of ``column`` between two bounds.

    The bounds set the stride only; rows outside them are still read.
    """

    column: str
    lower: str
    upper: str
    parts: int


def options(query: str, connection: Mapping[str, str], ranges: Ranges | None = None,
            fetch_size: int = 10_000) -> dict[str, str]:
    """Reader options. A split query is passed as a subquery, which JDBC ranges need."""
    result = {**connection, "fetchsize": str(fetch_size)}
    if ranges is None:
        return {**result, "query": query}
    return {
        **result,
        "dbtable": f"({query}) src",
        "partitionColumn": ranges.column,
        "lowerBound": ranges.lower,
        "upperBound": ranges.upper,
        "numPartitions": str(ranges.parts),
    }


def read_query(spark: SparkSession, query: str, connection: Mapping[str, str],
               ranges: Ranges | None = None) -> DataFrame:
    return spark.read.format("jdbc").options(**options(query, connection, ranges)).load()
