"""Counts taken by the write that stores the rows, so nothing is read again to be counted.

The counts belong to the last stage of the write: an exchange that the rows need comes before they are observed, as
Spark counts a task of an earlier stage again if its output is lost and made anew.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, counts: Mapping[str, Column]) -> dict[str, int]:
    """Writes the rows, replacing the folder, and gives the counts (aggregates that are 0 for no rows)."""
    names = {f"n{i}": name for i, name in enumerate(counts)}
    observation = Observation()
    columns = [counts[name].alias(n) for n, name in names.items()]
    df.observe(observation, *columns).write.mode("overwrite").parquet(path)
    found = observation.get
    return {name: int(found.get(n) or 0) for n, name in names.items()}


def rows() -> Column:
    return F.count(F.lit(1))


def by_value(column: str, values: Sequence[str]) -> dict[str, Column]:
    """How many rows have each of some values."""
    return {v: F.count_if(F.col(column) == v) for v in dict.fromkeys(values)}
