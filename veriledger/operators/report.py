"""What the violations say: counts per rule, the gate, counts per source system."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def summary(violations: DataFrame) -> DataFrame:
    return violations.groupBy("rule").agg(F.count("*").alias("n"))


def rule_counts(violations: DataFrame, codes: Sequence[str]) -> DataFrame:
    """Counts for every rule of the set, zero for the rules nothing broke. One row."""
    return violations.agg(*[F.count_if(F.col("rule") == c).alias(c) for c in dict.fromkeys(codes)])


def gate(violations: DataFrame) -> DataFrame:
    """One row: passed, and the number of violations. Rows are counted, not a nullable key."""
    n = F.count("*")
    return violations.agg((n == 0).alias("passed"), n.alias("violations"))


def by_source(violations: DataFrame) -> DataFrame:
    return violations.groupBy("src_stm", "rule").agg(F.count("*").alias("n"))
