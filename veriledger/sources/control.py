"""Record counts against control totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_counts(rows: DataFrame, control: DataFrame, by: str) -> DataFrame:
    """Per source: rows counted, rows expected, and whether they agree.

    A source that only one side knows is compared with zero.
    """
    counted = rows.groupBy(by).agg(F.count("*").alias("n"))
    both = counted.join(control.select(by, "expected"), by, "full_outer")
    n = F.coalesce("n", F.lit(0))
    expected = F.coalesce("expected", F.lit(0))
    return both.select(by, n.alias("n"), expected.alias("expected"), (n == expected).alias("ok"))
