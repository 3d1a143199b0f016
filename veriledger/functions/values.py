"""Casts that never fail a job: a bad cell becomes NULL and can be counted."""

from pyspark.sql import Column
from pyspark.sql import types as T

# Sums of amounts are compared for equality, so they are decimals.
AMOUNT_TYPE = T.DecimalType(18, 2)


def cast_to(col: Column, dtype: T.DataType | str) -> Column:
    return col.try_cast(dtype)


def amount(col: Column) -> Column:
    return col.try_cast(AMOUNT_TYPE)


def is_number(col: Column) -> Column:
    """True when the text reads as a number; blank and NULL are no numbers."""
    return col.try_cast("double").isNotNull()
