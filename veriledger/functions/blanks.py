"""Blank handling. A value is blank when it is NULL or, for text, only spaces."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cells that the landing reader takes as missing (the pandas.read_csv defaults).
NULL_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def blank(col: Column, dtype: T.DataType | None = None) -> Column:
    """True for NULL and, unless ``dtype`` says the column is not text, for spaces only."""
    if dtype is not None and not isinstance(dtype, T.StringType):
        return col.isNull()
    return col.isNull() | (F.trim(col) == "")


def filled(col: Column, dtype: T.DataType | None = None) -> Column:
    return ~blank(col, dtype)


def clear_space(col: Column) -> Column:
    """Spaces become NULL, other text is trimmed."""
    return F.nullif(F.trim(col), F.lit(""))


def null_words_to_null(col: Column) -> Column:
    return F.when(~col.isin(NULL_WORDS), col)
