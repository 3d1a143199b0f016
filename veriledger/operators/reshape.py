"""Columns of a load: sources, constants, blanks, order, values from another table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriledger.functions import blanks
from veriledger.operators.skew import join_parent


def stack_sources(sources: Mapping[str, DataFrame], column: str = "src_stm") -> DataFrame:
    """The slices of the source systems as one frame, each row marked with its source."""
    tagged = [df.withColumn(column, F.lit(name)) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def tag_source(df: DataFrame, by: str, names: Mapping[str, str], otherwise: str,
               column: str = "src_stm") -> DataFrame:
    """Mark rows of one table that already holds several sources; the table is read once."""
    tag = F.lit(otherwise)
    for value, name in names.items():
        tag = F.when(F.col(by) == value, name).otherwise(tag)
    return df.withColumn(column, tag)


def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.lit(v) for c, v in values.items()})


def fill_missing(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def clear_spaces(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: blanks.clear_space(F.col(c)) for c in columns})


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def in_order(df: DataFrame, columns: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Select columns in order; a mapping gives (new name -> column)."""
    if isinstance(columns, Mapping):
        return df.select(*[F.col(c).alias(name) for name, c in columns.items()])
    return df.select(*columns)


def set_from(df: DataFrame, mapping: DataFrame, on: Sequence[tuple[str, str]],
             columns: Mapping[str, str], default: Mapping[str, object] | None = None) -> DataFrame:
    """Set columns of ``df`` from another table by key: column -> column of ``mapping``.

    Rows without a match keep their value, or get the default when the column is new. When the
    mapping repeats a key its largest value counts, so a row is never multiplied.
    """
    default = default or {}
    keys = [p for _, p in on]
    values = {c: f"__new_{c}" for c in columns}
    reduced = mapping.groupBy(*keys).agg(
        *[F.max(theirs).alias(values[c]) for c, theirs in columns.items()]
    )
    joined = join_parent(df, reduced, on, "left")
    new = {}
    for c in columns:
        options = [F.col(values[c])]
        if c in df.columns:
            options.append(F.col(c))
        if c in default:
            options.append(F.lit(default[c]))
        new[c] = F.coalesce(*options)
    return joined.withColumns(new).drop(*values.values())
