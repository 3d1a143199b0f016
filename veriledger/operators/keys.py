"""Primary keys: rows already stored, repeated keys, references."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriledger.operators.skew import join_parent


def cast_keys(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def skip_stored(new: DataFrame, stored: DataFrame, on: Sequence[str] | Sequence[tuple[str, str]]) -> DataFrame:
    """The rows of ``new`` whose key is not in ``stored`` (keys cast to the types of ``new``)."""
    return without_parent(new, stored, on)


def without_parent(child: DataFrame, parent: DataFrame, on: Sequence[str] | Sequence[tuple[str, str]]) -> DataFrame:
    """Child rows that have no parent row. A NULL key has no parent."""
    pairs = _pairs(on)
    return join_parent(child, _distinct(parent, pairs), pairs, "left_anti")


def with_parent(child: DataFrame, parent: DataFrame, on: Sequence[str] | Sequence[tuple[str, str]]) -> DataFrame:
    """Child rows that have a parent row."""
    pairs = _pairs(on)
    return join_parent(child, _distinct(parent, pairs), pairs, "left_semi")


def duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def _distinct(parent: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    # keys collapse on the map side, so a key repeated in many parent rows is shuffled once per task
    return parent.select(*[p for _, p in pairs]).distinct()


def _pairs(on) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else tuple(k) for k in on]
