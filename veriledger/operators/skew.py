"""Joins that stay balanced when one key holds a large share of the rows.

A join sends all rows of a key to one task, unless adaptive execution splits that task's input. It can do so
only where both sides were shuffled for the join itself: a parent that was reduced to one row per key is
shuffled by the key for that, and a join on the key alone would take the rows as they lie. So the join is on
the key and a number derived from it. Both sides are then shuffled for the join, and a partition that a hot key
or the NULL keys make large is split into as many tasks as its size asks for, its few parent rows repeated for
each. This holds at every size, nothing is measured beforehand, and building a join starts no job. The reduced
parent is shuffled once more, by rows that are one per key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The derived number only has to be a function of the key.
PARTS = 1 << 20


def has_null(keys: Sequence[Column]) -> Column:
    return reduce(or_, [k.isNull() for k in keys])


def _part(keys: Sequence[Column]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(PARTS))


def with_key_names(parent: DataFrame, child: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """The parent with its keys named ``__k0``, ``__k1``, ... and of the child's types, so both hash alike."""
    types = {f.name: f.dataType for f in child.schema.fields}
    for i, (c, p) in enumerate(on):
        parent = parent.withColumn(f"__k{i}", F.col(p).try_cast(types[c])).drop(p)
    return parent


def join_named(child: DataFrame, parent: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join ``child`` to a parent of :func:`with_key_names`, which has one row per key.

    ``how`` keeps or tests child rows: left, inner, left_semi or left_anti.
    """
    named = [f"__k{i}" for i in range(len(keys))]
    pairs = [F.col(c) == F.col(p) for c, p in zip(keys, named)]
    pairs.append(_part([F.col(c) for c in keys]) == _part([F.col(p) for p in named]))
    return child.join(parent, reduce(and_, pairs), how).drop(*named)


def join_parent(child: DataFrame, parent: DataFrame, on: Sequence[tuple[str, str]], how: str) -> DataFrame:
    """Join ``child`` to ``parent`` (one row per key) on pairs of (child column, parent column)."""
    return join_named(child, with_key_names(parent, child, on), [c for c, _ in on], how)
