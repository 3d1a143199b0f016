"""Conditions of a rule, written once as data and turned into a Column when a table is known.

A condition is a function of a :class:`Scope` (column types of the joined row, code lists), so that
`blank` can skip the trim on columns that are no text. Conditions combine with ``&``, ``|`` and
``~`` and follow SQL's three-valued logic; the rule families decide what NULL means.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriledger.functions import blanks, checkdigit, values


@dataclass(frozen=True)
class Scope:
    """What a condition may look at: column types by name, and code lists by name. ``known`` has conditions that were
    decided before and the columns that hold the outcome."""

    types: Mapping[str, T.DataType]
    codes: Mapping[str, Sequence[str]] = field(default_factory=dict)
    known: Mapping[Condition, Column] = field(default_factory=dict)

    @staticmethod
    def of(df: DataFrame, codes: Mapping[str, Sequence[str]] | None = None) -> Scope:
        return Scope({f.name: f.dataType for f in df.schema.fields}, codes or {})

    def code_list(self, name: str) -> list[str]:
        if name not in self.codes:
            raise KeyError(f"code list {name!r} is not bound; known: {sorted(self.codes)}")
        return list(self.codes[name])


@dataclass(frozen=True)
class Condition:
    """``parts`` are conditions that ``build`` calls, so that one may be decided where its columns are."""

    build: Callable[[Scope], Column]
    parts: tuple[Condition, ...] = ()

    def __call__(self, scope: Scope) -> Column:
        known = scope.known.get(self) if scope.known else None
        return self.build(scope) if known is None else known

    def __and__(self, other: Condition) -> Condition:
        return Condition(lambda s: self(s) & other(s), (self, other))

    def __or__(self, other: Condition) -> Condition:
        return Condition(lambda s: self(s) | other(s), (self, other))

    def __invert__(self) -> Condition:
        return Condition(lambda s: ~self(s), (self,))


def sql(text: str) -> Condition:
    """Any Spark SQL predicate over the row."""
    return Condition(lambda s: F.expr(text))


def always() -> Condition:
    return Condition(lambda s: F.lit(True))


def blank(*columns: str) -> Condition:
    """Every named column is blank."""
    return _all([Condition(lambda s, c=c: blanks.blank(F.col(c), s.types.get(c))) for c in columns])


def filled(*columns: str) -> Condition:
    """No named column is blank."""
    return _all([Condition(lambda s, c=c: blanks.filled(F.col(c), s.types.get(c))) for c in columns])


def some_filled(*columns: str) -> Condition:
    """At least one named column is not blank."""
    return ~blank(*columns)


def in_codes(column: str, *lists: str) -> Condition:
    """The value is in one of the named code lists (bound by the user, a few values each)."""
    return Condition(lambda s: F.col(column).isin([c for name in lists for c in s.code_list(name)]))


def equals(column: str, value) -> Condition:
    return Condition(lambda s: F.col(column) == F.lit(value))


def one_of(column: str, *values_: str) -> Condition:
    return Condition(lambda s: F.col(column).isin(list(values_)))


def at_least(column: str, low) -> Condition:
    return Condition(lambda s: F.col(column) >= F.lit(low))


def above(column: str, low) -> Condition:
    return Condition(lambda s: F.col(column) > F.lit(low))


def between(column: str, low, high) -> Condition:
    return Condition(lambda s: F.col(column).between(low, high))


def not_before(column: str, other: str) -> Condition:
    return Condition(lambda s: F.col(column) >= F.col(other))


def same(column: str, other: str) -> Condition:
    return Condition(lambda s: F.col(column) == F.col(other))


def numeric(column: str) -> Condition:
    return Condition(lambda s: values.is_number(F.col(column)))


def valid_id(column: str) -> Condition:
    return Condition(lambda s: checkdigit.thai_id_check(F.col(column)))


def _all(conditions: Sequence[Condition]) -> Condition:
    result = conditions[0]
    for c in conditions[1:]:
        result = result & c
    return result


def true_when(col: Column) -> Column:
    """NULL counts as false."""
    return F.coalesce(col, F.lit(False))
