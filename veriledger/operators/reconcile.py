"""Compare filtered sums of two tables.

Each side is summed by date and organisation before the two meet, so rows never multiply and a large
group is already one row per map task when it is shuffled. All balances of a pair of tables are
summed in the same pass. Amounts are decimals and are compared exactly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriledger.functions.values import amount
from veriledger.operators import conditions as c
from veriledger.operators.conditions import Condition, Scope, true_when
from veriledger.operators.skew import join_parent


@dataclass(frozen=True)
class Side:
    """Rows and amount to sum. A second column, if given, is subtracted."""

    value: str
    where: Condition = field(default_factory=c.always)
    minus: str | None = None

    def total(self, scope: Scope) -> Column:
        inside = true_when(self.where(scope))
        total = _sum(inside, self.value)
        return total if self.minus is None else total - _sum(inside, self.minus)


@dataclass(frozen=True)
class Balance:
    """One rule: the left total equals, or is at least, the right total."""

    code: str
    left: Side
    right: Side
    at_least: bool = False


@dataclass(frozen=True)
class Against:
    """A table to reconcile with, its grouping columns and the balances to hold."""

    entity: str
    balances: tuple[Balance, ...]
    by: tuple[str, ...] = ("data_dt", "org_id")


@dataclass(frozen=True)
class Reconciliation:
    """Balances of one entity with others. ``left_lookups`` add columns the left filters read."""

    left: str
    against: tuple[Against, ...]
    by: tuple[str, ...] = ("data_dt", "org_id")
    left_lookups: tuple = ()

    @property
    def balances(self) -> list[Balance]:
        return [b for a in self.against for b in a.balances]

    @property
    def reads(self) -> set[str]:
        return {self.left, *(a.entity for a in self.against), *(l.entity for l in self.left_lookups)}

    def differences(self, tables: Mapping[str, DataFrame],
                    codes: Mapping[str, Sequence[str]]) -> DataFrame:
        left = tables[self.left]
        for lookup in self.left_lookups:
            left = join_parent(left, lookup.one_row_per_key(tables, codes), lookup.on, "left")
        rights = [(tables[a.entity], a.balances, a.by) for a in self.against]
        return reconcile_all(left, rights, self.by, codes)


def reconcile(left: DataFrame, right: DataFrame, balances: Sequence[Balance], by: Sequence[str],
              right_by: Sequence[str] | None = None,
              codes: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Reconcile two tables; see :func:`reconcile_all`."""
    return reconcile_all(left, [(right, balances, right_by or by)], by, codes)


def reconcile_all(left: DataFrame,
                  rights: Sequence[tuple[DataFrame, Sequence[Balance], Sequence[str]]],
                  by: Sequence[str],
                  codes: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """One row per rule and group: both totals, their difference and whether the rule holds.

    The left table is summed once for all balances. A group that only one side has is compared with
    zero; a group that neither side of a balance has gives no row for it.
    """
    names = [[f"{i}_{j}" for j in range(len(balances))] for i, (_, balances, _) in enumerate(rights)]
    left_sides = [(f"l{n}", b.left) for ns, (_, balances, _) in zip(names, rights)
                  for n, b in zip(ns, balances)]
    both = _totals(left, by, left_sides, codes).withColumn("l_has", F.lit(True))
    for i, (right, balances, right_by) in enumerate(rights):
        sides = [(f"r{n}", b.right) for n, b in zip(names[i], balances)]
        totals = _totals(right, right_by, sides, codes).withColumn(f"r{i}_has", F.lit(True))
        for mine, theirs in zip(by, right_by):
            totals = totals.withColumnRenamed(theirs, mine)
        both = both.join(totals, list(by), "full_outer")
    zero = F.lit(0).cast("decimal(28,2)")
    rows = F.array(*[
        F.struct(
            F.lit(b.code).alias("rule"),
            F.coalesce(f"l{n}", zero).alias("left_sum"),
            F.coalesce(f"r{n}", zero).alias("right_sum"),
            F.lit(b.at_least).alias("at_least"),
            F.coalesce("l_has", f"r{i}_has").alias("present"),
        )
        for i, (_, balances, _) in enumerate(rights) for n, b in zip(names[i], balances)
    ])
    long = both.select(*by, F.inline(rows)).filter("present")
    difference = F.col("left_sum") - F.col("right_sum")
    holds = (difference == 0) | (F.col("at_least") & (difference > 0))
    return long.select(
        "rule", *by, "left_sum", "right_sum", difference.alias("difference"), holds.alias("ok")
    )


def _totals(df: DataFrame, by: Sequence[str], sides: Sequence[tuple[str, Side]],
            codes: Mapping[str, Sequence[str]] | None) -> DataFrame:
    scope = Scope.of(df, codes)
    return df.groupBy(*by).agg(
        *[s.total(scope).cast("decimal(28,2)").alias(name) for name, s in sides]
    )


def _sum(inside: Column, column: str) -> Column:
    return F.coalesce(F.sum(F.when(inside, amount(F.col(column)))), F.lit(0).cast("decimal(28,2)"))
