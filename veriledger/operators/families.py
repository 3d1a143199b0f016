"""The rule families. Each one states, for one row, when the row breaks the rule.

A rule is written as its violation, never as ``NOT rule``: a condition that is NULL does not fire,
a required value that is NULL does.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column

from veriledger.operators import conditions as c
from veriledger.operators.conditions import Condition, Scope, true_when


@dataclass(frozen=True)
class Rule:
    """One check. ``needs`` names the lookups whose columns ``violation`` reads."""

    code: str
    family: str
    violation: Condition
    needs: tuple[str, ...] = ()

    def broken(self, scope: Scope) -> Column:
        return true_when(self.violation(scope))


def implies(code: str, family: str, when: Condition, then: Condition,
            needs: Sequence[str] = ()) -> Rule:
    """``when`` holds and ``then`` is false or NULL."""
    violation = Condition(lambda s: true_when(when(s)) & ~true_when(then(s)), (when, then))
    return Rule(code, family, violation, tuple(needs))


def required_if(code: str, when: Condition, *columns: str, holds: Condition | None = None,
                needs: Sequence[str] = ()) -> Rule:
    """V1: under ``when`` the columns are not blank and ``holds``, if given, is true."""
    then = c.filled(*columns) if holds is None else c.filled(*columns) & holds
    return implies(code, "V1", when, then, needs)


def within(code: str, column: str, test: Condition, when: Condition | None = None,
           needs: Sequence[str] = ()) -> Rule:
    """V2: a range or threshold on a value that is not blank."""
    scope = c.filled(column) if when is None else when & c.filled(column)
    return implies(code, "V2", scope, test, needs)


def required_within(code: str, when: Condition, column: str, test: Condition, *also_filled: str,
                    needs: Sequence[str] = ()) -> Rule:
    """V2: under ``when`` the value is in range; blank breaks the rule too."""
    return implies(code, "V2", when, c.filled(column, *also_filled) & test, needs)


def date_rule(code: str, ordered: Condition, when: Condition | None = None, *,
              required: str | None = None, needs: Sequence[str] = ()) -> Rule:
    """V3: order of two dates, or a bound on the year.

    A missing date leaves the order unknown, which breaks nothing, unless the date is required.
    """
    missing = None if required is None else c.blank(required)

    def broken(s: Scope) -> Column:
        wrong = true_when(~ordered(s))
        if missing is not None:
            wrong = wrong | missing(s)
        return wrong if when is None else true_when(when(s)) & wrong

    return Rule(code, "V3", Condition(broken, tuple(p for p in (ordered, missing, when) if p is not None)), tuple(needs))


def iff_filled(code: str, when: Condition, column: str, needs: Sequence[str] = ()) -> Rule:
    """V4: not blank exactly when the condition holds."""
    filled = c.filled(column)
    violation = Condition(lambda s: true_when(when(s)) != filled(s), (when, filled))
    return Rule(code, "V4", violation, tuple(needs))


def either_filled(code: str, *columns: str, when: Condition | None = None,
                  also: Condition | None = None, needs: Sequence[str] = ()) -> Rule:
    """V5: at least one of the columns is not blank (and ``also`` is true)."""
    then = c.some_filled(*columns) if also is None else c.some_filled(*columns) & also
    return implies(code, "V5", when or c.always(), then, needs)


def references(code: str, parent: str) -> Rule:
    """V6: the parent row exists."""
    return Rule(code, "V6", ~found(parent), (parent,))


def references_if(code: str, when: Condition, parent: str, needs: Sequence[str] = ()) -> Rule:
    """V7: the parent row exists, asked only under a condition."""
    return implies(code, "V7", when, found(parent), (parent, *needs))


def references_any(code: str, *parents: str, when: Condition | None = None) -> Rule:
    """V8: a row exists in at least one of the parents."""
    exists = found(parents[0])
    for p in parents[1:]:
        exists = exists | found(p)
    return implies(code, "V8", when or c.always(), exists, parents)


def must_be_reported(code: str, scope: Condition, child: str, needs: Sequence[str] = ()) -> Rule:
    """V9: a parent row in scope has a child row. The base table is the parent."""
    return implies(code, "V9", scope, found(child), (child, *needs))


def must_not_be_reported(code: str, forbidden: Condition, needs: Sequence[str]) -> Rule:
    """V10: the parent of the row is in a class that is not reported."""
    return Rule(code, "V10", forbidden, tuple(needs))


def check_digit(code: str, when: Condition, column: str) -> Rule:
    """V12: the identifier passes the check digit test."""
    return implies(code, "V12", when, c.valid_id(column))


def typed_value(code: str, column: str, numeric_when: Condition, flag_when: Condition) -> Rule:
    """V13: a number for some codes, 0 or 1 for others."""
    violation = Condition(
        lambda s: (true_when(numeric_when(s)) & ~true_when(c.numeric(column)(s)))
        | (true_when(flag_when(s)) & ~true_when(c.one_of(column, "0", "1")(s)))
    )
    return Rule(code, "V13", violation)


def placeholder_ban(code: str, since: Condition, is_placeholder: Condition,
                    needs: Sequence[str] = ()) -> Rule:
    """V14: from a date on, a placeholder value is not allowed."""
    violation = Condition(lambda s: true_when(since(s)) & true_when(is_placeholder(s)), (since, is_placeholder))
    return Rule(code, "V14", violation, tuple(needs))


def in_list(code: str, when: Condition, then: Condition, needs: Sequence[str] = ()) -> Rule:
    """V15: membership in a code list, as the value tested or as the condition."""
    return implies(code, "V15", when, then, needs)


def in_list_table(code: str, when: Condition, listed: str, needs: Sequence[str] = ()) -> Rule:
    """V15 for a list that a table or view holds: a lookup of the list by the value finds it, so the list
    is joined as any parent and Spark broadcasts it by its own size check."""
    return implies(code, "V15", when, found(listed), (listed, *needs))


def hierarchy(code: str, then: Condition, when: Condition | None = None,
              needs: Sequence[str] = ()) -> Rule:
    """V16: root, parent and level of a row agree, or its parent is a row of the same table."""
    return implies(code, "V16", when or c.always(), then, needs)


def must_differ(code: str, column: str, other: str) -> Rule:
    """V17: two keys of a row differ."""
    return Rule(code, "V17", c.same(column, other))


def described_if_other(code: str, is_other: Condition, text: str) -> Rule:
    """V18: code Other needs a description."""
    return implies(code, "V18", is_other, c.filled(text))


def found(lookup: str) -> Condition:
    """The lookup matched. Its columns carry the lookup's name as a prefix."""
    return c.sql(f"{lookup}__found is not null")
