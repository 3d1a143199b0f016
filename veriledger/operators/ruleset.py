"""Evaluate all rules of an entity in one pass over its table for each key it looks up others by.

Every rule becomes one bit of a number, so the table is scanned once for many of them. Rules that look at other
entities get their bit after a left join to that entity, reduced to one row per key. Entities that are
looked up by the same columns are put together before, so the table is shuffled once per distinct key, not
once per rule. Keys whose rules have nothing to do with each other are taken one by one, each with a scan of
its few columns: a scan is cheaper than to shuffle a row's other keys with it. What a rule asks of the row itself is decided
before the join and travels as two bits (true, false or unknown), not as the columns it is about. Rows whose number is zero
are dropped before the broken rules are listed.

A row's bits go along with how many there are. As both are made from the same tests, Spark finds each test
twice and puts it into a method of its own; a single method with all tests would be too large for the JVM to compile.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriledger.operators import skew
from veriledger.operators.conditions import Condition, Scope, true_when
from veriledger.operators.families import Rule
from veriledger.operators.reconcile import Reconciliation

Tables = Mapping[str, DataFrame]
Codes = Mapping[str, Sequence[str]]

BROKEN = "__broken"
COUNT = "__rules_broken"
WORD_BITS = 63
#: What rows say themselves, two bits a condition.
SETTLED = "__settled"
SETTLED_BITS = 62
VIOLATION_COLUMNS = ["entity", "msr_prd_id", "rule", "key", "src_stm"]


@dataclass(frozen=True)
class Fact:
    """A column of a lookup: an aggregate over the parent rows of one key.

    Facts are booleans, numbers or dates where possible, so that the aggregate runs before the
    shuffle in a hash table.
    """

    name: str
    aggregate: str
    of: Condition | str

    def column(self, scope: Scope) -> Column:
        value = F.col(self.of) if isinstance(self.of, str) else self.of(scope)
        return getattr(F, self.aggregate)(value)


def any_row(name: str, condition: Condition) -> Fact:
    """True when some parent row of the key satisfies the condition."""
    return Fact(name, "bool_or", condition)


def latest(name: str, column: str | None = None) -> Fact:
    return Fact(name, "max", column or name)


def earliest(name: str, column: str | None = None) -> Fact:
    return Fact(name, "min", column or name)


@dataclass(frozen=True)
class Lookup:
    """Parent rows of another entity by key. Facts appear as ``<lookup name>__<fact name>``."""

    name: str
    entity: str
    on: tuple[tuple[str, str], ...]
    facts: tuple[Fact, ...] = ()
    where: Condition | None = None

    def one_row_per_key(self, tables: Tables, codes: Codes) -> DataFrame:
        parent = tables[self.entity]
        scope = Scope.of(parent, codes)
        if self.where is not None:
            parent = parent.filter(self.where(scope))
        keys = [p for _, p in self.on]
        named = [f.column(scope).alias(f"{self.name}__{f.name}") for f in self.facts]
        reduced = parent.groupBy(*keys).agg(*named) if named else parent.select(*keys).distinct()
        return reduced.withColumn(f"{self.name}__found", F.lit(True))


@dataclass(frozen=True)
class Pass:
    """Rules over the rows of one base table. ``key`` names what a violation reports."""

    entity: str
    key: tuple[str, ...]
    rules: tuple[Rule, ...]
    lookups: tuple[Lookup, ...] = ()
    where: Condition | None = None


@dataclass(frozen=True)
class View:
    """A frame derived from entities, for rules that reach another entity over several keys."""

    name: str
    build: Callable[[Tables, Codes], DataFrame]
    reads: tuple[str, ...]


@dataclass(frozen=True)
class RuleSet:
    """The checks of one job on one reported entity."""

    entity: str
    passes: tuple[Pass, ...]
    reconciliations: tuple[Reconciliation, ...] = ()
    views: tuple[View, ...] = ()

    @property
    def codes(self) -> list[str]:
        own = [r.code for p in self.passes for r in p.rules]
        return own + [b.code for r in self.reconciliations for b in r.balances]

    @property
    def rules(self) -> list[Rule]:
        return [r for p in self.passes for r in p.rules]

    @property
    def reads(self) -> list[str]:
        """Entities the rules read."""
        views = {v.name for v in self.views}
        names = {p.entity for p in self.passes}
        names |= {l.entity for p in self.passes for l in p.lookups}
        names |= {e for v in self.views for e in v.reads}
        for r in self.reconciliations:
            names |= r.reads
        return sorted(names - views)


@dataclass(frozen=True)
class Parents:
    """Looked-up entities, reduced anew for every pass. :mod:`veriledger.operators.facts` has stored ones."""

    tables: Tables
    codes: Codes

    def reduced(self, lookups: Sequence[Lookup]) -> list[tuple[DataFrame, Sequence[tuple[str, str]]]]:
        """Frames with one row per key that hold all facts of some lookups, with their (child, parent) keys."""
        return [(l.one_row_per_key(self.tables, self.codes), l.on) for l in lookups]

    def join(self, rows: DataFrame, on: Sequence[str], lookups: Sequence[Lookup]) -> DataFrame:
        """The rows with the facts of lookups on the same columns ``on``."""
        parents = [skew.with_key_names(frame, rows, pairs) for frame, pairs in self.reduced(lookups)]
        # Lookups on the same columns are put together first, so the base table is shuffled once for them.
        names = [f"__k{i}" for i in range(len(on))]
        parent = reduce(lambda a, b: a.join(b, names, "full_outer"), parents)
        return skew.join_named(rows, parent, on, "left")


def flag_rows(tables: Tables, one: Pass, codes: Codes | None = None) -> DataFrame:
    """The rows that break at least one rule, with one bit per broken rule in ``__broken``.

    A number holds 63 bits; further rules go on in ``__broken1``, ``__broken2`` and so on.
    """
    codes = codes or {}
    return _tested(tables, one, codes, Parents(tables, codes)).filter(F.col(COUNT) > 0).drop(COUNT)


def _tested(tables: Tables, one: Pass, codes: Codes, parents: Parents) -> DataFrame:
    """All rows with the bits of the rules they break and their number."""
    bit = {r.code: i for i, r in enumerate(one.rules)}
    base = tables[one.entity]
    if one.where is not None:
        base = base.filter(one.where(Scope.of(base, codes)))

    joined: set[str] = set()
    own = [r for r in one.rules if not r.needs]
    rows = base.withColumns({word(w): F.lit(0).cast("long") for w in range(word_count(one.rules))}
                            | {COUNT: F.lit(0)})
    scope = Scope.of(rows, codes)
    settled, known = _settled(one, scope)
    rows = rows.withColumns(_marked(own, bit, scope) | settled)
    done = {r.code for r in own}

    for on, lookups in groupby(one.lookups, key=lambda l: tuple(c for c, _ in l.on)):
        lookups = list(lookups)
        rows = parents.join(rows, on, lookups)
        joined |= {l.name for l in lookups}
        ready = [r for r in one.rules if r.code not in done and set(r.needs) <= joined]
        if ready:
            rows = rows.withColumns(_marked(ready, bit, replace(Scope.of(rows, codes), known=known)))
            done |= {r.code for r in ready}

    left = [r.code for r in one.rules if r.code not in done]
    if left:
        raise ValueError(f"rules {left} need lookups that the pass does not have")
    return rows.drop(*settled)


def _settled(one: Pass, scope: Scope) -> tuple[dict[str, Column], dict[Condition, Column]]:
    """Columns with what the rows themselves decide of rules that need lookups, and how to read each condition from them."""
    # a lookup's columns begin with its name
    names = {l.name for l in one.lookups}
    of_lookups = re.compile(rf"\b({'|'.join(map(re.escape, sorted(names)))})__")
    found: dict[Condition, Column] = {}
    seen: set[Condition] = set()

    def look(condition: Condition) -> None:
        if condition in seen:
            return
        seen.add(condition)
        column = condition(scope)
        if not of_lookups.search(str(column)):
            found[condition] = column
        else:
            for part in condition.parts:
                look(part)

    for rule in one.rules:
        if rule.needs and names.issuperset(rule.needs):
            look(rule.violation)
    columns: dict[str, Column] = {}
    known: dict[Condition, Column] = {}
    for i, (condition, column) in enumerate(found.items()):
        name, at = f"{SETTLED}{2 * i // SETTLED_BITS}", 2 * i % SETTLED_BITS
        # as the test is in it twice, Spark makes a method of it, as of a rule's
        code = true_when(column).cast("long") + column.isNull().cast("long") * 2
        code = F.shiftleft(code, at)
        columns[name] = columns[name].bitwiseOR(code) if name in columns else code
        read = F.shiftright(F.col(name), at).bitwiseAND(F.lit(3))
        known[condition] = F.when(read != 2, read == 1)
    return columns, known


def independent(one: Pass) -> list[Pass]:
    """The pass as several: lookups by different columns stay together only where a rule needs both or one delivers the
    other's key. Rules without lookups go with the first."""
    groups = [list(g) for _, g in groupby(one.lookups, key=lambda l: tuple(c for c, _ in l.on))]
    of = {l.name: i for i, g in enumerate(groups) for l in g}
    label = list(range(len(groups)))

    def join(numbers: set[int]) -> None:
        least = min((label[n] for n in numbers), default=0)
        old = {label[n] for n in numbers}
        label[:] = [least if l in old else l for l in label]

    for r in one.rules:
        join({of[n] for n in r.needs if n in of})
    for i, g in enumerate(groups):
        join({i, *[of[n] for n in of for l in g for c, _ in l.on if c.startswith(f"{n}__")]})
    parts = []
    for least in sorted(set(label)):
        lookups = tuple(l for i, g in enumerate(groups) if label[i] == least for l in g)
        names = {l.name for l in lookups}
        # a rule that needs an unknown lookup stays with the first, which tells so
        rules = tuple(r for r in one.rules if names & set(r.needs) or (least == 0 and not set(r.needs) & of.keys()))
        if rules:
            parts.append(replace(one, rules=rules, lookups=lookups))
    return parts or [one]


def word(number: int) -> str:
    return f"{BROKEN}{number or ''}"


def word_count(rules: Sequence[Rule]) -> int:
    return max(1, -(-len(rules) // WORD_BITS))


def violations(tables: Tables, one: Pass, entity: str, period: str, codes: Codes | None = None,
               parents: Parents | None = None) -> DataFrame:
    """Long form: one row per broken rule and row of the base table."""
    codes = codes or {}
    return reduce(DataFrame.union, [_listed(tables, part, entity, period, codes, parents or Parents(tables, codes))
                                    for part in independent(one)])


def _listed(tables: Tables, one: Pass, entity: str, period: str, codes: Codes, parents: Parents) -> DataFrame:
    rows = _tested(tables, one, codes, parents)
    names = F.array(*[F.lit(r.code) for r in one.rules])
    source = F.col("src_stm") if "src_stm" in rows.columns else F.lit(None).cast("string")
    words = word_count(one.rules)
    # a filter here would move below the tests and repeat them; rows that break no rule have nothing to list
    listed = rows.select(
        key_text(one.key).alias("key"), source.alias("src_stm"), *[word(w) for w in range(words)],
        F.posexplode(F.when(F.col(COUNT) > 0, names)).alias("__number", "rule"))
    number = F.col("__number")
    held = reduce(lambda rest, w: F.when(number < (w + 1) * WORD_BITS, F.col(word(w))).otherwise(rest),
                  reversed(range(words - 1)), F.col(word(words - 1)))
    broken = F.expr(f"shiftright(`__held`, __number % {WORD_BITS}) & 1 = 1")
    return listed.withColumn("__held", held).filter(broken).select(
        F.lit(entity).alias("entity"), F.lit(period).alias("msr_prd_id"), "rule", "key", "src_stm")


def with_views(tables: Tables, ruleset: RuleSet, codes: Codes | None = None) -> dict[str, DataFrame]:
    """The tables and the views of a rule set that are not among them yet."""
    tables = dict(tables)
    for view in ruleset.views:
        if view.name not in tables:
            tables[view.name] = view.build(tables, codes or {})
    return tables


def evaluate(tables: Tables, ruleset: RuleSet, period: str, codes: Codes | None = None,
             parents: Parents | None = None) -> DataFrame:
    """All violations of a rule set, one long table. ``parents`` has the facts of looked-up entities if they
    are stored already."""
    tables = with_views(tables, ruleset, codes)
    parts = [violations(tables, p, ruleset.entity, period, codes, parents) for p in ruleset.passes]
    for r in ruleset.reconciliations:
        failed = r.differences(tables, codes or {}).filter(~F.col("ok"))
        parts.append(failed.select(
            F.lit(ruleset.entity).alias("entity"),
            F.lit(period).alias("msr_prd_id"),
            "rule",
            key_text(r.by).alias("key"),
            F.lit(None).cast("string").alias("src_stm"),
        ))
    return reduce(DataFrame.unionByName, parts)


def key_text(columns: Sequence[str]) -> Column:
    """Key columns as one text, NULL parts as empty text; in a key of several parts, a bar or backslash
    inside a part has a backslash before it, so different keys never read alike."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    if len(parts) == 1:
        return parts[0]
    return F.concat_ws("|", *[F.regexp_replace(p, r"([|\\])", r"\\$1") for p in parts])


def _marked(rules: Sequence[Rule], bit: Mapping[str, int], scope: Scope) -> dict[str, Column]:
    """The columns of bits and their number after some more rules."""
    tests = [(bit[r.code], r.broken(scope)) for r in rules]
    marked = {}
    for number, test in tests:
        name = word(number // WORD_BITS)
        marked[name] = marked.get(name, F.col(name)).bitwiseOR(F.shiftleft(test.cast("long"), number % WORD_BITS))
    if tests:
        marked[COUNT] = reduce(lambda total, t: total + t[1].cast("int"), tests, F.col(COUNT))
    return marked
