"""What the rule sets of a period look up, reduced once and stored.

Many rule sets look the same parents up. A plan merges the lookups of all of them: per entity and key there is one
table of facts, one row per key, and equal facts of different lookups are one column. The parent is read
and shuffled once for it; every rule set then joins the stored table, which has as many rows as keys and only the
columns that rules ask for. A rule set finds the same facts as if it had reduced the parents itself.

Where a table was laid out by the key (:mod:`veriledger.sources.layout`), the facts are laid out alike and the join
needs no exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriledger.operators import skew
from veriledger.operators.conditions import Condition, Scope
from veriledger.operators.ruleset import Codes, Fact, Lookup, Parents, RuleSet, Tables
from veriledger.sources.layout import PART, Layout, dealt, layout_of, merged, replicated

#: Which stored table: the entity's source and the parent's key columns.
Place = tuple[str, tuple[str, ...]]


@dataclass
class FactTable:
    """The facts of one parent by one key. ``columns`` names the column of a fact under a condition."""

    source: str
    keys: tuple[str, ...]
    columns: dict[tuple[str, Condition | str | None, Condition | None], str] = field(default_factory=dict)

    def add(self, lookup: Lookup) -> None:
        if lookup.where is not None:
            self._column("found", None, lookup.where)
        for fact in lookup.facts:
            self._column(fact.aggregate, fact.of, lookup.where, fact.name)

    def _column(self, aggregate: str, of: Condition | str | None, where: Condition | None, name: str = "") -> None:
        number = len(self.columns)
        self.columns.setdefault((aggregate, of, where), f"{name or aggregate}_{number}")

    def built(self, parent: DataFrame, codes: Codes) -> DataFrame:
        """One row per key of the parent."""
        scope = Scope.of(parent, codes)
        made = []
        for (aggregate, of, where), name in self.columns.items():
            if of is None:
                column = F.bool_or(where(scope))
            elif where is None:
                column = Fact(name, aggregate, of).column(scope)
            else:
                # as if the rows without the condition had been filtered: aggregates pass over NULL
                value = F.col(of) if isinstance(of, str) else of(scope)
                column = getattr(F, aggregate)(F.when(where(scope), value))
            made.append(column.alias(name))
        return parent.groupBy(*self.keys).agg(*made) if made else parent.select(*self.keys).distinct()

    def answers(self, lookup: Lookup) -> dict[str, str]:
        """The columns that a lookup's names stand for."""
        found = self.columns[("found", None, lookup.where)] if lookup.where is not None else None
        named = {f"{lookup.name}__{f.name}": self.columns[(f.aggregate, f.of, lookup.where)] for f in lookup.facts}
        return {f"{lookup.name}__found": f"nullif({found}, false)" if found else "true", **named}


def lookups_of(rules: RuleSet) -> list[Lookup]:
    return [l for p in rules.passes for l in p.lookups]


def plan(rule_sets: Iterable[tuple[RuleSet, Callable[[str], str]]]) -> dict[Place, FactTable]:
    """The fact tables that rule sets need. Each comes with the source that an entity has for it, as jobs may
    read an entity from tables of their own."""
    places: dict[Place, FactTable] = {}
    for rules, source in rule_sets:
        for lookup in lookups_of(rules):
            place = (source(lookup.entity), tuple(p for _, p in lookup.on))
            places.setdefault(place, FactTable(*place)).add(lookup)
    return places


@dataclass(frozen=True)
class SharedParents(Parents):
    """Parents whose facts are stored, with ``source`` naming an entity's table in them.

    ``layouts`` has the layout of the fact tables that are laid out for a join without exchange.
    """

    places: Mapping[Place, FactTable] = field(default_factory=dict)
    stored: Mapping[Place, DataFrame] = field(default_factory=dict)
    layouts: Mapping[Place, Layout] = field(default_factory=dict)
    source: Callable[[str], str] = str

    def _place(self, lookup: Lookup) -> Place:
        return self.source(lookup.entity), tuple(p for _, p in lookup.on)

    def reduced(self, lookups: Sequence[Lookup]) -> list[tuple[DataFrame, Sequence[tuple[str, str]]]]:
        """A frame per fact table: lookups of one parent by one key share it."""
        frames = []
        for place in dict.fromkeys(self._place(l) for l in lookups):
            own = [l for l in lookups if self._place(l) == place]
            answers = {}
            for lookup in own:
                answers |= self.places[place].answers(lookup)
            frame = self.stored[place]
            kept = [*place[1], *([PART] if PART in frame.columns else [])]
            frames.append((frame.select(*kept, *[F.expr(e).alias(n) for n, e in answers.items()]), own[0].on))
        return frames

    def join(self, rows: DataFrame, on: Sequence[str], lookups: Sequence[Lookup]) -> DataFrame:
        layouts = {self.layouts.get(self._place(l)) for l in lookups}
        if len(on) == 1 and PART in rows.columns and len(layouts) == 1 and None not in layouts:
            layout = layouts.pop()
            parents = self.reduced(lookups)
            types = {f.schema[pairs[0][1]].dataType for f, pairs in parents} | {rows.schema[on[0]].dataType}
            if layout.key == on[0] and len(types) == 1:
                # Same buckets on both sides, hot keys in as many parts on either: nothing is exchanged.
                for f, pairs in parents:
                    parent = f.withColumnsRenamed({pairs[0][1]: "__k0", PART: "__p"})
                    rows = rows.join(parent, (F.col(on[0]) == F.col("__k0")) & (F.col(PART) == F.col("__p")),
                                     "left").drop("__k0", "__p")
                return rows
        parents = [(f.filter(F.col(PART) == 0).drop(PART) if PART in f.columns else f, pairs)
                   for f, pairs in self.reduced(lookups)]
        named = [skew.with_key_names(f, rows, pairs) for f, pairs in parents]
        names = [f"__k{i}" for i in range(len(on))]
        return skew.join_named(rows, reduce(lambda a, b: a.join(b, names, "full_outer"), named), on, "left")


def share(tables: Tables, codes: Codes, rule_sets: Iterable[RuleSet],
          store: Callable[[Place, DataFrame], DataFrame]) -> SharedParents:
    """Builds the facts that rule sets over the same tables need. ``store`` writes a fact table and gives it back.

    ``tables`` has the entities and the views that the rule sets name.
    """
    places = plan((rules, str) for rules in rule_sets)
    stored = {place: store(place, facts.built(tables[place[0]], codes)) for place, facts in places.items()}
    return SharedParents(tables, codes, places, stored)


def laid_out(tables: Tables, codes: Codes, rule_sets: Sequence[RuleSet], key: str, buckets: int,
             bucketed: Callable[[str, DataFrame, str, Layout], DataFrame],
             store: Callable[[Place, DataFrame], DataFrame]) -> tuple[dict[str, DataFrame], SharedParents]:
    """The tables and parents of rule sets, laid out by one column of the base tables, say the account.

    All base tables that have the column, and the facts that rules look up by it, get one common layout, so facts are
    stored once for all rule sets. Lookups by other columns keep plain facts, which ``store`` writes; ``bucketed`` writes a table
    of a layout.
    """
    bases = dict.fromkeys(p.entity for rules in rule_sets for p in rules.passes if key in tables[p.entity].columns)
    if not bases:
        return dict(tables), share(tables, codes, rule_sets, store)
    layout = merged([layout_of(tables[b], key, buckets) for b in bases])
    looked_up = {(l.entity, (l.on[0][1],)) for rules in rule_sets for l in lookups_of(rules)
                 if len(l.on) == 1 and l.on[0][0] == key}

    def stored(place: Place, facts: DataFrame) -> DataFrame:
        if place not in looked_up:
            return store(place, facts)
        return bucketed(f"facts_{place[0]}_{place[1][0]}", replicated(facts, place[1][0], layout), place[1][0], layout)

    parents = share(tables, codes, rule_sets, stored)
    laid = {b: bucketed(b, dealt(tables[b], layout), key, layout) for b in bases}
    return {**tables, **laid}, replace(parents, layouts=dict.fromkeys(looked_up, layout))
