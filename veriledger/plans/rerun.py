"""Checks run again where something changed.

A check leaves its state: the violations, a digest of the base rows of every key, and the facts its rules looked up. The
next check of the same job and period compares. Rules are run again for the keys whose rows are new or changed, and
for those that look up a parent whose facts changed; the other keys keep their violations. As a rule sees nothing but
its row and the facts it looks up, the outcome is that of a whole run. Balances compare sums and are always
taken anew.

Digests are compared by key with hot keys split. Of rows and violations that did not change, only those are shuffled that
a filter of the changed keys cannot tell from changed ones (:mod:`veriledger.operators.sieve`).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriledger.operators import facts, observed
from veriledger.operators.ruleset import Pass, RuleSet, evaluate, key_text, with_views
from veriledger.operators.sieve import Sieve
from veriledger.operators.skew import join_parent
from veriledger.plans.jobs import Job
from veriledger.plans.run import VIOLATION_SCHEMA, Setting, _frame, _source, shared_parents

#: What a load stamps on a row without changing it.
STAMPS = ("ppn_tm",)


@dataclass(frozen=True)
class Checked:
    """``checked`` rows of the base tables went through the rules, of ``rows`` they have; ``violations`` are all that hold now."""

    counts: Mapping[str, int]
    checked: int
    rows: int
    violations: DataFrame


def digests(rows: DataFrame, one: Pass) -> DataFrame:
    """Per key of a pass how many rows it has and a sum of their hashes, so rows may repeat a key."""
    cells = [F.col(f"`{c}`") for c in rows.columns if c not in STAMPS]
    return rows.select(key_text(one.key).alias("key"), F.xxhash64(*cells).alias("hash")).groupBy("key").agg(
        F.count("*").alias("n"), F.sum(F.col("hash").cast("decimal(38,0)")).alias("digest"))


def changed(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose other columns differ, or that only one side has."""
    def side(df: DataFrame, name: str) -> DataFrame:
        rest = [c for c in df.columns if c not in keys]
        held = F.struct(*rest) if rest else F.lit(True)
        return df.select(*keys, held.alias(name))

    pairs = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    both = side(new, "new").alias("a").join(side(old, "old").alias("b"), reduce(lambda x, y: x & y, pairs), "full_outer")
    return both.filter(~F.col("new").eqNullSafe(F.col("old"))).select(
        *[F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in keys])


def check(setting: Setting, job: Job, period: str, before: str | None = None) -> Checked:
    """Checks a job and leaves its state under the run's id. ``before`` is the run whose state is compared with; without
    one everything is checked."""
    spark, rules = setting.spark, job.rules
    state = f"{setting.folder}/state/{job.name}/{period}"
    parents = replace(shared_parents(setting, [job], period), source=partial(_source, setting, job))
    tables = with_views({e: _frame(setting, job, e, period) for e in rules.reads}, rules, setting.codes)
    for number, one in enumerate(rules.passes):
        digests(tables[one.entity], one).write.mode("overwrite").parquet(f"{state}/{setting.run_id}/rows-{number}")

    total = sum(tables[one.entity].count() for one in rules.passes)
    if before is None:
        found, checked_rows = evaluate(tables, rules, period, setting.codes, parents), total
    else:
        parts, checked_rows = [], 0
        kept = spark.read.schema(VIOLATION_SCHEMA).parquet(f"{state}/{before}/violations")
        for number, one in enumerate(rules.passes):
            keys = _keys_to_check(setting, job, period, before, parents, tables, number)
            keys.write.mode("overwrite").parquet(f"{state}/{setting.run_id}/keys-{number}")
            keys = spark.read.schema(keys.schema).parquet(f"{state}/{setting.run_id}/keys-{number}")
            base = tables[one.entity].withColumn("__key", key_text(one.key))
            sieve = Sieve.of(keys, base, [("__key", "key")], f"{state}/{setting.run_id}/sieve-{number}")
            rows = join_parent(sieve.parted(base)[0], keys, [("__key", "key")], "left_semi").drop("__key")
            path = f"{state}/{setting.run_id}/checked-{number}"
            checked_rows += observed.write_parquet(rows, path, {"rows": observed.rows()})["rows"]
            rows = spark.read.schema(rows.schema).parquet(path)
            parts.append(evaluate({**tables, one.entity: rows}, RuleSet(rules.entity, (one,)), period, setting.codes, parents))
            own = kept.filter(F.col("rule").isin([r.code for r in one.rules]))
            sieve = replace(sieve, columns=("key",))
            may, cannot = sieve.parted(own)
            parts += [cannot, join_parent(may, keys, [("key", "key")], "left_anti")]
        if rules.reconciliations:
            balances = RuleSet(rules.entity, (), rules.reconciliations, rules.views)
            parts.append(evaluate(tables, balances, period, setting.codes, parents))
        columns = ["entity", "msr_prd_id", "rule", "key", "src_stm"]
        found = reduce(DataFrame.union, [p.select(*columns) for p in parts])

    path = f"{state}/{setting.run_id}/violations"
    found = found.withColumn("run_id", F.lit(setting.run_id)).select(*VIOLATION_SCHEMA.names)
    counts = observed.write_parquet(found.hint("rebalance", F.col("key")), path, observed.by_value("rule", rules.codes))
    return Checked(counts, checked_rows, total, spark.read.schema(VIOLATION_SCHEMA).parquet(path))


def _keys_to_check(setting: Setting, job: Job, period: str, before: str, parents: facts.SharedParents,
                   tables: Mapping[str, DataFrame], number: int) -> DataFrame:
    """Keys of a pass whose rows or looked-up facts are not as they were."""
    spark, one = setting.spark, job.rules.passes[number]
    state = f"{setting.folder}/state/{job.name}/{period}"
    now, old = (spark.read.parquet(f"{state}/{run}/rows-{number}") for run in (setting.run_id, before))
    keys = [changed(now, old, ["key"])]
    base = tables[one.entity].withColumn("__key", key_text(one.key))
    for on in dict.fromkeys((l.entity, l.on) for l in one.lookups):
        entity, pairs = on
        place = (parents.source(entity), tuple(p for _, p in pairs))
        facts_now = parents.stored[place]
        facts_old = spark.read.schema(facts_now.schema).parquet(
            f"{setting.folder}/facts/{'-'.join([place[0], *place[1]])}/{period}/{before}")
        aside = f"{state}/{setting.run_id}/moved-{number}-{'-'.join([place[0], *place[1], *(c for c, _ in pairs)])}"
        moved = changed(facts_now, facts_old, list(place[1]))
        moved.write.mode("overwrite").parquet(aside)
        moved = spark.read.schema(moved.schema).parquet(aside)
        may, _ = Sieve.of(moved, base, list(pairs), f"{aside}-sieve").parted(base)
        hit = join_parent(may, moved, list(pairs), "left_semi")
        keys.append(hit.select(F.col("__key").alias("key")))
    return reduce(DataFrame.union, keys).distinct()
