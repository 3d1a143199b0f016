"""Run a job for a period: load, reshape, store, validate, export, advance.

Each stage is lazy up to its write. The stored table and the stored violations are the only points
where rows are materialised, so later stages restart from files and not from the sources.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriledger.functions.periods import advance, data_date, load_time
from veriledger.operators import facts, observed, prevalidate, reshape, ruleset
from veriledger.operators.families import Rule
from veriledger.plans import jobs as j
from veriledger.plans.jobs import Job
from veriledger.sources import files, keyindex, ordered, publish, tables
from veriledger.specs.entities import ENTITIES, report_names

# Template row of the report that is delivered without data.
EMPTY_REPORT_DATE = datetime(2020, 5, 17).date()

VIOLATION_SCHEMA = T.StructType([
    T.StructField(n, T.StringType())
    for n in ("entity", "rule", "key", "src_stm", "run_id", "msr_prd_id")
])


@dataclass(frozen=True)
class Setting:
    """Where a run reads and writes, and for whom. ``frames`` stand in for catalog tables by entity name."""

    spark: SparkSession
    folder: str
    run_id: str
    moment: datetime
    database: str = "default"
    organization: str | None = None
    codes: Mapping[str, Sequence[str]] = field(default_factory=dict)
    frames: Mapping[str, DataFrame] = field(default_factory=dict)

    def table(self, name: str) -> str:
        return f"{self.database}.{name.lower()}"


@dataclass(frozen=True)
class Result:
    """``counts`` has every rule of the job. The period moves on only after a passed gate."""

    passed: bool
    counts: Mapping[str, int]
    report: str | None
    next_period: str
    prevalidation: Mapping[str, int] = field(default_factory=dict)


def run_job(setting: Setting, job: Job, period: str, source: DataFrame | None = None,
            prevalidation: Sequence[Rule] = ()) -> Result:
    bad: dict[str, int] = {}
    rows = source
    if j.LOAD in job.stages and rows is not None and prevalidation:
        rows, bad = _prevalidated(setting, job, period, rows, prevalidation)
    if j.APPLY in job.stages and rows is not None:
        store(setting, job, period, reshaped(setting, job, period, rows))

    counts: dict[str, int] = {}
    if j.VALIDATE in job.stages and job.rules is not None:
        counts = validate(setting, job, period)
    passed = not any(counts.values())

    path = None
    if j.EXPORT in job.stages and (passed or job.exports_when_failed):
        path = export(setting, job, period)
    moves = passed and job.step != j.NO_STEP
    following = advance(period, job.step or job.cadence) if moves else period
    return Result(passed, counts, path, following, bad)


def _prevalidated(setting: Setting, job: Job, period: str, rows: DataFrame,
                  rules: Sequence[Rule]) -> tuple[DataFrame, dict[str, int]]:
    """Count and store the rows that break a rule; all rows go on, without the flags.

    The source is read once: its rows are written aside with their flags, which that write counts.
    """
    names = [r.code for r in rules]
    flagged = prevalidate.add_flags(rows, rules, setting.codes)
    aside = f"{setting.folder}/loaded/{job.name}/{period}/{setting.run_id}"
    bad = observed.write_parquet(flagged, aside, {n: F.count_if(F.col(n)) for n in names})
    flagged = setting.spark.read.schema(flagged.schema).parquet(aside)
    if any(bad.values()):
        failed = prevalidate.failures(flagged, names, job.target.key)
        by = ("rule", "src_stm") if job.prevalidation == "multiple" else ("rule",)
        files.write_violations(failed, f"{setting.folder}/prevalidation/{job.name}/{period}",
                               setting.run_id, by)
    return prevalidate.base_columns(flagged, rules), bad


def reshaped(setting: Setting, job: Job, period: str, rows: DataFrame) -> DataFrame:
    """Columns of the target table: spaces cleared, constants and fillers set, types cast."""
    if job.clear:
        rows = reshape.clear_spaces(rows, job.clear)
    constants = {"msr_prd_id": period, "ppn_tm": load_time(setting.moment), **job.constants}
    rows = reshape.with_constants(rows, constants)
    if job.stamped:
        constants = {"data_dt": data_date(period, job.cadence)}
        if setting.organization is not None:
            constants["org_id"] = setting.organization
        rows = reshape.with_constants(rows, constants)
    rows = tables.align(rows, job.target.schema)
    return reshape.fill_missing(rows, job.fill) if job.fill else rows


def store(setting: Setting, job: Job, period: str, rows: DataFrame) -> None:
    """Replace the period in the entity's table, then fill the tables that depend on it."""
    spark = setting.spark
    table = setting.table(job.table(job.entity))
    tables.create_table(spark, table, job.target.schema)
    if job.set_from is not None:
        mapping, column, key = job.set_from
        other = _frame(setting, job, mapping, period).filter(F.col(key).isNotNull())
        rows = reshape.set_from(rows, other, [(key, key)], {column: column})
    if job.new_only:
        # other periods only: the period itself is replaced, so a second run stores the same rows
        keyindex.append_new(rows, table, job.target.key, period)
    elif job.dependents:
        _store_together(setting, job, period, table, rows)
    else:
        tables.replace_period(rows, table, period)


def _store_together(setting: Setting, job: Job, period: str, table: str, rows: DataFrame) -> None:
    """The entity and the tables that depend on it: all are written before readers see any of them."""
    spark = setting.spark
    release = publish.Release(spark, f"{setting.folder}/releases")
    try:
        stored = release.stage(table, period, rows)
        for name, key in job.dependents.items():
            schema = ENTITIES[name].schema
            dependent = setting.table(job.table(name))
            tables.create_table(spark, dependent, schema)
            own = stored.select("org_id", "data_dt", *key).distinct()
            release.stage(dependent, period, reshape.with_constants(own, {"ppn_tm": load_time(setting.moment)}))
        release.publish()
    except Exception:
        release.drop()
        raise


def shared_parents(setting: Setting, jobs: Sequence[Job], period: str) -> facts.SharedParents:
    """What the rules of several jobs look up, reduced once for all of them and stored in the run's folder.

    Jobs that read an entity from tables of their own have facts of their own; jobs that read the same table
    share them, and its period is read once for each key. Views of one name are built once.
    """
    jobs = [job for job in jobs if job.rules is not None]
    frames: dict[str, DataFrame] = {}
    for job in jobs:
        own = {e: _frame(setting, job, e, period) for e in job.rules.reads}
        with_views = ruleset.with_views(own, job.rules, setting.codes)
        for entity, frame in with_views.items():
            frames.setdefault(_source(setting, job, entity), frame)
    places = facts.plan((job.rules, partial(_source, setting, job)) for job in jobs)
    stored = {}
    for place, one in places.items():
        path = f"{setting.folder}/facts/{'-'.join([place[0], *place[1]])}/{period}/{setting.run_id}"
        rows = one.built(frames[place[0]], setting.codes)
        rows.write.mode("overwrite").parquet(path)
        stored[place] = setting.spark.read.schema(rows.schema).parquet(path)
    return facts.SharedParents(frames, setting.codes, places, stored)


def validate_all(setting: Setting, jobs: Sequence[Job], period: str) -> dict[str, dict[str, int]]:
    """The checks of several jobs whose tables are stored, over parents that are reduced once."""
    parents = shared_parents(setting, jobs, period)
    return {job.name: validate(setting, job, period, parents) for job in jobs if job.rules is not None}


def validate(setting: Setting, job: Job, period: str, parents: facts.SharedParents | None = None) -> dict[str, int]:
    """Store the violations of the run and count them per rule."""
    spark = setting.spark
    frames = {e: _frame(setting, job, e, period) for e in job.rules.reads}
    if parents is not None:
        parents = replace(parents, source=partial(_source, setting, job))
    broken = ruleset.evaluate(frames, job.rules, period, setting.codes, parents)
    path = f"{setting.folder}/violations/{job.name}/{period}/{setting.run_id}"
    broken = broken.select(*[c for c in VIOLATION_SCHEMA.names if c != "run_id"])
    # violations are few and lie in many tasks: gather them, so that they become few files
    counts = observed.write_parquet(broken.hint("rebalance", F.col("key")), path, observed.by_value("rule", job.rules.codes))
    stored = spark.read.schema(VIOLATION_SCHEMA).parquet(path)
    if any(counts.values()):
        files.write_violations(stored.drop("run_id"), f"{setting.folder}/failed/{job.name}",
                               setting.run_id)
    return counts


def export(setting: Setting, job: Job, period: str) -> str:
    """The report of the period, or the template row of a report without data."""
    names = report_names(job.target)
    if job.input == j.NOTHING:
        schema = T.StructType([
            T.StructField(c, T.DateType() if c == "data_dt" else T.StringType())
            for c in names.values()])
        row = [EMPTY_REPORT_DATE if c == "data_dt" else None for c in names.values()]
        rows = files.empty_report(setting.spark, schema, row)
    else:
        rows = tables.read_period(setting.spark, setting.table(job.table(job.entity)), period)
        return ordered.export_ordered(rows, f"{setting.folder}/reports/{job.name}", period, names, job.target.key)
    return files.export_report(rows, f"{setting.folder}/reports/{job.name}", period, names)


def _frame(setting: Setting, job: Job, entity: str, period: str) -> DataFrame:
    """Rows the rules of a period see: the period's, or all up to it for entities stored once."""
    if entity in setting.frames:
        return setting.frames[entity]
    read = tables.read_until if ENTITIES[entity].once else tables.read_period
    return read(setting.spark, _source(setting, job, entity), period)


def _source(setting: Setting, job: Job, entity: str) -> str:
    """The stored table that a job reads an entity from; a view or a given frame has its own name, and a view
    over tables of the job's line is that line's."""
    if entity in setting.frames:
        return entity
    if entity not in ENTITIES:
        return f"{job.line}{job.cadence}_{entity}"
    names = [setting.table(n) for n in job.sources(entity)]
    return next((n for n in names if setting.spark.catalog.tableExists(n)), names[0])
