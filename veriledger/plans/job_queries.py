"""Whole jobs as queries: a job stores, checks and exports in a database of its own under the shared folder,
and what it left there is the result. The database is dropped once the result is written aside."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriledger.operators import conditions as c
from veriledger.operators import families as f
from veriledger.plans import rerun
from veriledger.plans.catalogue_queries import entities
from veriledger.plans.catalogue_sql import CATALOGUE_SQL, bl, with_entities
from veriledger.plans.derived import ENTITY_SQL
from veriledger.plans.jobs import JOBS
from veriledger.plans.run import Setting, run_job
from veriledger.sources.shared import remove_folder, shared_folder
from veriledger.specs.codes import sample_codes

PERIOD = "20240131"
MOMENT = datetime(2024, 2, 1)


def _aside(spark: SparkSession, frames: dict[str, DataFrame], work: Callable[[Setting], DataFrame]) -> DataFrame:
    """What `work` gives, written aside; the database it worked in is gone."""
    folder, kept = shared_folder(spark, "job"), shared_folder(spark, "result")
    database = f"job_{uuid.uuid4().hex}"
    spark.sql(f"create database {database} location '{folder}/tables'")
    try:
        found = work(Setting(spark, folder, "run1", MOMENT, database, codes=sample_codes(), frames=frames))
        found.write.parquet(kept)
        return spark.read.schema(found.schema).parquet(kept)
    finally:
        spark.sql(f"drop database {database} cascade")
        remove_folder(spark, folder)


def job_dependents(spark: SparkSession, sf: str) -> DataFrame:
    """The tables that a job fills from the entity it stored."""
    frames = entities(spark, sf, ["DER_CPEN", "DER_CPID"])
    job = JOBS["p1_monthly_cpen"]

    def work(setting: Setting) -> DataFrame:
        run_job(setting, job, PERIOD, frames["DER_CPEN"])
        rows = None
        for name, key in job.dependents.items():
            own = spark.table(setting.table(job.table(name))).select(
                F.lit(name).alias("dependent"), "ent_id",
                (F.col("cntpr_id") if "cntpr_id" in key else F.lit(None).cast("string")).alias("cntpr_id"))
            rows = own if rows is None else rows.union(own)
        return rows

    return _aside(spark, {"DER_CPID": frames["DER_CPID"]}, work)


def job_export_without_rules(spark: SparkSession, sf: str) -> DataFrame:
    """The report of a job that has no rules, read back."""
    rows = entities(spark, sf, ["DER_PRT"])["DER_PRT"]

    def work(setting: Setting) -> DataFrame:
        report = run_job(setting, JOBS["p1_monthly_prt"], PERIOD, rows).report
        return spark.read.csv(report, header=True).select(F.col("`Portfolio Id`").alias("portfolio_id"))

    return _aside(spark, {}, work)


def job_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """The violations that a repeated run of a job stores; the run before it leaves no trace in them."""
    job = JOBS["rerun_daily_cpid"]
    frames = entities(spark, sf, sorted({*job.rules.reads, "DER_CPID"}))
    parents = {n: f for n, f in frames.items() if n != "DER_CPID"}

    def work(setting: Setting) -> DataFrame:
        for _ in range(2):
            run_job(setting, job, PERIOD, frames["DER_CPID"])
        path = f"{setting.folder}/violations/{job.name}/{PERIOD}/{setting.run_id}"
        return spark.read.parquet(path).select("rule", "key")

    return _aside(spark, parents, work)


def job_incremental_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """The violations of account details after a re-run that checks only what changed: rows that are new, gone or
    different, and rows whose account or credit line is."""
    job = JOBS["monthly_cacd"]
    now = entities(spark, sf, job.rules.reads)
    line, account = F.xxhash64("ac_id", "open_date", "notional_oc"), F.xxhash64("ac_id")
    before = {
        **now,
        "DER_CACD": now["DER_CACD"].filter(F.pmod(line, F.lit(50)) != 0).withColumn(
            "regulated_product", F.when(F.pmod(line, F.lit(50)) == 1, "other").otherwise(F.col("regulated_product"))),
        "DER_CAC": now["DER_CAC"].filter(F.pmod(account, F.lit(40)) != 3).withColumn(
            "loan_type", F.when(F.pmod(account, F.lit(40)) == 5, "other").otherwise(F.col("loan_type"))),
        "DER_CL": now["DER_CL"].union(now["DER_CL"].withColumn("credit_line_id", F.lit("gone")).limit(1)),
    }

    def work(setting: Setting) -> DataFrame:
        rerun.check(replace(setting, run_id="first", frames=before), job, PERIOD)
        return rerun.check(replace(setting, run_id="second", frames=now), job, PERIOD, "first").violations.select("rule", "key")

    return _aside(spark, now, work)


def counts_while_writing(spark: SparkSession, sf: str) -> DataFrame:
    """The violations of every rule of a job, counted by the write that stores them, and the rows that break rules
    at loading, counted by the write that takes the source's rows."""
    job = JOBS["daily_cac"]
    frames = entities(spark, sf, sorted({*job.rules.reads, "DER_CAC"}))
    parents = {n: f for n, f in frames.items() if n != "DER_CAC"}
    early = [f.within("EARLY1", "contract_amount_oc", c.at_least("contract_amount_oc", 0)),
             f.required_if("EARLY2", c.always(), "term_type")]

    def work(setting: Setting) -> DataFrame:
        result = run_job(setting, job, PERIOD, frames["DER_CAC"], early)
        counts = {**result.prevalidation, **result.counts}  # a number a rule
        return spark.createDataFrame(list(counts.items()), "rule string, n long")

    return _aside(spark, parents, work)


QUERIES = {q.__name__: q for q in (job_dependents, job_export_without_rules, job_rerun, job_incremental_rerun,
                                   counts_while_writing)}

_MEMBERS = {"cpen": ENTITY_SQL["DER_CPEN"]}
JOB_SQL = {
    "job_dependents": with_entities(_MEMBERS, """
select 'MAS_ENT' as dependent, ent_id, cast(null as varchar) as cntpr_id from (select distinct ent_id from cpen)
union all select 'STG_ENT', ent_id, null from (select distinct ent_id from cpen)
union all select 'MAS_ENT_DTL', ent_id, cntpr_id from (select distinct ent_id, cntpr_id from cpen)
union all select 'STG_ENT_DTL', ent_id, cntpr_id from (select distinct ent_id, cntpr_id from cpen)"""),
    "job_export_without_rules": with_entities({"prt": ENTITY_SQL["DER_PRT"]}, "select portfolio_id from prt"),
    "job_incremental_rerun": CATALOGUE_SQL["rules_account_detail"],
    "counts_while_writing": with_entities({"cac": ENTITY_SQL["DER_CAC"]}, f"""
select 'EARLY1' as rule, count(*) as n from cac where contract_amount_oc < 0
union all select 'EARLY2', count(*) from cac where {bl("term_type")}
union all select c.rule, count(v.rule) from (select unnest({JOBS["daily_cac"].rules.codes}) as rule) c
  left join ({CATALOGUE_SQL["rules_credit_account"]}) v on v.rule = c.rule group by c.rule"""),
    "job_rerun": f"select rule, key from ({CATALOGUE_SQL['rules_counterparty_id']}) where rule <> 'CMCPID003'",
}
