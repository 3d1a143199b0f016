"""Rule sets of the catalogue, run over entities derived from the benchmark tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriledger.operators.ruleset import RuleSet, evaluate
from veriledger.plans.acceptance import table
from veriledger.plans.derived import BASE_TABLES, ENTITY_SQL
from veriledger.specs import account, collateral, counterparty, credit_line, outstanding, review
from veriledger.specs.codes import sample_codes

PERIOD = "20240131"


def entities(spark, sf_dir: str, names, more: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """The derived entities by name; ``more`` adds to those of the catalogue."""
    known = {**ENTITY_SQL, **(more or {})}
    texts = {n: known[n] for n in names}
    sources = {t: table(spark, sf_dir, t) for t in BASE_TABLES
               if any(f"{{{t}}}" in text for text in texts.values())}
    return {n: spark.sql(text, **{t: df for t, df in sources.items() if f"{{{t}}}" in text})
            for n, text in texts.items()}


def violations_of(spark, sf_dir: str, rules: RuleSet, more: Mapping[str, str] | None = None) -> DataFrame:
    tables = entities(spark, sf_dir, rules.reads, more)
    return evaluate(tables, rules, PERIOD, sample_codes()).select("rule", "key")


def rules_credit_account(spark, sf):
    return violations_of(spark, sf, account.CAC_DAILY)


def rules_account_detail(spark, sf):
    return violations_of(spark, sf, account.CACD_MONTHLY)


def rules_counterparty_id(spark, sf):
    return violations_of(spark, sf, counterparty.CPID_DAILY)


def rules_credit_line(spark, sf):
    return violations_of(spark, sf, credit_line.CL_MONTHLY)


def rules_outstanding_daily(spark, sf):
    return violations_of(spark, sf, outstanding.OTDD_DAILY)


def rules_related_loan(spark, sf):
    return violations_of(spark, sf, outstanding.RLI_DAILY)


def rules_risk(spark, sf):
    return violations_of(spark, sf, review.RSK_P1)


def rules_building(spark, sf):
    return violations_of(spark, sf, collateral.BLD_P1)


def reconcile_ledgers(spark, sf):
    """The six balances of the monthly outstanding against balance sheet and provisions."""
    tables = entities(spark, sf, ["DER_OTDM", "DS_BLS", "DS_PVS"])
    for view in outstanding.OTDM_P1.views:
        tables[view.name] = view.build(tables, {})
    differences = outstanding.OTDM_BALANCES.differences(tables, {})
    return differences.withColumn("data_dt", F.col("data_dt").cast("string"))


QUERIES = {q.__name__: q for q in [
    rules_credit_account, rules_account_detail, rules_counterparty_id, rules_credit_line,
    rules_outstanding_daily, rules_related_loan, rules_risk, rules_building, reconcile_ledgers,
]}
