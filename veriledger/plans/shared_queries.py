"""Several rule sets over facts that are reduced once, and over tables laid out by their key, as queries."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriledger.operators import facts
from veriledger.operators.facts import Place, SharedParents
from veriledger.operators.ruleset import evaluate, with_views
from veriledger.plans import account_queries, catalogue_sql
from veriledger.plans.catalogue_queries import PERIOD, entities
from veriledger.sources import layout
from veriledger.sources.shared import shared_folder
from veriledger.specs import account
from veriledger.specs.codes import sample_codes

#: The rule sets around an account: most look up the account, some its details, lines and parties.
FAMILY = {
    **{name: rules for name, (rules, _) in account_queries.RULES.items()},
    "rules_credit_account": account.CAC_DAILY,
    "rules_account_detail": account.CACD_MONTHLY,
}

#: Rule sets that look up by account alone.
LAID = {n: FAMILY[n] for n in ("rules_mortgage_loan", "rules_project_finance", "rules_policy", "rules_grace_period",
                               "rules_debt_restructuring", "rules_restructuring_method", "rules_legal_operation")}

#: Buckets of the tables laid out by account.
BUCKETS = 8


def _tables(spark: SparkSession, sf: str, rule_sets) -> dict[str, DataFrame]:
    names = sorted({e for rules in rule_sets for e in rules.reads})
    tables = entities(spark, sf, names, account_queries.DERIVED)
    for rules in rule_sets:
        tables = with_views(tables, rules, sample_codes())
    return tables


def _aside(spark: SparkSession):
    def store(place: Place, rows: DataFrame) -> DataFrame:
        folder = shared_folder(spark, "-".join(["facts", place[0].lower(), *place[1]]))
        rows.write.parquet(folder)
        return spark.read.schema(rows.schema).parquet(folder)
    return store


def rules_from_shared_facts(spark: SparkSession, sf: str) -> DataFrame:
    """The violations of all rule sets around an account. Each parent is read once, for all of them."""
    codes = sample_codes()
    tables = _tables(spark, sf, FAMILY.values())
    parents = facts.share(tables, codes, FAMILY.values(), _aside(spark))
    found = [evaluate(tables, rules, PERIOD, codes, parents).select(F.lit(name).alias("rule_set"), "rule", "key")
             for name, rules in FAMILY.items()]
    return reduce(DataFrame.unionByName, found)


def _laid(spark: SparkSession, sf: str, rule_sets) -> tuple[dict[str, DataFrame], SharedParents]:
    tables = _tables(spark, sf, rule_sets)
    return facts.laid_out(tables, sample_codes(), rule_sets, "ac_id", BUCKETS, _bucketed, _aside(spark))


def rules_without_exchange(spark: SparkSession, sf: str) -> DataFrame:
    """The rules of mortgage loans, whose table and whose parents' facts lie in the same buckets by account: the
    join moves no rows, although some accounts have far more rows than others."""
    tables, parents = _laid(spark, sf, [account.MGL_MONTHLY])
    return evaluate(tables, account.MGL_MONTHLY, PERIOD, sample_codes(), parents).select("rule", "key")


def rules_of_a_family_without_exchange(spark: SparkSession, sf: str) -> DataFrame:
    """Several rule sets whose tables share one layout by account, and whose parents' facts are stored once in it."""
    tables, parents = _laid(spark, sf, list(LAID.values()))
    found = [evaluate(tables, rules, PERIOD, sample_codes(), parents).select(F.lit(name).alias("rule_set"), "rule", "key")
             for name, rules in LAID.items()]
    return reduce(DataFrame.unionByName, found)


def _bucketed(name: str, rows: DataFrame, key: str, lay: layout.Layout) -> DataFrame:
    """A bucketed table of this application; the next call puts another in its place, with files of its own."""
    spark = rows.sparkSession
    table = re.sub(r"\W", "_", f"laid_{spark.sparkContext.applicationId}_{name}".lower())
    return layout.write_buckets(rows, table, key, lay, shared_folder(spark, "laid"))


QUERIES = {q.__name__: q for q in (rules_from_shared_facts, rules_without_exchange, rules_of_a_family_without_exchange)}

_SQL = {**account_queries.ACCOUNT_SQL, **catalogue_sql.CATALOGUE_SQL}
SHARED_SQL = {
    "rules_from_shared_facts": " union all ".join(
        f"select '{name}' as rule_set, rule, key from ({_SQL[name]})" for name in FAMILY),
    "rules_of_a_family_without_exchange": " union all ".join(
        f"select '{name}' as rule_set, rule, key from ({_SQL[name]})" for name in LAID),
    "rules_without_exchange": account_queries.ACCOUNT_SQL["rules_mortgage_loan"],
}
