import importlib

import pytest
from compare import compare, duck

entry = importlib.import_module("__spark_entry__")
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF) > 0


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs_without_sql(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    rows = {r["rule"]: r["n"] for r in entry.entry(spark).collect()}
    assert rows == {"CN1": 11, "RI1": 27}


def test_every_rule_of_these_sets_is_broken_somewhere(con):
    from veriledger.plans import account_queries, party_queries

    for name, (rules, sql) in {**account_queries.RULES, **party_queries.RULES}.items():
        broken = {r[0] for r in con.execute(f"select distinct rule from ({sql})").fetchall()}
        assert broken == set(rules.codes), name


@pytest.mark.parametrize("name,rules", [
    ("rules_account_detail", "account.CACD_MONTHLY"),
    ("rules_credit_line", "credit_line.CL_MONTHLY"),
    ("rules_related_loan", "outstanding.RLI_DAILY"),
    ("rules_risk", "review.RSK_P1"),
])
def test_paths_for_large_inputs_match_sql(spark, con, name, rules):
    """Joins as they are for large tables, without broadcasts."""
    from veriledger.operators.ruleset import evaluate
    from veriledger.plans import catalogue_queries as q
    from veriledger.specs.codes import sample_codes

    module, attribute = rules.split(".")
    rule_set = getattr(importlib.import_module(f"veriledger.specs.{module}"), attribute)

    def query(spark, sf_dir):
        tables = q.entities(spark, sf_dir, rule_set.reads)
        return evaluate(tables, rule_set, q.PERIOD, sample_codes()).select("rule", "key")

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert compare(spark, con, name, query, entry.oracle_sql()[name], SF) > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
