"""Lookups and views that several rule sets use."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriledger.operators import conditions as c
from veriledger.operators.conditions import Condition, Scope, true_when
from veriledger.operators.ruleset import Codes, Fact, Lookup, Tables, View
from veriledger.operators.skew import join_parent
from veriledger.specs import codes as k

# conditions on a row of the credit account entity
FIXED_TERM = c.in_codes("term_type", "fixed_term")
CONTINGENT = c.in_codes("loan_type", "contingent_loans")
NOT_CONTINGENT = ~CONTINGENT
FOREIGN_CURRENCY = ~c.equals("ccy", k.HOME_CURRENCY)
UNKNOWN_PRINCIPAL_UNIT = c.in_codes("principal_freq_unit", "unknown_term_unit")
UNKNOWN_INTEREST_UNIT = c.in_codes("interest_freq_unit", "unknown_term_unit")
SINCE_CUTOVER = c.at_least("effective_date", k.CUTOVER)
NOT_OVERDRAFT = ~c.in_codes("loan_type", "overdraft")

IN_THAILAND = c.equals("country", k.THAILAND)


def lookup(name: str, entity: str, on: str | dict[str, str], *facts: Fact,
           where: Condition | None = None) -> Lookup:
    pairs = tuple(on.items()) if isinstance(on, dict) else ((on, on),)
    return Lookup(name, entity, pairs, facts, where)


def account(*facts: Fact, on: str = "ac_id") -> Lookup:
    """The credit account of a row, as ``cac``."""
    return lookup("cac", "DER_CAC", {on: "ac_id"}, *facts)


def detail(*facts: Fact) -> Lookup:
    """The credit account detail of a row, as ``cacd``."""
    return lookup("cacd", "DER_CACD", "ac_id", *facts)


def counterparty_id() -> Lookup:
    """The counterparty x id rows of a row, as ``cpid``."""
    return lookup("cpid", "DER_CPID", "cntpr_id")


def is_true(column: str) -> Condition:
    return c.sql(column)


# which flags of an account reach the counterparties behind it
_ACCOUNT_FLAGS = {
    "commercial": c.in_codes("account_purpose", "commercial_purposes")
    & ~(c.filled("interbank_flag") & c.equals("interbank_flag", k.YES)),
    "consumption": c.in_codes("account_purpose", "consumption_purposes"),
    "not_employee": c.equals("employee_flag", k.NO),
    "related": c.equals("related_lending_flag", k.YES),
}


def _counterparty_accounts(tables: Tables, codes: Codes) -> DataFrame:
    details = tables["DER_CACD"]
    scope = Scope.of(details, codes)
    flags = list(_ACCOUNT_FLAGS)
    per_account = details.groupBy("ac_id").agg(
        *[F.bool_or(true_when(test(scope))).alias(f) for f, test in _ACCOUNT_FLAGS.items()])
    accounts = tables["DER_CAC"].select("ent_id", "ac_id")
    per_entity = _any(join_parent(accounts, per_account, [("ac_id", "ac_id")], "inner"),
                      "ent_id", flags)
    members = tables["DER_CPEN"].select("ent_id", "cntpr_id")
    return _any(join_parent(members, per_entity, [("ent_id", "ent_id")], "inner"),
                "cntpr_id", flags)


COUNTERPARTY_ACCOUNTS = View("counterparty_accounts", _counterparty_accounts,
                             ("DER_CACD", "DER_CAC", "DER_CPEN"))


def _any(df: DataFrame, key: str, flags: list[str]) -> DataFrame:
    return df.groupBy(key).agg(*[F.bool_or(f).alias(f) for f in flags])


def _pledged_collateral(tables: Tables, codes: Codes) -> DataFrame:
    """Per pledge: whether some collateral behind it is land with building in Thailand."""
    collateral = tables["DER_COL"]
    typed = c.in_codes("collateral_type", "land_with_building")(Scope.of(collateral, codes))
    thai = reduce(DataFrame.unionByName, [
        tables[t].filter(F.col("country") == k.THAILAND).select("collateral_id")
        for t in ("DER_LND", "DER_BLD")
    ]).distinct()
    buildings = join_parent(collateral.filter(typed).select("collateral_id"), thai,
                            [("collateral_id", "collateral_id")], "left_semi").distinct()
    groups = join_parent(tables["DER_CVG"].select("valuation_group_id", "collateral_id"), buildings,
                         [("collateral_id", "collateral_id")], "left_semi")
    pledges = join_parent(tables["DER_PVG"].select("pledge_id", "valuation_group_id"),
                          groups.select("valuation_group_id").distinct(),
                          [("valuation_group_id", "valuation_group_id")], "left_semi")
    return pledges.select("pledge_id").distinct()


PLEDGED_THAI_BUILDINGS = View("pledged_thai_buildings", _pledged_collateral,
                              ("DER_COL", "DER_LND", "DER_BLD", "DER_CVG", "DER_PVG"))


def _residential_collateral(tables: Tables, codes: Codes) -> DataFrame:
    """Collateral that secures the purchase of a residence: account, line, pledge, group, collateral."""
    details = tables["DER_CACD"]
    bought = c.in_codes("account_purpose", "residential_purchase_purposes")
    lines = details.filter(bought(Scope.of(details, codes))).select("credit_line_id").distinct()
    steps = [
        ("DER_CLP", "credit_line_id", "protection_id", "pledge_id"),
        ("DER_PVG", "pledge_id", "valuation_group_id", "valuation_group_id"),
        ("DER_CVG", "valuation_group_id", "collateral_id", "collateral_id"),
    ]
    reached = lines
    for entity, key, target, name in steps:
        hits = join_parent(tables[entity].select(key, target), reached, [(key, key)], "left_semi")
        reached = hits.select(F.col(target).alias(name)).distinct()
    return reached


RESIDENTIAL_COLLATERAL = View("residential_collateral", _residential_collateral,
                              ("DER_CACD", "DER_CLP", "DER_PVG", "DER_CVG"))
