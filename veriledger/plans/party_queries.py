"""Rule sets of credit lines, collateral, counterparties and the monthly outstanding, over entities derived from
the benchmark tables, with their SQL: one plain query per rule, written from the rule's sentence."""

from __future__ import annotations

from pyspark.sql import DataFrame

from veriledger.operators.ruleset import RuleSet
from veriledger.plans.catalogue_queries import violations_of
from veriledger.plans.catalogue_sql import (
    CATALOGUE_SQL,
    LEDGER_DIFFERENCES,
    bl,
    position_rule,
    union_of_rules,
    with_entities,
)
from veriledger.plans.derived import ENTITY_SQL
from veriledger.specs import account, collateral, counterparty, credit_line, outstanding, review


def _party(missing: int) -> str:
    return f"case when c_custkey % {missing} = 0 then 'none' else 'P' || cast(c_custkey as string) end as cntpr_id"


def _flag(column: str, number: str, blank: int, value: str = "'x'") -> str:
    """Text that is blank for one in so many rows, in two ways."""
    return (f"case when {number} % {blank} = 0 then ' ' when {number} % {blank * 3} = 1 then null else {value} end "
            f"as {column}")


def _number(column: str, number: str, low: int, none: int, bad: str = "-1", kind: str = "decimal(18,2)") -> str:
    return (f"cast(case when {number} % {low} = 0 then {bad} when {number} % {none} = 1 then null else {number} % 90 + 1 "
            f"end as {kind}) as {column}")


_COUNTRY = "case c_custkey % 4 when 0 then 'unclassified' when 1 then 'US' else 'TH' end"
_SINCE = "case when c_custkey % 3 = 0 then cast('2023-01-01' as date) else cast('2023-10-01' as date) end as data_dt"

# Entities over the benchmark tables in braces; they take the place of the catalogue's of the same name.
DERIVED = {
    "DER_CLLT": "select 'L' || cast(o_custkey as string) as credit_line_id from {orders}",
    "DER_OVD": "select 'L' || cast(l_suppkey as string) as credit_line_id from {lineitem}",
    "DER_CLP": f"""
select 'L' || cast(l_suppkey as string) as credit_line_id, 'G' || cast(l_partkey as string) as protection_id,
  {_number("protection_amount_baht", "l_partkey", 7, 5, "0")}
from {{lineitem}}""",
    "DER_COLP": f"""
select case when p_size % 3 = 0 then 'X' else 'G' end || cast(p_partkey as string) as pledge_id,
  {_number("pledge_amount_baht", "p_partkey", 9, 5)}, {_number("mortgage_seq_no", "p_partkey", 4, 3, "0", "int")}
from {{part}}""",
    "DER_GE": f"""
select case when p_size % 4 = 0 then 'G' else 'Y' end || cast(p_partkey as string) as guarantor_group_id,
  case p_size % 5 when 0 then null when 1 then 'none' else 'P' || cast(p_size as string) end as cntpr_id,
  'L' || cast(p_size as string) as credit_line_id, {_flag("guarantor_name", "p_partkey", 3)}
from {{part}}""",
    "DER_EAM": "select case when p_size % 7 = 0 then 'G' else 'M' end || cast(p_partkey as string) as endorsement_id "
               "from {part}",
    "DER_PVG": "select 'G' || cast(l_suppkey as string) as pledge_id, 'V' || cast(l_partkey as string) as "
               "valuation_group_id from {lineitem}",
    "DER_CVG": "select case when p_size = 11 then 'W' else 'V' end || cast(p_partkey as string) as valuation_group_id, "
               "'C' || cast(p_partkey as string) as collateral_id from {part}",
    "DER_COL": f"""
select case when p_size = 13 then 'N' else 'C' end || cast(p_partkey as string) as collateral_id,
  case p_partkey % 3 when 0 then 'land_with_building' else 'other' end as collateral_type,
  {_flag("registration_flag", "p_partkey", 5, "'1'")}
from {{part}}""",
    "DER_LND": f"""
select case when p_partkey % 7 = 0 then 'Z' else 'C' end || cast(p_partkey as string) as collateral_id,
  case when p_partkey % 2 = 0 then 'TH' else 'US' end as country, {_number("land_area", "p_partkey", 9, 5, "0")},
  {_flag("ownership_flag", "p_partkey", 6)}, {_flag("dopa_location", "p_partkey", 4)},
  {_flag("dol_location", "p_size", 4)}
from {{part}}""",
    "DER_RER": "select 'C' || cast(p_partkey as string) as land_collateral_id, case when p_size % 9 = 0 then 'none' else "
               "'C' || cast(p_partkey as string) end as building_collateral_id from {part}",
    "DER_JCP": f"""
select {_party(17)}, case c_custkey % 5 when 0 then cast('1700-01-01' as date) when 1 then null
    else cast('2000-01-01' as date) end as juristic_date,
  {_COUNTRY} as registered_country, case when c_custkey % 7 = 0 then 'unclassified' else 'TH' end as hq_nationality,
  {_flag("name_thai", "c_custkey", 2)}, {_flag("name_english", "c_custkey", 3)}, {_SINCE}
from {{customer}}""",
    "DER_OCP": f"""
select {_party(13)}, case c_custkey % 5 when 0 then cast('1700-01-01' as date) when 1 then null
    else cast('1980-01-01' as date) end as birthdate,
  {_COUNTRY} as residence_country, case when c_custkey % 7 = 0 then 'unclassified' else 'TH' end as nationality,
  {_flag("first_name_en", "c_custkey", 2)}, {_flag("first_name_th", "c_custkey", 3)},
  {_flag("last_name_en", "c_custkey", 5)}, {_flag("last_name_th", "c_custkey", 2)}, {_SINCE}
from {{customer}}""",
    "DER_BLP": f"""
select case when c_custkey % 3 = 0 then 'none' else 'P' || cast(c_custkey as string) end as cntpr_id,
  {_number("labor", "c_custkey", 8, 5, "-1", "int")}, {_number("domestic_income_baht", "c_custkey", 7, 3)},
  {_number("export_income_baht", "c_custkey", 4, 5)}, {_COUNTRY} as factory_country,
  {_flag("factory_location", "c_custkey", 3)}
from {{customer}}""",
    "DER_PLP": f"""
select case when c_custkey % 4 = 0 then 'none' else 'P' || cast(c_custkey as string) end as cntpr_id,
  {_number("other_debt_burden_baht", "c_custkey", 8, 5)},
  case c_custkey % 3 when 0 then 'unemployed' when 1 then 'employed' end as employment_status,
  {_flag("employment_characteristic", "c_custkey", 2)},
  case when c_custkey % 6 = 0 then 'unemployed_occupations' when c_custkey % 5 = 0 then null else 'x' end as occupation,
  {_number("income_baht", "c_custkey", 7, 5)}, {_flag("contact_location", "c_custkey", 2)}
from {{customer}}""",
    "DER_RTR": f"select {_party(2)} from {{customer}}",
    "DER_CPEN": "select 'E' || cast(c_custkey as string) as ent_id, case when c_custkey % 31 = 0 then 'none' else 'P' || "
                "cast(c_custkey as string) end as cntpr_id from {customer}",
    "DER_CPDG": f"select 'D' || cast(c_nationkey as string) as debtor_group_id, {_party(19)} from {{customer}}",
    "DER_DG": "select case when n_regionkey < 4 then 'D' else 'N' end || cast(n_nationkey as string) as debtor_group_id "
              "from {nation}",
    "DER_REV": """
select cast(ts as date) as review_date, cast('2024-01-02' as date) as data_dt,
  case event_id % 4 when 0 then 'reference_account' when 1 then 'reference_credit_line'
    when 2 then 'reference_counterparty' else 'reference_entity' end as reference_type,
  case event_id % 4 when 0 then 'A' when 1 then 'L' when 2 then 'P' else 'E' end || cast(event_id * 2 as string)
    as reference_id
from {events}""",
    "DER_BRD": """
select case when event_id % 9 = 0 then 'none' else 'T' || cast(event_id as string) end as txn_id,
  case when event_id % 3 = 0 then 'approval_document' else 'x' end as bot_doc_tp,
  case when event_id % 4 = 0 then null else cast(ts as date) end as bot_doc_date
from {events}""",
    "DER_RDA": "select 'T' || cast(event_id * 2 as string) as txn_id from {events}",
    "DER_CACD": """
select case when l_partkey % 50 = 0 then 'N' else 'A' end || cast(l_orderkey as string) as ac_id,
  case l_returnflag when 'A' then 'commercial_purposes' when 'R' then
    'consumption_purposes' else 'other_purposes' end as account_purpose,
  case l_linenumber when 1 then '1' when 2 then ' ' else '0' end as interbank_flag,
  case when l_quantity < 10 then '1' else '0' end as employee_flag,
  case when l_quantity = 9 then '1' else '0' end as related_lending_flag,
  case when l_quantity < 25 then 'x' end as regulated_product
from {lineitem}""",
    "DER_OTDM": f"""
select 'A' || cast(l_orderkey as string) as ac_id, case l_linenumber % 2 when 0 then 'TCB' else 'FCB' end as org_id,
  cast(l_shipdate as date) as data_dt,
  case when l_quantity = 9 then ' ' else '200080000' || cast(l_linenumber as string) end as ast_and_cntg_clss,
  cast(l_extendedprice as decimal(18,2)) as otsnd_amt_in_baht,
  cast(case when l_quantity < 25 then 0 else l_extendedprice end as decimal(18,2)) as otsnd_amt_in_orig_ccy,
  {_number("accrued_fee_baht", "l_partkey", 31, 5)}, {_number("accrued_interest_baht", "l_partkey", 37, 7)},
  {_number("undue_interest_baht", "l_partkey", 41, 11)}, {_number("contractual_interest_baht", "l_partkey", 43, 13)},
  {_number("uern_rev_in_orig_ccy", "l_partkey", 47, 17)}, {_number("uern_rev_in_baht", "l_partkey", 53, 19)},
  {_number("suspended_baht", "l_partkey", 59, 23)}, {_number("days_past_due", "l_partkey", 61, 29, "-1", "int")},
  {_number("current_eir", "l_partkey", 27, 31, "101")}, {_number("total_rate", "l_partkey", 29, 37, "101")},
  {_number("credit_equivalent_baht", "l_partkey", 33, 8)},
  case when l_quantity < 3 then 'inactive_or_closed_status' else 'open' end as account_status,
  {_flag("class_reason", "l_partkey", 6)}
from {{lineitem}}""",
}


def _absent(alias: str, parent: str, column: str, own: str | None = None) -> str:
    return f"not exists (select 1 from {parent} p where p.{column} = {alias}.{own or column})"


def _sql(body: str, *entities: str, **views: str) -> str:
    named = {e.removeprefix("DER_").lower(): DERIVED.get(e) or ENTITY_SQL[e] for e in entities}
    return with_entities({**named, **views}, body)


# What the details of an entity's accounts say of its counterparties.
_REACHED = """select m.cntpr_id,
  bool_or(coalesce(d.account_purpose = 'commercial_purposes' and coalesce(d.interbank_flag, '') <> '1', false)) as commercial,
  bool_or(coalesce(d.account_purpose = 'consumption_purposes', false)) as consumption,
  bool_or(coalesce(d.employee_flag = '0', false)) as outside,
  bool_or(coalesce(d.related_lending_flag = '1', false)) as related
from cpen m join cac c on c.ent_id = m.ent_id join cacd d on d.ac_id = c.ac_id group by m.cntpr_id"""
_REACHES = ("DER_CPEN", "DER_CAC", "DER_CACD")
_PLEDGED = """select pledge_id from pvg join cvg using (valuation_group_id) join col using (collateral_id)
where collateral_type = 'land_with_building' and (exists (select 1 from lnd p where p.collateral_id = col.collateral_id
  and p.country = 'TH') or exists (select 1 from bld p where p.collateral_id = col.collateral_id and p.country = 'TH'))"""
_SINCE_CUTOVER = "data_dt >= date '2023-10-01'"
_THAI_SITE = " or ".join(f"exists (select 1 from {t} p where p.collateral_id = x.collateral_id and p.country = 'TH')"
                         for t in ("lnd", "bld"))
_BLP_RULES = {
    "CNBLP001": "labor < 0",
    "CNBLP002": "domestic_income_baht < 0",
    "CMBLP002": f"factory_country = 'TH' and {bl('factory_location')}",
    "CMBLP003": "(domestic_income_baht > 0 and export_income_baht < 0) or (not coalesce(domestic_income_baht > 0, "
                "false) and not coalesce(export_income_baht > 0, false))",
    "RIBLP001": _absent("x", "cpid", "cntpr_id"),
}
_ABSENT_LINE = _absent("x", "cl", "credit_line_id")
_NOT_CONTINGENT = "c.loan_type <> 'contingent_loans'"
_AND_MORE = "\nunion all\n"

RULES: dict[str, tuple[RuleSet, str]] = {
    "rules_line_limit": (credit_line.CLLT_MONTHLY, _sql(
        union_of_rules("cllt x", "credit_line_id", {"RICLLT001": _ABSENT_LINE}), "DER_CLLT", "DER_CL")),
    "rules_overdraft_line": (credit_line.OVD_MONTHLY, _sql(
        union_of_rules("ovd x", "credit_line_id", {"RIOVD001": _ABSENT_LINE}), "DER_OVD", "DER_CL")),
    "rules_line_protection": (credit_line.CLP_MONTHLY, _sql(union_of_rules("clp x", "credit_line_id", {
        "CNCLP001": "protection_amount_baht <= 0",
        "RICLP001": _ABSENT_LINE,
        "RICLP002": f"{_absent('x', 'colp', 'pledge_id', 'protection_id')} and "
                    f"{_absent('x', 'ge', 'guarantor_group_id', 'protection_id')} and "
                    f"{_absent('x', 'eam', 'endorsement_id', 'protection_id')}",
    }), "DER_CLP", "DER_CL", "DER_COLP", "DER_GE", "DER_EAM")),
    "rules_collateral_pledge": (credit_line.COLP_MONTHLY, _sql(union_of_rules("colp x", "pledge_id", {
        "CNCOLP001": "pledge_amount_baht < 0",
        "CMCOLP001": "mortgage_seq_no <= 0 and exists (select 1 from pledged p where p.pledge_id = x.pledge_id)",
        "RICOLP001": _absent("x", "pvg", "pledge_id"),
    }), "DER_COLP", "DER_COL", "DER_LND", "DER_BLD", "DER_CVG", "DER_PVG", pledged=_PLEDGED)),
    "rules_collateral": (collateral.COL_MONTHLY, _sql(union_of_rules("col x", "collateral_id", {
        "CMCOL001": f"({_THAI_SITE}) and {bl('registration_flag')}",
    }), "DER_COL", "DER_LND", "DER_BLD")),
    "rules_land": (collateral.LND_P1, _sql(union_of_rules("lnd x", "collateral_id", {
        "CNLND001": "land_area <= 0",
        "CMLND001": f"country = 'TH' and {bl('ownership_flag')}",
        "CMLND002": f"country = 'TH' and {bl('dopa_location')} and {bl('dol_location')}",
        "RILND001": _absent("x", "col", "collateral_id"),
    }), "DER_LND", "DER_COL")),
    "rules_land_of_building": (collateral.RER_MONTHLY, _sql(union_of_rules("rer x", "land_collateral_id", {
        "RIRER001": _absent("x", "lnd", "collateral_id", "land_collateral_id"),
        "RIRER002": _absent("x", "bld", "collateral_id", "building_collateral_id"),
    }), "DER_RER", "DER_LND", "DER_BLD")),
    "rules_valuation_group": (collateral.CVG_MONTHLY, _sql(union_of_rules("cvg x", "valuation_group_id", {
        "RICVG001": _absent("x", "col", "collateral_id")}), "DER_CVG", "DER_COL")),
    "rules_pledge_group": (collateral.PVG_MONTHLY, _sql(union_of_rules("pvg x", "valuation_group_id", {
        "RIPVG001": _absent("x", "cvg", "valuation_group_id")}), "DER_PVG", "DER_CVG")),
    "rules_guarantee": (collateral.GE_MONTHLY, _sql(union_of_rules(
        "ge x", "guarantor_group_id || '|' || coalesce(cntpr_id, '') || '|' || credit_line_id", {
            "CMGE001": f"{bl('guarantor_name')} and {bl('cntpr_id')}",
            "RIGE001": _absent("x", "cpid", "cntpr_id"),
        }), "DER_GE", "DER_CPID")),
    "rules_juristic_party": (counterparty.JCP_DAILY, _sql(union_of_rules("jcp x", "cntpr_id", {
        "CMJCP002": "registered_country = 'TH' and year(juristic_date) <= 1753",
        "CMJCP003": f"{bl('name_thai')} and {bl('name_english')}",
        "CMJCP004": f"{_SINCE_CUTOVER} and (registered_country = 'unclassified' or hq_nationality = 'unclassified')",
        "RIJCP001": _absent("x", "cpid", "cntpr_id"),
    }), "DER_JCP", "DER_CPID")),
    "rules_ordinary_party": (counterparty.OCP_DAILY, _sql(union_of_rules("ocp x", "cntpr_id", {
        "CNOCP001": "year(birthdate) <= 1753",
        "CMOCP002": f"{bl('first_name_en')} and {bl('first_name_th')}",
        "CMOCP003": f"{bl('last_name_en')} and {bl('last_name_th')}",
        "CMOCP004": f"{_SINCE_CUTOVER} and (residence_country = 'unclassified' or nationality = 'unclassified')",
        "RIOCP001": _absent("x", "cpid", "cntpr_id"),
    }), "DER_OCP", "DER_CPID")),
    "rules_business_profile": (counterparty.BLP_MONTHLY, _sql(
        union_of_rules("blp x", "cntpr_id", _BLP_RULES) + _AND_MORE + union_of_rules("reached x", "cntpr_id", {
            "CMBLP001": f"commercial and {_absent('x', 'blp', 'cntpr_id')}"}),
        "DER_BLP", "DER_CPID", *_REACHES, reached=_REACHED)),
    "rules_business_profile_first": (counterparty.BLP_P1, _sql(
        union_of_rules("blp x", "cntpr_id", _BLP_RULES), "DER_BLP", "DER_CPID")),
    "rules_personal_profile": (counterparty.PLP_P1, _sql(union_of_rules("plp x", "cntpr_id", {
        "CNPLP001": "other_debt_burden_baht < 0",
        "CMPLP002": f"(employment_status <> 'unemployed' and {bl('employment_characteristic')}) or (employment_status = "
                    "'unemployed' and not coalesce(occupation = 'unemployed_occupations', false))",
        "CMPLP004": "income_baht < 0 and exists (select 1 from reached p where p.cntpr_id = x.cntpr_id and p.outside)",
        "CMPLP005": "(exists (select 1 from cpid p where p.cntpr_id = x.cntpr_id and p.id_type = 'personal_id') or exists "
                    "(select 1 from ocp p where p.cntpr_id = x.cntpr_id and p.residence_country = 'TH')) and "
                    f"{bl('contact_location')}",
        "RIPLP001": _absent("x", "cpid", "cntpr_id"),
    }) + _AND_MORE + union_of_rules("reached x", "cntpr_id", {
        "CMPLP001": f"consumption and {_absent('x', 'plp', 'cntpr_id')}"}),
        "DER_PLP", "DER_CPID", "DER_OCP", *_REACHES, reached=_REACHED)),
    "rules_related_party": (counterparty.RTR_MONTHLY, _sql(
        union_of_rules("rtr x", "cntpr_id", {"RIRTR001": _absent("x", "cpid", "cntpr_id")}) + _AND_MORE
        + union_of_rules("reached x", "cntpr_id", {"CMRTR001": f"related and {_absent('x', 'rtr', 'cntpr_id')}"}),
        "DER_RTR", "DER_CPID", *_REACHES, reached=_REACHED)),
    "rules_party_entity": (counterparty.CPEN, _sql(union_of_rules("cpen x", "cntpr_id", {
        "RICPEN001": _absent("x", "cpid", "cntpr_id")}), "DER_CPEN", "DER_CPID")),
    "rules_debtor_group": (counterparty.CPDG, _sql(union_of_rules("cpdg x", "debtor_group_id || '|' || cntpr_id", {
        "RICPDG001": _absent("x", "dg", "debtor_group_id"),
        "RICPDG002": _absent("x", "cpid", "cntpr_id"),
    }), "DER_CPDG", "DER_DG", "DER_CPID")),
    "rules_outstanding_monthly": (outstanding.OTDM_P1, _sql(union_of_rules("otdm x left join cac c on c.ac_id = x.ac_id", "x.ac_id", {
        "CNOTDM001": "accrued_fee_baht < 0",
        "CNOTDM002": "accrued_interest_baht < 0",
        "CNOTDM003": "undue_interest_baht < 0",
        "CNOTDM004": "contractual_interest_baht < 0",
        "CNOTDM005": "not (current_eir between 0 and 100)",
        "CNOTDM006": "uern_rev_in_orig_ccy < 0",
        "CNOTDM007": "uern_rev_in_baht < 0",
        "CNOTDM008": "suspended_baht < 0",
        "CNOTDM009": "days_past_due < 0",
        "CMOTDM001": f"{_NOT_CONTINGENT} and (accrued_interest_baht is null or undue_interest_baht is null or "
                     "contractual_interest_baht is null or current_eir is null or uern_rev_in_orig_ccy is null or "
                     "uern_rev_in_baht is null or days_past_due is null)",
        "CMOTDM002": "(total_rate is null or not (total_rate between 0 and 100)) and exists (select 1 from cacd p where "
                     f"p.ac_id = x.ac_id and not {bl('p.regulated_product')})",
        "CMOTDM009": "x.account_status = 'inactive_or_closed_status' and (coalesce(otsnd_amt_in_orig_ccy, 0) <> 0 or "
                     "coalesce(otsnd_amt_in_baht, 0) <> 0)",
        "CMOTDM010": "c.loan_type = 'contingent_loans' and (credit_equivalent_baht is null or credit_equivalent_baht < 0)",
        "CMOTDM011": "c.loan_type in ('loans', 'aval_to_bills', 'bill_certifications', 'loan_guarantees', "
                     f"'unconditional_loan_guarantees') and ({bl('ast_and_cntg_clss')} or {bl('class_reason')})",
        "RIOTDM001": _absent("x", "cacd", "ac_id"),
    }) + f"{_AND_MORE}select rule, data_dt || '|' || org_id as key from ({LEDGER_DIFFERENCES}) where not ok",
        "DER_OTDM", "DER_CAC", "DER_CACD", bls=ENTITY_SQL["DS_BLS"], pvs=ENTITY_SQL["DS_PVS"])),
}


RULES |= {
    "rules_review": (review.REV_MONTHLY, _sql(union_of_rules(
        "rev x", "cast(review_date as varchar) || '|' || reference_id", {
            "CNREV001": "review_date > data_dt",
            **{f"RIREV{i:03}": f"reference_type = 'reference_{kind}' and "
                               f"{_absent('x', parent, column, 'reference_id')}"
               for i, (kind, parent, column) in enumerate((
                   ("account", "cac", "ac_id"), ("credit_line", "cl", "credit_line_id"),
                   ("counterparty", "cpid", "cntpr_id"), ("entity", "cpen", "ent_id")), 1)},
        }), "DER_REV", "DER_CAC", "DER_CL", "DER_CPID", "DER_CPEN")),
    "rules_flow_document": (outstanding.BRD_DAILY, _sql(union_of_rules("brd x", "txn_id", {
        "CMBRD001": "bot_doc_tp = 'approval_document' and bot_doc_date is null",
        "RIBRD001": _absent("x", "txf", "txn_id"),
    }), "DER_BRD", "DER_TXF")),
    "rules_flow_detail": (outstanding.RDA_DAILY, _sql(union_of_rules("rda x", "txn_id", {
        "RIRDA001": _absent("x", "txf", "txn_id")}), "DER_RDA", "DER_TXF")),
}

# First-phase and repeated jobs, over the catalogue's entities.
_BARRED = "('baht_loans', 'credit_card_loans', 'contingent_loans', 'offshore_branch_loans')"
_SAME_DETAIL = ("CNCACD001", "CMCACD002", "CMCACD004", "CMCACD006", "CMCACD007", "CMCACD009", "RICACD001", "RICACD002",
                "RICACD003", "RICACD004")
_FLAGS = ("revolving_flag", "refinance_flag", "employee_flag", "related_lending_flag")
_CATALOGUE = {n: ENTITY_SQL[f"DER_{n.upper()}"] for n in ("cac", "cacd", "otdd")}
FIRST_RULES: dict[str, tuple[RuleSet, str]] = {
    "rules_outstanding_first": (outstanding.OTDD_P1, with_entities(
        {"cac": _CATALOGUE["cac"], "otdd": _CATALOGUE["otdd"], "fcp": ENTITY_SQL["DS_FCP"]},
        union_of_rules("otdd x left join cac c on c.ac_id = x.ac_id", "x.ac_id", {
            "CNOTDD001": f"c.loan_type in {_BARRED}",
            "CNOTDD002": "otsnd_amt_in_orig_ccy < 0",
            "CNOTDD003": "c.account_status = 'inactive_or_closed_status'",
            "RIOTDD001": "c.ac_id is null",
        }) + "".join(_AND_MORE + position_rule(code, loans, positions, False) for code, (loans, positions) in {
            "CMOTDD001": ("onshore_lending", "onshore_lending_positions"),
            "CMOTDD002": ("offshore_lending", "offshore_lending_positions"),
            "CMOTDD003": ("overdraft_from_deposit", "overdraft_positions"),
            "CMOTDD004": ("foreign_bill_inward", "bill_inward_positions"),
            "CMOTDD005": ("foreign_bill_outward", "bill_outward_positions"),
        }.items()))),
    "rules_account_detail_first": (account.CACD_P1, f"select rule, key from ({CATALOGUE_SQL['rules_account_detail']}) "
                                   f"where rule in {_SAME_DETAIL}" + _AND_MORE + "select rule, key from (" + with_entities(
        {"cac": _CATALOGUE["cac"], "cacd": _CATALOGUE["cacd"]},
        union_of_rules("cacd d left join cac c on c.ac_id = d.ac_id", "d.ac_id", {
            "CMCACD003": f"c.term_type = 'fixed_term' and {_NOT_CONTINGENT} and principal_freq_unit <> "
                         "'unknown_term_unit' and interest_freq_unit <> 'unknown_term_unit' and revolving_flag = '0' and "
                         "(frst_pymt_amt_in_orig_ccy is null or frst_pymt_amt_in_orig_ccy <= 0)",
            "CMCACD005": f"{_NOT_CONTINGENT} and ({' or '.join(bl(c) for c in _FLAGS)} or original_eir is null or not "
                         "(original_eir between 0 and 100))",
            "CMCACD008": f"(({_NOT_CONTINGENT} and account_purpose = 'commercial_purposes') or account_purpose = "
                         f"'other_purposes') and {bl('interbank_flag')}",
        })) + ")"),
    "rules_counterparty_id_rerun": (counterparty.CPID_RERUN, f"select rule, key from "
                                    f"({CATALOGUE_SQL['rules_counterparty_id']}) where rule <> 'CMCPID003'"),
}


def _query(rules: RuleSet, more=None):
    def query(spark, sf_dir: str) -> DataFrame:
        return violations_of(spark, sf_dir, rules, more)
    return query


QUERIES = {name: _query(rules, DERIVED) for name, (rules, _) in RULES.items()}
QUERIES |= {name: _query(rules) for name, (rules, _) in FIRST_RULES.items()}
RULES |= FIRST_RULES
PARTY_SQL = {name: sql for name, (_, sql) in RULES.items()}
