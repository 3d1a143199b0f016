"""Rule sets of the entities around a credit account, over entities derived from the benchmark tables, with
their SQL: one plain query per rule, written from the rule's sentence."""

from __future__ import annotations

from pyspark.sql import DataFrame

from veriledger.operators.ruleset import RuleSet
from veriledger.plans.catalogue_queries import violations_of
from veriledger.plans.catalogue_sql import bl, with_entities, union_of_rules
from veriledger.plans.derived import ENTITY_SQL
from veriledger.specs import account, interest
from veriledger.specs.codes import TENOR_RATE_TYPES


def _account_id(missing: int) -> str:
    return (f"case when o_orderkey % {missing} = 0 then 'none' else 'A' || cast(o_orderkey as string) end as ac_id")


def _day(years: int) -> str:
    return f"cast(cast(o_orderdate as date) + interval {years} year as date)"


def _amount(name: str, low: int, none: int, bad: str = "-1") -> str:
    return (f"cast(case when o_orderkey % {low} = 0 then {bad} when o_orderkey % {none} = 1 then null "
            f"else o_totalprice end as decimal(18,2)) as {name}")


# Entities over the benchmark tables in braces; an account's effective date is the order's plus 24 years.
DERIVED = {
    "DER_FXL": f"""
select {_account_id(19)},
  case when o_custkey % 23 = 0 then 'none' else 'P' || cast(o_custkey as string) end as cntpr_id,
  case o_orderkey % 4 when 0 then '1' when 1 then ' ' end as put_option_flag,
  case when o_orderkey % 5 = 0 then null else {_day(24)} end as put_date, {_amount("put_amount_oc", 101, 7)},
  case o_orderkey % 3 when 0 then '1' when 1 then '' end as call_option_flag,
  case when o_orderkey % 11 = 0 then null else {_day(24)} end as call_date, {_amount("call_amount_oc", 101, 13)},
  case when o_orderkey % 6 = 0 then null when o_orderkey % 9 = 1 then {_day(23)} else {_day(24)} end
    as first_disbursement_date,
  case when o_orderkey % 10 = 0 then null else {_day(25)} end as first_payment_date,
  cast(case o_orderkey % 8 when 0 then null when 1 then -1 else 3 end as int) as n_disbursement
from {{orders}}""",
    "DER_MGL": """
select case when l_partkey % 41 = 0 then 'none' else 'A' || cast(l_orderkey as string) end as ac_id,
  cast(case l_quantity when 5 then 0 when 6 then null when 7 then 0.01 else l_quantity end as decimal(18,2)) as ltv,
  cast(case l_linenumber when 1 then null when 2 then 0 when 3 then 9999 else 1 end as int) as order_of_contracts,
  case l_linenumber when 4 then null when 5 then cast(cast(l_shipdate as date) + interval 30 year as date)
    else cast(cast(l_shipdate as date) + interval 20 year as date) end as sale_date,
  case when l_linenumber % 2 = 0 then ' ' else '0' end as burden_free_flag
from {lineitem}""",
    "DER_PJF": f"""
select {_account_id(29)}, {_amount("estimated_value_baht", 6, 7, "0")},
  case when o_orderkey % 2 = 0 then 'TH' else 'US' end as country,
  case when o_orderkey % 5 = 0 then '' else 'x' end as location
from {{orders}}""",
    "DER_SHM": """
select '20240131' as msr_prd_id,
  case when o_orderkey % 7 < 2 then 'none' else 'A' || cast(o_orderkey as string) end as ac_id,
  case when o_custkey % 23 = 0 then 'none' else 'P' || cast(o_custkey as string) end as cntpr_id
from {orders}""",
    "DER_ACXAC": f"""
select {_account_id(29)}, case o_orderkey % 5 when 0 then 'A' || cast(o_orderkey as string) when 1 then 'none'
  else 'A' || cast(o_orderkey % 1000 as string) end as prev_ac_id
from {{orders}}""",
    "DER_PLC": f"""
select {_account_id(17)}, case when o_orderkey % 4 = 0 then {_day(23)} else {_day(25)} end as effective_date,
  case o_orderkey % 6 when 0 then null when 1 then {_day(22)} else {_day(26)} end as end_date,
  case when o_orderkey % 3 = 0 then 'other_policy' else 'x' end as policy,
  case when o_orderkey % 2 = 0 then ' ' else 'd' end as policy_description
from {{orders}}""",
    "DER_GRPD": f"""
select {_account_id(13)}, case when o_orderkey % 5 = 0 then {_day(23)} else {_day(25)} end as effective_date,
  case o_orderkey % 7 when 0 then null when 1 then {_day(22)} else {_day(26)} end as end_date,
  case when o_orderkey % 2 = 0 then 'other_grace_period' else 'x' end as grace_type,
  case when o_orderkey % 3 = 0 then null else 'd' end as grace_type_description
from {{orders}}""",
    "DER_DR": f"""
select {_account_id(19)}, {_amount("post_principal_baht", 7, 5)}, {_amount("post_interest_baht", 11, 5)},
  cast(case when o_orderkey % 13 = 0 then -1 else o_orderkey % 90 end as int) as days_past_due,
  {_amount("principal_haircut_baht", 9, 4)}, 
  cast(case o_orderkey % 8 when 0 then 0.01 when 1 then -1 when 2 then null else 1 end as decimal(18,2))
    as interest_haircut_baht,
  {_amount("pv_loss_baht", 10, 3, "0.01")}, 
  cast(case o_orderkey % 7 when 0 then 0.01 when 1 then 0 when 2 then null else 1 end as decimal(18,2))
    as cond_principal_haircut_baht,
  cast(case o_orderkey % 6 when 0 then 0.01 when 1 then 0 when 2 then null else 1 end as decimal(18,2))
    as cond_interest_haircut_baht
from {{orders}}""",
    "DER_DRM": f"""
select {_account_id(13)}, case when o_orderkey % 3 = 0 then 'other_dr_method' else 'x' end as method,
  case when o_orderkey % 4 = 0 then ' ' else 'd' end as method_description
from {{orders}}""",
    "DER_LOP": f"""
select {_account_id(31)}, case when o_orderkey % 5 = 0 then null when o_orderkey % 3 = 0 then {_day(23)}
  else {_day(25)} end as legal_operation_date
from {{orders}}""",
    "DER_INTP": f"""
select {_account_id(37)}, case when o_custkey % 23 = 0 then 'none' else 'I' || cast(o_custkey as string) end
    as reference_rate_id,
  case o_orderkey % 4 when 0 then null when 1 then ' ' else 'I' || cast(o_orderkey % 1700 as string) end
    as fix_rate_qted_fm_refr_rate_id,
  case o_orderkey % 6 when 0 then null when 1 then {_day(22)} else {_day(26)} end as rate_end_date,
  {_day(24)} as rate_effective_date, {_amount("tier_threshold", 9, 5)},
  case when o_orderkey % 3 = 0 then 'other_interest_calculation' else 'x' end as calculation,
  case when o_orderkey % 2 = 0 then '' else 'd' end as calculation_description,
  {_amount("fix_rate_margin", 101, 3)}
from {{orders}}""",
    "DER_INTR": """
select 'I' || cast(c_custkey as string) as reference_rate_id,
  case c_custkey % 4 when 0 then 'fixed_rate' when 1 then 'other_rate_type' when 2 then 'BIBOR' else 'x' end as rate_type,
  case when c_custkey % 8 = 1 then ' ' else 'd' end as rate_type_description,
  cast(case c_custkey % 3 when 0 then null when 1 then 0 else 3 end as int) as tenor,
  case when c_custkey % 5 = 0 then ' ' else 'M' end as tenor_unit
from {customer}""",
    "DER_INTRV": "select 'I' || cast(l_partkey as string) as reference_rate_id from {lineitem}",
}

_CUTOVER = "effective_date >= date '2023-10-01'"


def _absent(alias: str, parent: str, column: str, own: str | None = None) -> str:
    return f"not exists (select 1 from {parent} p where p.{column} = {alias}.{own or column})"


def _sql(base: str, key: str, rules: dict[str, str], *entities: str) -> str:
    named = {e.removeprefix("DER_").lower(): DERIVED.get(e) or ENTITY_SQL[e] for e in entities}
    return with_entities(named, union_of_rules(base, key, rules))


_SCOPE = "c.term_type = 'fixed_term' and c.loan_type <> 'contingent_loans'"
_DETAILS = """(select ac_id, bool_or(refinance_flag = '0') as kept, bool_or(employee_flag = '0') as outside,
  bool_or(account_purpose = 'mortgage_purposes') as mortgage,
  bool_or(account_purpose = 'other_mortgage_purposes') as other from cacd group by ac_id)"""
_REVERSE = "coalesce(c.loan_type = 'reverse_mortgage', false)"
_HOUSING = f"d.kept and ({_REVERSE} or coalesce(d.mortgage, false))"


def _with_account(name: str, alias: str) -> str:
    return f"{name} {alias} left join cac c on c.ac_id = {alias}.ac_id"


RULES: dict[str, tuple[RuleSet, str]] = {
    "rules_credit_account_monthly": (account.CAC_MONTHLY, _sql("cac c", "ac_id", {
        "CNCAC001": "share_lending_total_oc <= 0",
        "CNCAC002": "contract_amount_oc < 0",
        "CMCAC001": "c.term_type = 'fixed_term' and (maturity_date is null or maturity_date < effective_date)",
        "CMCAC002": f"c.loan_type <> 'contingent_loans' and {bl('term_type')}",
        "CMCAC003": f"{_SCOPE} and principal_freq_unit <> 'unknown_term_unit' and (n_principal is null or "
                    "n_principal <= 0 or principal_freq is null or principal_freq < 0)",
        "CMCAC004": f"{_SCOPE} and ({bl('principal_freq_unit')} or {bl('interest_freq_unit')})",
        "CMCAC005": f"{_SCOPE} and interest_freq_unit <> 'unknown_term_unit' and (n_interest is null or "
                    "n_interest <= 0 or interest_freq is null or interest_freq < 0)",
        "CMCAC006": "(principal_freq_unit = 'unknown_term_unit' or interest_freq_unit = 'unknown_term_unit') and "
                    f"{bl('payment_freq_condition')}",
        "CMCAC007": f"loan_type = 'bills_of_exchange' and {bl('been_extended_flag')}",
        "CMCAC008": f"{_CUTOVER} and payment_freq_condition = 'Initial Data'",
        "CMCAC009": f"interest_freq is not null and {bl('interest_freq_unit')}",
        "RICAC001": _absent("c", "cpen", "ent_id"),
    }, "DER_CAC", "DER_CPEN")),
    "rules_flexible_payment": (account.FXL_DAILY, _sql(_with_account("fxl", "x"), "x.ac_id", {
        "CNFXL001": "c.loan_type in ('baht_loans', 'credit_card_loans', 'contingent_loans')",
        "CNFXL002": "x.first_disbursement_date < c.effective_date",
        "CMFXL001": f"not {bl('put_option_flag')} and (put_date is null or put_amount_oc is null)",
        "CMFXL002": f"not {bl('call_option_flag')} and (call_date is null or call_amount_oc is null)",
        "CMFXL003": "c.term_type = 'fixed_term' and (n_disbursement is null or n_disbursement < 0 or "
                    "first_disbursement_date is null or first_payment_date is null)",
        "RIFXL001": "c.ac_id is null",
        "RIFXL002": _absent("x", "cpid", "cntpr_id"),
    }, "DER_FXL", "DER_CAC", "DER_CPID")),
    "rules_mortgage_loan": (account.MGL_MONTHLY, _sql(
        f"{_with_account('mgl', 'm')} left join {_DETAILS} d on d.ac_id = m.ac_id", "m.ac_id", {
            "CNMGL001": "ltv <= 0",
            "CMMGL001": f"{_HOUSING} and (order_of_contracts is null or order_of_contracts <= 0)",
            "CMMGL002": f"d.outside and ({_REVERSE} or coalesce(d.mortgage, false) or coalesce(d.other, false)) and "
                        "(ltv is null or ltv <= 0)",
            "CMMGL003": f"{_HOUSING} and (sale_date is null or c.effective_date < sale_date)",
            "CMMGL004": f"d.other and {bl('burden_free_flag')}",
            "CMMGL005": f"c.{_CUTOVER} and order_of_contracts = 9999",
            "CMMGL006": f"c.{_CUTOVER} and ltv = 0.01",
            "RIMGL001": "d.ac_id is null",
        }, "DER_MGL", "DER_CAC", "DER_CACD")),
    "rules_project_finance": (account.PJF_MONTHLY, _sql("pjf x", "ac_id", {
        "CNPJF001": "estimated_value_baht <= 0",
        "CMPJF001": f"country = 'TH' and {bl('location')}",
        "RIPJF001": _absent("x", "cac", "ac_id"),
    }, "DER_PJF", "DER_CAC")),
    "rules_account_link": (account.ACXAC_MONTHLY, _sql("acxac x", "ac_id", {
        "CNACXAC001": "prev_ac_id = ac_id",
        "RIACXAC001": _absent("x", "cac", "ac_id"),
        "RIACXAC002": _absent("x", "cac", "ac_id", "prev_ac_id"),
    }, "DER_ACXAC", "DER_CAC")),
    "rules_policy": (account.PLC_MONTHLY, _sql(_with_account("plc", "x"), "x.ac_id", {
        "CNPLC001": "x.effective_date < c.effective_date",
        "CNPLC002": "x.end_date < x.effective_date",
        "CMPLC001": f"policy = 'other_policy' and {bl('policy_description')}",
        "RIPLC001": "c.ac_id is null",
    }, "DER_PLC", "DER_CAC")),
    "rules_grace_period": (account.GRPD_MONTHLY, _sql(_with_account("grpd", "x"), "x.ac_id", {
        "CNGRPD001": "x.effective_date < c.effective_date",
        "CNGRPD002": "x.end_date < x.effective_date",
        "CMGRPD001": f"grace_type = 'other_grace_period' and {bl('grace_type_description')}",
        "RIGRPD001": "c.ac_id is null",
    }, "DER_GRPD", "DER_CAC")),
    "rules_debt_restructuring": (account.DR_MONTHLY, _sql(_with_account("dr", "x"), "x.ac_id", {
        "CNDR002": "post_principal_baht < 0",
        "CNDR003": "post_interest_baht < 0",
        "CNDR004": "days_past_due < 0",
        "CNDR005": "principal_haircut_baht < 0",
        "CNDR006": "interest_haircut_baht < 0",
        "CNDR007": "cond_principal_haircut_baht <= 0",
        "CNDR008": "cond_interest_haircut_baht <= 0",
        "CMDR001": f"c.{_CUTOVER} and (principal_haircut_baht = 0.01 or interest_haircut_baht = 0.01 or "
                   "pv_loss_baht = 0.01)",
        "CMDR002": f"c.{_CUTOVER} and cond_principal_haircut_baht = 0.01",
        "CMDR003": f"c.{_CUTOVER} and cond_interest_haircut_baht = 0.01",
        "RIDR001": "c.ac_id is null",
    }, "DER_DR", "DER_CAC")),
    "rules_restructuring_method": (account.DRM_MONTHLY, _sql("drm x", "ac_id", {
        "CNDRM001": f"method = 'other_dr_method' and {bl('method_description')}",
        "RIDRM001": _absent("x", "dr", "ac_id"),
    }, "DER_DRM", "DER_DR")),
    "rules_legal_operation": (account.LOP_MONTHLY, _sql(_with_account("lop", "x"), "x.ac_id", {
        "CNLOP001": "legal_operation_date < c.effective_date",
        "RILOP001": "c.ac_id is null",
    }, "DER_LOP", "DER_CAC")),
    "rules_interest_plan": (interest.INTP_DAILY, _sql(
        "intp x left join intr r on r.reference_rate_id = x.reference_rate_id", "ac_id", {
            "CNINTP001": "rate_end_date < rate_effective_date",
            "CNINTP002": "tier_threshold < 0",
            "CMINTP002": f"calculation = 'other_interest_calculation' and {bl('calculation_description')}",
            "CMINTP003": f"r.rate_type <> 'fixed_rate' and not {bl(interest.QUOTED)}",
            "CMINTP004": f"(not {bl(interest.QUOTED)}) <> (fix_rate_margin is not null)",
            "RIINTP001": _absent("x", "cac", "ac_id"),
            "RIINTP002": "r.reference_rate_id is null",
            "RIINTP003": f"not {bl(interest.QUOTED)} and "
                         f"{_absent('x', 'intr', 'reference_rate_id', interest.QUOTED)}",
        }, "DER_INTP", "DER_INTR", "DER_CAC")),
    "rules_reference_rate": (interest.INTR, _sql("intr", "reference_rate_id", {
        "CMINTR001": f"rate_type = 'other_rate_type' and {bl('rate_type_description')}",
        "CMINTR002": f"rate_type in ({', '.join(repr(t) for t in TENOR_RATE_TYPES)}) and (tenor is null or tenor <= 0 "
                     f"or {bl('tenor_unit')})",
    }, "DER_INTR")),
    "rules_reference_rate_value": (interest.INTRV_DAILY, _sql("intrv x", "reference_rate_id", {
        "RIINTRV001": _absent("x", "intr", "reference_rate_id"),
    }, "DER_INTRV", "DER_INTR")),
    "rules_share_holding": (account.SHM_MONTHLY, with_entities(
        {"shm": DERIVED["DER_SHM"], "cac": ENTITY_SQL["DER_CAC"], "cpid": ENTITY_SQL["DER_CPID"]},
        union_of_rules(_with_account("shm", "x"), "x.msr_prd_id || '|' || x.ac_id", {
            "CNSHM001": f"c.ac_id is not null and ({bl('syndication_role')} or syndication_role <> "
                        "'lead_manager_loans')",
            "RISHM001": "c.ac_id is null",
            "RISHM002": _absent("x", "cpid", "cntpr_id"),
        }) + "\nunion all\n" + union_of_rules("cac x", "msr_prd_id || '|' || ac_id", {
            "CMSHM001": "syndication_role = 'lead_manager_loans' and effective_date >= date '2023-01-01' and "
                        + _absent("x", "shm", "ac_id"),
        }))),
}


def _query(rules: RuleSet):
    def query(spark, sf_dir: str) -> DataFrame:
        return violations_of(spark, sf_dir, rules, DERIVED)
    return query


QUERIES = {name: _query(rules) for name, (rules, _) in RULES.items()}
ACCOUNT_SQL = {name: sql for name, (_, sql) in RULES.items()}
