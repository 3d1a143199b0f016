"""DuckDB text of the catalogue queries: one plain query per rule, written from the rule's sentence."""

from veriledger.plans.derived import BASE_TABLES, ENTITY_SQL


def with_entities(names: dict[str, str], body: str) -> str:
    plain = {t: t for t in BASE_TABLES}
    ctes = ",\n".join(f"{alias} as ({text.format(**plain)})" for alias, text in names.items())
    return f"with {ctes}\n{body}"


def union_of_rules(base: str, key: str, rules: dict[str, str]) -> str:
    return "\nunion all\n".join(
        f"select '{rule}' as rule, {key} as key from {base} where {test}"
        for rule, test in rules.items())


_BL = "({0} is null or trim({0}) = '')"


def bl(column: str) -> str:
    return _BL.format(column)


_FIXED = "c.term_type = 'fixed_term' and c.loan_type <> 'contingent_loans'"
_CREDIT_ACCOUNT = with_entities(
    {"cac": ENTITY_SQL["DER_CAC"], "cpen": ENTITY_SQL["DER_CPEN"]},
    union_of_rules("cac c", "ac_id", {
        "CNCAC001": "share_lending_total_baht <= 0",
        "CNCAC002": "contract_amount_oc < 0",
        "CMCAC001": "c.term_type = 'fixed_term' and (maturity_date is null "
                    "or maturity_date < effective_date)",
        "CMCAC002": f"c.loan_type <> 'contingent_loans' and {bl('term_type')}",
        "CMCAC003": f"{_FIXED} and principal_freq_unit <> 'unknown_term_unit' and ccy <> 'THB' and "
                    "(n_principal is null or n_principal <= 0 or principal_freq is null "
                    "or principal_freq < 0)",
        "CMCAC004": f"principal_freq is not null and {bl('principal_freq_unit')}",
        "CMCAC005": f"{_FIXED} and interest_freq_unit <> 'unknown_term_unit' and ccy <> 'THB' and "
                    "(n_interest is null or n_interest <= 0 or interest_freq is null "
                    "or interest_freq < 0)",
        "CMCAC006": "(principal_freq_unit = 'unknown_term_unit' or "
                    f"interest_freq_unit = 'unknown_term_unit') and {bl('payment_freq_condition')}",
        "CMCAC007": f"loan_type = 'bills_of_exchange' and {bl('been_extended_flag')}",
        "CMCAC008": "effective_date >= date '2023-10-01' and payment_freq_condition = 'Initial Data'",
        "CMCAC009": f"interest_freq is not null and {bl('interest_freq_unit')}",
        "RICAC001": "not exists (select 1 from cpen p where p.ent_id = c.ent_id)",
    }))

_NOT_CONTINGENT = "c.loan_type <> 'contingent_loans'"
_DETAIL_JOINED = "cacd d left join cac c on c.ac_id = d.ac_id"
_ACCOUNT_DETAIL = with_entities(
    {"cac": ENTITY_SQL["DER_CAC"], "cacd": ENTITY_SQL["DER_CACD"], "cl": ENTITY_SQL["DER_CL"],
     "prt": ENTITY_SQL["DER_PRT"], "ppg": ENTITY_SQL["DER_PPG"]},
    union_of_rules(_DETAIL_JOINED, "d.ac_id", {
        "CNCACD001": "open_date < contract_date",
        "CMCACD002": "loan_type = 'contingent_loans' and (notional_oc is null or notional_oc <= 0 "
                     "or notional_baht is null or notional_baht <= 0)",
        "CMCACD003": "term_type = 'fixed_term' and loan_type = 'first_payment_loans' and ccy <> 'THB' "
                     "and principal_freq_unit <> 'unknown_term_unit' and interest_freq_unit <> "
                     "'unknown_term_unit' and revolving_flag = '0' and account_purpose = "
                     "'consumption_purposes' and (frst_pymt_amt_in_orig_ccy is null or "
                     "frst_pymt_amt_in_orig_ccy <= 0)",
        "CMCACD004": f"(account_purpose = 'commercial_purposes' and {bl('lending_business_type')}) or "
                     f"(account_purpose = 'consumption_purposes' and not {bl('lending_business_type')})",
        "CMCACD005": f"{_NOT_CONTINGENT} and ({bl('revolving_flag')} or {bl('refinance_flag')} or "
                     f"{bl('employee_flag')} or {bl('related_lending_flag')})",
        "CMCACD006": f"{_NOT_CONTINGENT} and account_purpose = 'consumption_purposes' and "
                     f"{bl('digital_loan_flag')}",
        "CMCACD007": f"{_NOT_CONTINGENT} and account_purpose = 'commercial_purposes' and "
                     f"({bl('bridge_loan_flag')} or {bl('country_to_invest')})",
        "CMCACD009": f"not {bl('regulated_product')} and (total_rate is null or not (total_rate "
                     f"between 0 and 100) or {bl('factor')})",
        "CMCACD010": f"loan_type in ('loans', 'contingents_view') and {bl('account_purpose')}",
        "CMCACD011": "effective_date >= date '2023-10-01' and frst_pymt_amt_in_orig_ccy = "
                     "cast('0.01' as decimal(18,2))",
        "CMCACD012": "effective_date >= date '2023-10-01' and country_to_invest = 'unclassified'",
        "RICACD001": "c.ac_id is null",
        "RICACD002": f"not {bl('credit_line_id')} and not exists (select 1 from cl where "
                     "cl.credit_line_id = d.credit_line_id)",
        "RICACD003": "not exists (select 1 from prt where prt.portfolio_id = d.portfolio_id)",
        "RICACD004": f"not {bl('product_program_id')} and not exists (select 1 from ppg where "
                     "ppg.product_program_id = d.product_program_id)",
    }))


_SUM = " + ".join(f"{14 - i} * cast(substr(id_no, {i}, 1) as int)" for i in range(1, 13))
_BAD_ID = (f"(id_no is null or not regexp_full_match(id_no, '[0-9]{{13}}') or "
           f"case when regexp_full_match(id_no, '[0-9]{{13}}') then (11 - ({_SUM}) % 11) % 10 <> "
           "cast(substr(id_no, 13, 1) as int) else false end)")
_COUNTERPARTY_ID = with_entities(
    {"cpid": ENTITY_SQL["DER_CPID"], "jcp": ENTITY_SQL["DER_JCP"], "ocp": ENTITY_SQL["DER_OCP"],
     "fi": ENTITY_SQL["REF_FI_CODE"], "app": ENTITY_SQL["DER_APP"]},
    union_of_rules("cpid c", "cntpr_id", {
        "CNCPID001": f"id_type = 'personal_id' and {_BAD_ID}",
        "CNCPID002": f"id_type = 'tax_id' and {_BAD_ID}",
        "CNCPID003": f"id_type = 'juristic_id' and {_BAD_ID}",
        "CNCPID004": f"id_type = 'cooperative_id' and {_BAD_ID}",
        "CMCPID001": f"id_type = 'offshore_branch_number' and ({bl('branch_fi_code')} or not exists "
                     "(select 1 from fi where fi.fi_code = c.branch_fi_code))",
        "CMCPID002": "id_type <> 'exempt_id' and not exists (select 1 from jcp where jcp.cntpr_id = "
                     "c.cntpr_id) and not exists (select 1 from ocp where ocp.cntpr_id = c.cntpr_id)",
        "CMCPID003": "id_type_country = 'unclassified' and exists (select 1 from app where "
                     "app.application_id = c.application_id and app.application_date >= "
                     "date '2023-10-01')",
    }))

_CREDIT_LINE = with_entities(
    {"cl": ENTITY_SQL["DER_CL"], "cpen": ENTITY_SQL["DER_CPEN"], "app": ENTITY_SQL["DER_APP"]},
    union_of_rules("cl c", "credit_line_id", {
        "CNCL001": "effective_date < approve_date",
        "CNCL002": "line_amount_oc < 0",
        "CMCL001": "case when root_credit_line_id = credit_line_id then not "
                   f"({bl('parent_credit_line_id')} and level_number = 0) else "
                   f"({bl('parent_credit_line_id')} or level_number <= 0) end",
        "RICL001": "not exists (select 1 from cpen p where p.ent_id = c.ent_id)",
        "RICL002": f"not {bl('parent_credit_line_id')} and not exists (select 1 from cl p where "
                   "p.credit_line_id = c.parent_credit_line_id)",
        "RICL003": "not exists (select 1 from cl p where p.credit_line_id = c.root_credit_line_id)",
        "RICL004": f"not {bl('application_id')} and not exists (select 1 from app where "
                   "app.application_id = c.application_id)",
    }))


def position_rule(rule: str, loans: str, positions: str, equal: bool) -> str:
    broken = "<>" if equal else "<"
    return f"""
select '{rule}' as rule, cast(data_dt as varchar) || '|' || org_id as key from
  (select o.data_dt, o.org_id, sum(case when c.loan_type = '{loans}' then otsnd_amt_in_orig_ccy end) as s
   from otdd o left join cac c on c.ac_id = o.ac_id group by o.data_dt, o.org_id) a
  full join (select data_dt, org_id, sum(case when position_item = '{positions}' then fc_amount end) as s
   from fcp group by data_dt, org_id) b
  using (data_dt, org_id) where coalesce(a.s, 0) {broken} coalesce(b.s, 0)"""


_BARRED = "('baht_loans', 'credit_card_loans', 'contingent_loans', 'offshore_branch_loans')"
_OUTSTANDING_DAILY = with_entities(
    {"cac": ENTITY_SQL["DER_CAC"], "otdd": ENTITY_SQL["DER_OTDD"], "fcp": ENTITY_SQL["DS_FCP"]},
    union_of_rules("otdd o", "ac_id", {
        "CNOTDD001": "exists (select 1 from cac c where c.ac_id = o.ac_id and c.loan_type in "
                     f"{_BARRED})",
        "CNOTDD002": "otsnd_amt_in_orig_ccy < 0",
        "CNOTDD003": "exists (select 1 from cac c where c.ac_id = o.ac_id and c.account_status = "
                     "'closed_status')",
        "RIOTDD001": "not exists (select 1 from cac c where c.ac_id = o.ac_id)",
    }) + "\nunion all" + "\nunion all".join([
        position_rule("CMOTDD001", "onshore_lending", "onshore_lending_positions", False),
        position_rule("CMOTDD002", "offshore_lending", "offshore_lending_positions", False),
        position_rule("CMOTDD003", "overdraft_from_deposit", "overdraft_positions", True),
        position_rule("CMOTDD004", "foreign_bill_inward", "bill_inward_positions", False),
        position_rule("CMOTDD005", "foreign_bill_outward", "bill_outward_positions", True),
    ]))


def _iff(condition: str, column: str) -> str:
    return f"coalesce({condition}, false) <> (not {bl(column)})"


_LENT = "c.loan_type <> 'overdraft'"
_RELATED_LOAN = with_entities(
    {"cac": ENTITY_SQL["DER_CAC"], "txf": ENTITY_SQL["DER_TXF"], "rli": ENTITY_SQL["DER_RLI"]},
    union_of_rules("rli r left join txf t on t.txn_id = r.txn_id left join cac c on c.ac_id = t.ac_id",
           "r.txn_id", {
               "CMRLI001": _iff(f"purpose = 'debt_instrument_purposes' and {_LENT}",
                                "investment_type"),
               "CMRLI002": f"investment_type = 'portfolio_investment' and {bl('instrument_type')}",
               "CMRLI003": _iff(
                   "((coalesce(instrument_type = 'bond_instruments', false) and purpose = "
                   "'portfolio_purposes') or purpose in ('borrowing_purposes', 'lending_purposes')) "
                   f"and {_LENT}", "term_range"),
               "CMRLI008": _iff("mvmt_tp = 'increasing_loan' and purpose = 'foreign_loan_purpose' "
                                f"and {_LENT}", "repayment_due_ind"),
               "CMRLI009": "coalesce(term_range <> 'open_term_ranges' and ((mvmt_tp = "
                           "'decreasing_loan' and purpose = 'borrowing_purposes') or (mvmt_tp = "
                           "'increasing_loan' and purpose = 'lending_purposes')) and "
                           f"{_LENT}, false) <> (r.maturity_date is not null)",
               "CMRLI010": _iff("mvmt_tp = 'increasing_loan' and purpose = 'borrowing_purposes' and "
                                f"{_LENT}", "loan_declaration_type"),
               "RIRLI001": "t.txn_id is null",
           }) + "\nunion all\n" + union_of_rules(
        "txf t left join cac c on c.ac_id = t.ac_id", "t.txn_id", {
            "CMRLI011": "purpose in ('portfolio_purposes', 'borrowing_purposes', 'lending_purposes') "
                        f"and {_LENT} and not exists (select 1 from rli r where r.txn_id = t.txn_id)",
        }))


def _missing(kind: str, parent: str, column: str) -> str:
    return (f"reference_type = 'reference_{kind}' and not exists (select 1 from {parent} p where "
            f"p.{column} = r.reference_id)")


_RISK = with_entities(
    {"rsk": ENTITY_SQL["DER_RSK"], "cac": ENTITY_SQL["DER_CAC"], "cl": ENTITY_SQL["DER_CL"],
     "cpid": ENTITY_SQL["DER_CPID"], "cpen": ENTITY_SQL["DER_CPEN"]},
    union_of_rules("rsk r", "reference_id", {
        "CNRSK001": "assessment_date > data_dt",
        "CMRSK001": "risk_measure in ('Internal Credit Rating', 'B-SCORE') and "
                    f"{bl('model_reference')}",
        "CMRSK002": "(risk_measure in ('DSR', 'DSR BOT', 'DTI', 'B-Score', 'MANAGEMENT OVERLAY', "
                    "'D/E Ratio', 'DSCR') and try_cast(risk_value as double) is null) or "
                    "(risk_measure = 'Watch List Flag' and coalesce(risk_value, '') not in ('0', '1'))",
        "RIRSK001": _missing("account", "cac", "ac_id"),
        "RIRSK002": _missing("credit_line", "cl", "credit_line_id"),
        "RIRSK003": _missing("counterparty", "cpid", "cntpr_id"),
        "RIRSK004": _missing("entity", "cpen", "ent_id"),
    }))

_BUILDING = with_entities(
    {"bld": ENTITY_SQL["DER_BLD"], "col": ENTITY_SQL["DER_COL"], "cacd": ENTITY_SQL["DER_CACD"],
     "clp": ENTITY_SQL["DER_CLP"], "pvg": ENTITY_SQL["DER_PVG"], "cvg": ENTITY_SQL["DER_CVG"]},
    union_of_rules("bld b", "collateral_id", {
        "CMBLD001": f"country = 'TH' and (({bl('dopa_location')} and {bl('dol_location')}) or "
                    "coalesce(n_floors, 0) <= 0 or coalesce(area_utilization, 0) <= 0)",
        "CMBLD002": f"country = 'TH' and {bl('developer_type')} and exists (select 1 from cvg join pvg "
                    "on pvg.valuation_group_id = cvg.valuation_group_id join clp on "
                    "clp.protection_id = pvg.pledge_id join cacd on cacd.credit_line_id = "
                    "clp.credit_line_id where cvg.collateral_id = b.collateral_id and "
                    "cacd.account_purpose = 'residential_purchase_purposes')",
        "CMBLD003": f"country = 'TH' and developer_type = 'project_developers' and {bl('project_name')}",
        "CMBLD004": "country = 'TH' and completion_year is null and exists (select 1 from col where "
                    "col.collateral_id = b.collateral_id and col.collateral_type = "
                    "'building_or_land_with_building')",
        "CMBLD005": f"country = 'TH' and property_type = 'condominium' and {bl('floor_number')}",
        "RIBLD001": "not exists (select 1 from col where col.collateral_id = b.collateral_id)",
    }))


def _balance(rule: str, left: str, right_table: str, right: str, groups: dict[str, str]) -> str:
    org = " ".join(f"when '{g}' then '{o}'" for o, g in groups.items())
    return f"""
select '{rule}' as rule, cast(data_dt as varchar) as data_dt, org_id,
  coalesce(a.s, 0) as left_sum, coalesce(b.s, 0) as right_sum,
  coalesce(a.s, 0) - coalesce(b.s, 0) as difference, coalesce(a.s, 0) = coalesce(b.s, 0) as ok
from (select data_dt, org_id, {left} as s from otdm group by data_dt, org_id) a
full join (select ds_dt as data_dt, case fi_rpt_grp_id {org} end as org_id, {right} as s
  from {right_table} where fi_rpt_grp_id in ({', '.join(f"'{g}'" for g in groups.values())})
  group by 1, 2) b using (data_dt, org_id)"""


def _provision(rule: str, account_class: str, provision_class: str) -> str:
    inside = f"ast_and_cntg_clss = '{account_class}' and month(data_dt) in (3, 6, 9, 12)"
    return _balance(
        rule,
        f"coalesce(sum(otsnd_amt_in_baht) filter ({inside}), 0) - "
        f"coalesce(sum(uern_rev_in_baht) filter ({inside}), 0)",
        "pvs",
        f"sum(amt) filter (ast_cl_tp_id = '{provision_class}' and prvn_smy_itm_tp_id = '960080')",
        {"TCB": "116002", "FCB": "116008"})


LEDGER_DIFFERENCES = "union all".join([
    _balance("CMOTDM003", "sum(otsnd_amt_in_baht)", "bls",
             "sum(bsh_amt) filter (bsh_itm_tp_id in ('955010', '955015', '955030', '955051', "
             "'955070', '955124'))", {"TCB": "116002", "FCB": "116003"}),
    _provision("CMOTDM004", "2000800001", "020011"),
    _provision("CMOTDM005", "2000800002", "020012"),
    _provision("CMOTDM006", "2000800003", "020013"),
    _provision("CMOTDM007", "2000800004", "020014"),
    _provision("CMOTDM008", "2000800005", "020015"),
])
_LEDGERS = with_entities(
    {"otdm": ENTITY_SQL["DER_OTDM"], "bls": ENTITY_SQL["DS_BLS"], "pvs": ENTITY_SQL["DS_PVS"]}, LEDGER_DIFFERENCES)

CATALOGUE_SQL = {
    "rules_credit_account": _CREDIT_ACCOUNT,
    "rules_account_detail": _ACCOUNT_DETAIL,
    "rules_counterparty_id": _COUNTERPARTY_ID,
    "rules_credit_line": _CREDIT_LINE,
    "rules_outstanding_daily": _OUTSTANDING_DAILY,
    "rules_related_loan": _RELATED_LOAN,
    "rules_risk": _RISK,
    "rules_building": _BUILDING,
    "reconcile_ledgers": _LEDGERS,
}
