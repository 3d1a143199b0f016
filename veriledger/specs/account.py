"""Rule sets of the credit account entities."""

from veriledger.operators import conditions as c
from veriledger.operators import families as f
from veriledger.operators.ruleset import Pass, RuleSet, any_row, latest
from veriledger.specs import codes as k
from veriledger.specs.shared import (
    CONTINGENT,
    FIXED_TERM,
    FOREIGN_CURRENCY,
    NOT_CONTINGENT,
    SINCE_CUTOVER,
    UNKNOWN_INTEREST_UNIT,
    UNKNOWN_PRINCIPAL_UNIT,
    account,
    counterparty_id,
    detail,
    is_true,
    lookup,
)

ACCOUNT = ("ac_id",)
CAC_SINCE_CUTOVER = c.at_least("cac__effective_date", k.CUTOVER)


def _credit_account(daily: bool) -> RuleSet:
    in_scope = FIXED_TERM & NOT_CONTINGENT
    foreign = FOREIGN_CURRENCY if daily else c.always()
    share = "share_lending_total_baht" if daily else "share_lending_total_oc"
    if daily:
        units = f.required_if("CMCAC004", c.filled("principal_freq"), "principal_freq_unit")
    else:
        units = f.required_if("CMCAC004", in_scope, "principal_freq_unit", "interest_freq_unit")
    rules = (
        f.within("CNCAC001", share, c.above(share, 0)),
        f.within("CNCAC002", "contract_amount_oc", c.at_least("contract_amount_oc", 0)),
        f.date_rule("CMCAC001", c.not_before("maturity_date", "effective_date"), FIXED_TERM,
                    required="maturity_date"),
        f.required_if("CMCAC002", NOT_CONTINGENT, "term_type"),
        f.required_if("CMCAC003", in_scope & ~UNKNOWN_PRINCIPAL_UNIT & foreign,
                      "n_principal", "principal_freq",
                      holds=c.above("n_principal", 0) & c.at_least("principal_freq", 0)),
        units,
        f.required_if("CMCAC005", in_scope & ~UNKNOWN_INTEREST_UNIT & foreign,
                      "n_interest", "interest_freq",
                      holds=c.above("n_interest", 0) & c.at_least("interest_freq", 0)),
        f.required_if("CMCAC006", UNKNOWN_PRINCIPAL_UNIT | UNKNOWN_INTEREST_UNIT,
                      "payment_freq_condition"),
        f.required_if("CMCAC007", c.in_codes("loan_type", "bills_of_exchange"),
                      "been_extended_flag"),
        f.placeholder_ban("CMCAC008", SINCE_CUTOVER,
                          c.equals("payment_freq_condition", k.INITIAL_DATA)),
        f.required_if("CMCAC009", c.filled("interest_freq"), "interest_freq_unit"),
        f.references("RICAC001", "cpen"),
    )
    entity = lookup("cpen", "DER_CPEN", "ent_id")
    return RuleSet("DER_CAC", (Pass("DER_CAC", ACCOUNT, rules, (entity,)),))


CAC_DAILY = _credit_account(daily=True)
CAC_MONTHLY = _credit_account(daily=False)


def _account_detail(first_phase: bool) -> RuleSet:
    commercial = c.in_codes("account_purpose", "commercial_purposes")
    consumption = c.in_codes("account_purpose", "consumption_purposes")
    not_contingent = is_true("cac__not_contingent")
    contingent = is_true("cac__contingent")
    known_units = ~UNKNOWN_PRINCIPAL_UNIT & ~UNKNOWN_INTEREST_UNIT
    if first_phase:
        pays_first = any_row("pays_first", FIXED_TERM & NOT_CONTINGENT & known_units)
        first_when = is_true("cac__pays_first") & c.equals("revolving_flag", k.NO)
    else:
        pays_first = any_row("pays_first", FIXED_TERM & c.in_codes("loan_type", "first_payment_loans")
                             & FOREIGN_CURRENCY & known_units)
        first_when = (is_true("cac__pays_first") & c.equals("revolving_flag", k.NO) & consumption)
    flags = ["revolving_flag", "refinance_flag", "employee_flag", "related_lending_flag"]
    cac = ("cac",)
    rules = [
        f.date_rule("CNCACD001", c.not_before("open_date", "cac__contract_date"), needs=cac),
        f.required_if("CMCACD002", contingent, "notional_oc", "notional_baht",
                      holds=c.above("notional_oc", 0) & c.above("notional_baht", 0), needs=cac),
        f.required_if("CMCACD003", first_when, "frst_pymt_amt_in_orig_ccy",
                      holds=c.above("frst_pymt_amt_in_orig_ccy", 0), needs=cac),
        f.Rule("CMCACD004", "V4", c.Condition(
            lambda s: (c.true_when(commercial(s)) & c.blank("lending_business_type")(s))
            | (c.true_when(consumption(s)) & c.filled("lending_business_type")(s)))),
        f.required_if("CMCACD005", not_contingent, *flags, needs=cac) if not first_phase else
        f.required_if("CMCACD005", not_contingent, *flags, "original_eir",
                      holds=c.between("original_eir", 0, 100), needs=cac),
        f.required_if("CMCACD006", not_contingent & consumption, "digital_loan_flag", needs=cac),
        f.required_if("CMCACD007", not_contingent & commercial, "bridge_loan_flag",
                      "country_to_invest", needs=cac),
        f.required_within("CMCACD009", c.filled("regulated_product"), "total_rate",
                          c.between("total_rate", 0, 100), "factor"),
        f.references("RICACD001", "cac"),
        f.references_if("RICACD002", c.filled("credit_line_id"), "cl"),
        f.references("RICACD003", "prt"),
        f.references_if("RICACD004", c.filled("product_program_id"), "ppg"),
    ]
    if first_phase:
        others = c.in_codes("account_purpose", "other_purposes")
        rules.append(f.required_if(
            "CMCACD008", c.Condition(
                lambda s: c.true_when((not_contingent & commercial)(s)) | c.true_when(others(s)),
                (not_contingent, commercial, others)),
            "interbank_flag", needs=cac))
    else:
        rules += [
            f.in_list("CMCACD010", is_true("cac__needs_purpose"), c.filled("account_purpose"),
                      needs=cac),
            f.placeholder_ban("CMCACD011", CAC_SINCE_CUTOVER,
                              c.sql(f"frst_pymt_amt_in_orig_ccy = {k.UNKNOWN_AMOUNT}"), needs=cac),
            f.placeholder_ban("CMCACD012", CAC_SINCE_CUTOVER,
                              c.equals("country_to_invest", k.UNCLASSIFIED), needs=cac),
        ]
    cac_lookup = account(
        latest("contract_date"), latest("effective_date"), pays_first,
        any_row("contingent", CONTINGENT), any_row("not_contingent", NOT_CONTINGENT),
        any_row("needs_purpose", c.in_codes("loan_type", "loans", "contingents_view")),
    )
    lookups = (
        cac_lookup,
        lookup("cl", "DER_CL", "credit_line_id"),
        lookup("prt", "DER_PRT", "portfolio_id"),
        lookup("ppg", "DER_PPG", "product_program_id"),
    )
    return RuleSet("DER_CACD", (Pass("DER_CACD", ACCOUNT, tuple(rules), lookups),))


CACD_MONTHLY = _account_detail(first_phase=False)
CACD_P1 = _account_detail(first_phase=True)


_BARRED = any_row("barred", c.in_codes("loan_type", "baht_loans", "credit_card_loans",
                                       "contingent_loans"))

FXL_DAILY = RuleSet("DER_FXL", (Pass("DER_FXL", ACCOUNT, (
    f.must_not_be_reported("CNFXL001", is_true("cac__barred"), ("cac",)),
    f.date_rule("CNFXL002", c.not_before("first_disbursement_date", "cac__effective_date"),
                needs=("cac",)),
    f.required_if("CMFXL001", c.filled("put_option_flag"), "put_date", "put_amount_oc"),
    f.required_if("CMFXL002", c.filled("call_option_flag"), "call_date", "call_amount_oc"),
    f.required_if("CMFXL003", is_true("cac__fixed"), "n_disbursement", "first_disbursement_date",
                  "first_payment_date", holds=c.at_least("n_disbursement", 0), needs=("cac",)),
    f.references("RIFXL001", "cac"),
    f.references("RIFXL002", "cpid"),
), (account(_BARRED, latest("effective_date"), any_row("fixed", FIXED_TERM)), counterparty_id())),))


_MORTGAGE = c.in_codes("account_purpose", "mortgage_purposes")
_OTHER_MORTGAGE = c.in_codes("account_purpose", "other_mortgage_purposes")


def _or(a: c.Condition, b: c.Condition) -> c.Condition:
    """Either condition holds; an unknown one counts as false."""
    return c.Condition(lambda s: c.true_when(a(s)) | c.true_when(b(s)), (a, b))


_REVERSE = is_true("cac__reverse")
_NOT_REFINANCED = is_true("cacd__not_refinanced")
_NOT_EMPLOYEE = is_true("cacd__not_employee")
_HOUSING = _NOT_REFINANCED & _or(_REVERSE, is_true("cacd__mortgage"))
_BOTH = ("cac", "cacd")

MGL_MONTHLY = RuleSet("DER_MGL", (Pass("DER_MGL", ACCOUNT, (
    f.within("CNMGL001", "ltv", c.above("ltv", 0)),
    f.required_if("CMMGL001", _HOUSING, "order_of_contracts",
                  holds=c.above("order_of_contracts", 0), needs=_BOTH),
    f.required_if("CMMGL002", _NOT_EMPLOYEE & _or(_REVERSE, _or(
        is_true("cacd__mortgage"), is_true("cacd__other_mortgage"))), "ltv",
        holds=c.above("ltv", 0), needs=_BOTH),
    f.date_rule("CMMGL003", c.not_before("cac__effective_date", "sale_date"), _HOUSING,
                required="sale_date", needs=_BOTH),
    f.required_if("CMMGL004", is_true("cacd__other_mortgage"), "burden_free_flag",
                  needs=("cacd",)),
    f.placeholder_ban("CMMGL005", CAC_SINCE_CUTOVER,
                      c.equals("order_of_contracts", k.UNKNOWN_ORDER), needs=("cac",)),
    f.placeholder_ban("CMMGL006", CAC_SINCE_CUTOVER, c.sql(f"ltv = {k.UNKNOWN_AMOUNT}"),
                      needs=("cac",)),
    f.references("RIMGL001", "cacd"),
), (
    account(latest("effective_date"), any_row("reverse", c.in_codes("loan_type", "reverse_mortgage"))),
    detail(any_row("not_refinanced", c.equals("refinance_flag", k.NO)),
           any_row("not_employee", c.equals("employee_flag", k.NO)),
           any_row("mortgage", _MORTGAGE), any_row("other_mortgage", _OTHER_MORTGAGE)),
)),))

PJF_MONTHLY = RuleSet("DER_PJF", (Pass("DER_PJF", ACCOUNT, (
    f.within("CNPJF001", "estimated_value_baht", c.above("estimated_value_baht", 0)),
    f.required_if("CMPJF001", c.equals("country", k.THAILAND), "location"),
    f.references("RIPJF001", "cac"),
), (account(),)),))

_LEAD_MANAGER = c.in_codes("syndication_role", "lead_manager_loans")

SHM_MONTHLY = RuleSet("DER_SHM", (
    Pass("DER_SHM", ("msr_prd_id", "ac_id"), (
        f.must_not_be_reported("CNSHM001", is_true("cac__other_role"), ("cac",)),
        f.references("RISHM001", "cac"),
        f.references("RISHM002", "cpid"),
    ), (account(any_row("other_role", ~c.in_codes("syndication_role", "lead_manager_loans")
                        | c.blank("syndication_role"))), counterparty_id())),
    Pass("DER_CAC", ("msr_prd_id", "ac_id"), (
        f.must_be_reported("CMSHM001", _LEAD_MANAGER
                           & c.at_least("effective_date", k.SYNDICATION_START), "shm"),
    ), (lookup("shm", "DER_SHM", "ac_id"),)),
))

ACXAC_MONTHLY = RuleSet("DER_ACXAC", (Pass("DER_ACXAC", ACCOUNT, (
    f.must_differ("CNACXAC001", "prev_ac_id", "ac_id"),
    f.references("RIACXAC001", "cac"),
    f.references("RIACXAC002", "prev"),
), (account(), lookup("prev", "DER_CAC", {"prev_ac_id": "ac_id"}))),))

PLC_MONTHLY = RuleSet("DER_PLC", (Pass("DER_PLC", ACCOUNT, (
    f.date_rule("CNPLC001", c.not_before("effective_date", "cac__effective_date"), needs=("cac",)),
    f.date_rule("CNPLC002", c.not_before("end_date", "effective_date")),
    f.described_if_other("CMPLC001", c.in_codes("policy", "other_policy"), "policy_description"),
    f.references("RIPLC001", "cac"),
), (account(latest("effective_date")),)),))

GRPD_MONTHLY = RuleSet("DER_GRPD", (Pass("DER_GRPD", ACCOUNT, (
    f.date_rule("CNGRPD001", c.not_before("effective_date", "cac__effective_date"), needs=("cac",)),
    f.date_rule("CNGRPD002", c.not_before("end_date", "effective_date")),
    f.described_if_other("CMGRPD001", c.in_codes("grace_type", "other_grace_period"),
                         "grace_type_description"),
    f.references("RIGRPD001", "cac"),
), (account(latest("effective_date")),)),))

_DR_AMOUNTS = {
    "CNDR002": "post_principal_baht",
    "CNDR003": "post_interest_baht",
    "CNDR004": "days_past_due",
    "CNDR005": "principal_haircut_baht",
    "CNDR006": "interest_haircut_baht",
}
_CONDITIONAL = {
    "CNDR007": "cond_principal_haircut_baht",
    "CNDR008": "cond_interest_haircut_baht",
}

DR_MONTHLY = RuleSet("DER_DR", (Pass("DER_DR", ACCOUNT, (
    *[f.within(code, col, c.at_least(col, 0)) for code, col in _DR_AMOUNTS.items()],
    *[f.within(code, col, c.above(col, 0)) for code, col in _CONDITIONAL.items()],
    f.placeholder_ban("CMDR001", CAC_SINCE_CUTOVER, c.sql(
        f"array_contains(array(principal_haircut_baht, interest_haircut_baht, pv_loss_baht), "
        f"cast({k.UNKNOWN_AMOUNT} as decimal(18,2)))"), needs=("cac",)),
    f.placeholder_ban("CMDR002", CAC_SINCE_CUTOVER,
                      c.sql(f"cond_principal_haircut_baht = {k.UNKNOWN_AMOUNT}"), needs=("cac",)),
    f.placeholder_ban("CMDR003", CAC_SINCE_CUTOVER,
                      c.sql(f"cond_interest_haircut_baht = {k.UNKNOWN_AMOUNT}"), needs=("cac",)),
    f.references("RIDR001", "cac"),
), (account(latest("effective_date")),)),))

DRM_MONTHLY = RuleSet("DER_DRM", (Pass("DER_DRM", ACCOUNT, (
    f.described_if_other("CNDRM001", c.in_codes("method", "other_dr_method"), "method_description"),
    f.references("RIDRM001", "dr"),
), (lookup("dr", "DER_DR", "ac_id"),)),))

LOP_MONTHLY = RuleSet("DER_LOP", (Pass("DER_LOP", ACCOUNT, (
    f.date_rule("CNLOP001", c.not_before("legal_operation_date", "cac__effective_date"),
                needs=("cac",)),
    f.references("RILOP001", "cac"),
), (account(latest("effective_date")),)),))
