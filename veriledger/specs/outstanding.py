"""Rule sets of outstanding balances, transaction flows and what hangs on them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriledger.operators import conditions as c
from veriledger.operators import families as f
from veriledger.operators.reconcile import Against, Balance, Reconciliation, Side
from veriledger.operators.ruleset import Pass, RuleSet, View, any_row, latest
from veriledger.specs import codes as k
from veriledger.specs.shared import (
    CONTINGENT,
    NOT_CONTINGENT,
    NOT_OVERDRAFT,
    account,
    detail,
    is_true,
    lookup,
)

ACCOUNT = ("ac_id",)
TRANSACTION = ("txn_id",)

# per rule: loan class of the accounts, list of the positions, and whether the later text asks for
# equality
_POSITIONS = {
    "CMOTDD001": ("onshore_lending", "onshore_lending_positions", False),
    "CMOTDD002": ("offshore_lending", "offshore_lending_positions", False),
    "CMOTDD003": ("overdraft_from_deposit", "overdraft_positions", True),
    "CMOTDD004": ("foreign_bill_inward", "bill_inward_positions", False),
    "CMOTDD005": ("foreign_bill_outward", "bill_outward_positions", True),
}


def _outstanding_daily(first_phase: bool) -> RuleSet:
    closed = "inactive_or_closed_status" if first_phase else "closed_status"
    barred = any_row("barred", c.in_codes("loan_type", "baht_loans", "credit_card_loans",
                                          "contingent_loans", "offshore_branch_loans"))
    rules = (
        f.must_not_be_reported("CNOTDD001", is_true("cac__barred"), ("cac",)),
        f.within("CNOTDD002", "otsnd_amt_in_orig_ccy", c.at_least("otsnd_amt_in_orig_ccy", 0)),
        f.must_not_be_reported("CNOTDD003", is_true("cac__closed"), ("cac",)),
        f.references("RIOTDD001", "cac"),
    )
    cac = account(barred, any_row("closed", c.in_codes("account_status", closed)))
    classes = account(*[any_row(loans, c.in_codes("loan_type", loans))
                        for loans, _, _ in _POSITIONS.values()])
    balances = tuple(
        Balance(code, Side("otsnd_amt_in_orig_ccy", is_true(f"cac__{loans}")),
                Side("fc_amount", c.in_codes("position_item", positions)),
                at_least=first_phase or not equal)
        for code, (loans, positions, equal) in _POSITIONS.items())
    positions = Reconciliation("DER_OTDD", (Against("DS_FCP", balances),), left_lookups=(classes,))
    return RuleSet("DER_OTDD", (Pass("DER_OTDD", ACCOUNT, rules, (cac,)),), (positions,))


OTDD_DAILY = _outstanding_daily(first_phase=False)
OTDD_P1 = _outstanding_daily(first_phase=True)


def _ledger(entity: str, groups: dict[str, str]) -> View:
    """Ledger rows of the reported groups, with the organisation each group stands for."""

    def build(tables, codes) -> DataFrame:
        org = F.lit(None).cast("string")
        for name, group in groups.items():
            org = F.when(F.col("fi_rpt_grp_id") == group, name).otherwise(org)
        ledger = tables[entity].filter(F.col("fi_rpt_grp_id").isin(list(groups.values())))
        return ledger.withColumn("org_id", org)

    return View(f"{entity}_reported", build, (entity,))


_BALANCE_SHEET = _ledger("DS_BLS", k.BALANCE_SHEET_GROUPS)
_PROVISIONS = _ledger("DS_PVS", k.PROVISION_GROUPS)
_QUARTER_END = c.sql("month(data_dt) in (3, 6, 9, 12)")

_NOT_NEGATIVE = {
    "CNOTDM001": "accrued_fee_baht",
    "CNOTDM002": "accrued_interest_baht",
    "CNOTDM003": "undue_interest_baht",
    "CNOTDM004": "contractual_interest_baht",
    "CNOTDM006": "uern_rev_in_orig_ccy",
    "CNOTDM007": "uern_rev_in_baht",
    "CNOTDM008": "suspended_baht",
    "CNOTDM009": "days_past_due",
}

_LEDGER_GROUP = ("ds_dt", "org_id")

OTDM_BALANCES = Reconciliation("DER_OTDM", (
    Against(_BALANCE_SHEET.name, (
        Balance("CMOTDM003", Side("otsnd_amt_in_baht"),
                Side("bsh_amt", c.one_of("bsh_itm_tp_id", *k.BALANCE_SHEET_ITEMS))),
    ), _LEDGER_GROUP),
    Against(_PROVISIONS.name, tuple(
        Balance(code,
                Side("otsnd_amt_in_baht", c.equals("ast_and_cntg_clss", account_class) & _QUARTER_END,
                     minus="uern_rev_in_baht"),
                Side("amt", c.equals("ast_cl_tp_id", provision_class)
                     & c.equals("prvn_smy_itm_tp_id", k.PROVISION_ITEM)))
        for code, (account_class, provision_class) in k.CLASS_PAIRS.items()
    ), _LEDGER_GROUP),
))

OTDM_P1 = RuleSet("DER_OTDM", (Pass("DER_OTDM", ACCOUNT, (
    *[f.within(code, col, c.at_least(col, 0)) for code, col in _NOT_NEGATIVE.items()],
    f.within("CNOTDM005", "current_eir", c.between("current_eir", 0, 100)),
    f.required_if("CMOTDM001", is_true("cac__not_contingent"), "accrued_interest_baht",
                  "undue_interest_baht", "contractual_interest_baht", "current_eir",
                  "uern_rev_in_orig_ccy", "uern_rev_in_baht", "days_past_due", needs=("cac",)),
    f.required_within("CMOTDM002", is_true("cacd__regulated"), "total_rate",
                      c.between("total_rate", 0, 100), needs=("cacd",)),
    f.Rule("CMOTDM009", "V2", c.in_codes("account_status", "inactive_or_closed_status")
           & c.sql("coalesce(otsnd_amt_in_orig_ccy <> 0, false) "
                   "or coalesce(otsnd_amt_in_baht <> 0, false)")),
    f.required_if("CMOTDM010", is_true("cac__contingent"), "credit_equivalent_baht",
                  holds=c.at_least("credit_equivalent_baht", 0), needs=("cac",)),
    f.required_if("CMOTDM011", is_true("cac__classified"), "ast_and_cntg_clss", "class_reason",
                  needs=("cac",)),
    f.references("RIOTDM001", "cacd"),
), (
    account(any_row("contingent", CONTINGENT), any_row("not_contingent", NOT_CONTINGENT),
            any_row("classified", c.in_codes("loan_type", "loans", "aval_to_bills",
                                             "bill_certifications", "loan_guarantees",
                                             "unconditional_loan_guarantees"))),
    detail(any_row("regulated", c.filled("regulated_product"))),
)),), (OTDM_BALANCES,), views=(_BALANCE_SHEET, _PROVISIONS))


# conditions on a transaction flow row, as facts of the lookup `txf`
_TXF_FACTS = {
    "debt_instrument": c.in_codes("purpose", "debt_instrument_purposes"),
    "portfolio": c.in_codes("purpose", "portfolio_purposes"),
    "borrowing": c.in_codes("purpose", "borrowing_purposes"),
    "lending": c.in_codes("purpose", "lending_purposes"),
    "increasing_foreign_loan": c.in_codes("purpose", "foreign_loan_purpose")
    & c.in_codes("mvmt_tp", "increasing_loan"),
    "decreasing_borrowing": c.in_codes("purpose", "borrowing_purposes")
    & c.in_codes("mvmt_tp", "decreasing_loan"),
    "increasing_lending": c.in_codes("purpose", "lending_purposes")
    & c.in_codes("mvmt_tp", "increasing_loan"),
    "increasing_borrowing": c.in_codes("purpose", "borrowing_purposes")
    & c.in_codes("mvmt_tp", "increasing_loan"),
}


def _txf(name: str) -> c.Condition:
    return c.Condition(lambda s: c.true_when(F.col(f"txf__{name}")))


_LENT = is_true("cac__not_overdraft")
_BOTH = ("txf", "cac")
_DATED = ~c.in_codes("term_range", "open_term_ranges")

RLI_DAILY = RuleSet("DER_RLI", (
    Pass("DER_RLI", TRANSACTION, (
        f.iff_filled("CMRLI001", _txf("debt_instrument") & _LENT, "investment_type", needs=_BOTH),
        f.required_if("CMRLI002", c.in_codes("investment_type", "portfolio_investment"),
                      "instrument_type"),
        f.iff_filled("CMRLI003", c.Condition(lambda s: c.true_when(
            (c.in_codes("instrument_type", "bond_instruments") & _txf("portfolio") & _LENT)(s)
        ) | c.true_when(((_txf("borrowing") | _txf("lending")) & _LENT)(s))), "term_range",
            needs=_BOTH),
        f.iff_filled("CMRLI008", _txf("increasing_foreign_loan") & _LENT, "repayment_due_ind",
                     needs=_BOTH),
        f.iff_filled("CMRLI009", _DATED & _LENT
                     & (_txf("decreasing_borrowing") | _txf("increasing_lending")),
                     "maturity_date", needs=_BOTH),
        f.iff_filled("CMRLI010", _txf("increasing_borrowing") & _LENT, "loan_declaration_type",
                     needs=_BOTH),
        f.references("RIRLI001", "txf"),
    ), (
        lookup("txf", "DER_TXF", "txn_id", latest("ac_id"),
               *[any_row(name, test) for name, test in _TXF_FACTS.items()]),
        account(any_row("not_overdraft", NOT_OVERDRAFT), on="txf__ac_id"),
    )),
    Pass("DER_TXF", TRANSACTION, (
        f.must_be_reported("CMRLI011", c.in_codes(
            "purpose", "portfolio_purposes", "borrowing_purposes", "lending_purposes") & _LENT,
            "rli", needs=("cac",)),
    ), (
        account(any_row("not_overdraft", NOT_OVERDRAFT)),
        lookup("rli", "DER_RLI", "txn_id"),
    )),
))

_FLOW = lookup("txf", "DER_TXF", "txn_id")

BRD_DAILY = RuleSet("DER_BRD", (Pass("DER_BRD", TRANSACTION, (
    f.required_if("CMBRD001", c.in_codes("bot_doc_tp", "approval_document"), "bot_doc_date"),
    f.references("RIBRD001", "txf"),
), (_FLOW,)),))

RDA_DAILY = RuleSet("DER_RDA", (
    Pass("DER_RDA", TRANSACTION, (f.references("RIRDA001", "txf"),), (_FLOW,)),
))
