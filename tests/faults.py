"""Planted faults per job: (rules that must fire, changes to a clean world)."""

from datetime import date as D

BLANK = "   "


def one(code, **changes):
    """A fault in the job's own entity: code and changed columns."""
    return ([code], {None: changes})


def gone(code, entity):
    """A missing row of another entity."""
    return ([code], {entity: None})


UNKNOWN_UNIT = "unknown_term_unit"
DAILY_CAC = [
    one("CNCAC001", share_lending_total_baht=0),
    one("CNCAC002", contract_amount_oc=-1),
    one("CMCAC001", maturity_date=None),
    one("CMCAC001", maturity_date=D(2024, 1, 1)),
    one("CMCAC002", term_type=BLANK),
    one("CMCAC003", n_principal=0),
    one("CMCAC003", principal_freq=None),
    one("CMCAC004", principal_freq_unit=BLANK, n_principal=1),
    one("CMCAC005", n_interest=None),
    one("CMCAC005", interest_freq=-1),
    one("CMCAC006", principal_freq_unit=UNKNOWN_UNIT, payment_freq_condition=BLANK),
    one("CMCAC006", interest_freq_unit=UNKNOWN_UNIT, payment_freq_condition=None),
    one("CMCAC007", loan_type="bills_of_exchange", been_extended_flag=None),
    one("CMCAC008", payment_freq_condition="Initial Data"),
    one("CMCAC009", interest_freq_unit=None),
    gone("RICAC001", "DER_CPEN"),
    # clean variants: nothing fires
    ([], {None: dict(share_lending_total_baht=None, contract_amount_oc=0)}),
    ([], {None: dict(ccy="THB", n_principal=None, n_interest=None)}),
    ([], {None: dict(payment_freq_condition="Initial Data", effective_date=D(2023, 9, 30))}),
    ([], {None: dict(loan_type="contingent_loans", term_type=None)}),
    ([], {None: dict(maturity_date=D(2024, 1, 2))}),
]
MONTHLY_CAC = [
    one("CNCAC001", share_lending_total_oc=-5),
    one("CNCAC002", contract_amount_oc=-1),
    one("CMCAC001", maturity_date=D(2023, 1, 1)),
    one("CMCAC002", term_type=None),
    one("CMCAC003", n_principal=0, ccy="THB"),
    (["CMCAC004", "CMCAC009"], {None: dict(interest_freq_unit=BLANK)}),
    one("CMCAC004", principal_freq_unit=None),
    one("CMCAC005", n_interest=0),
    one("CMCAC006", interest_freq_unit=UNKNOWN_UNIT, payment_freq_condition=None),
    one("CMCAC007", loan_type="bills_of_exchange", been_extended_flag=BLANK),
    one("CMCAC008", payment_freq_condition="Initial Data"),
    (["CMCAC009"], {None: dict(interest_freq_unit=None, term_type="open")}),
    gone("RICAC001", "DER_CPEN"),
]
MONTHLY_CACD = [
    one("CNCACD001", open_date=D(2023, 12, 31)),
    (["CMCACD002"], {"DER_CAC": dict(loan_type="contingent_loans"), None: dict(notional_oc=0)}),
    (["CMCACD002"], {"DER_CAC": dict(loan_type="contingent_loans"), None: dict(notional_baht=None)}),
    (["CMCACD003"], {"DER_CAC": dict(loan_type="first_payment_loans"),
                     None: dict(account_purpose="consumption_purposes", lending_business_type=None,
                                frst_pymt_amt_in_orig_ccy=None)}),
    one("CMCACD004", lending_business_type=BLANK),
    one("CMCACD004", account_purpose="consumption_purposes"),
    one("CMCACD005", refinance_flag=None),
    one("CMCACD005", related_lending_flag=BLANK),
    one("CMCACD006", account_purpose="consumption_purposes", lending_business_type=None,
        digital_loan_flag=None),
    one("CMCACD007", bridge_loan_flag=None),
    one("CMCACD007", country_to_invest=BLANK),
    one("CMCACD009", total_rate=101),
    one("CMCACD009", total_rate=None),
    one("CMCACD009", factor=None),
    one("CMCACD010", account_purpose=None),
    one("CMCACD011", frst_pymt_amt_in_orig_ccy="0.01"),
    one("CMCACD012", country_to_invest="unclassified"),
    gone("RICACD001", "DER_CAC"),
    gone("RICACD002", "DER_CL"),
    gone("RICACD003", "DER_PRT"),
    gone("RICACD004", "DER_PPG"),
    ([], {None: dict(credit_line_id=None, product_program_id=BLANK)}),
    ([], {"DER_CAC": dict(effective_date=D(2023, 9, 30)), None: dict(country_to_invest="unclassified")}),
]
P1_CACD = [
    one("CNCACD001", open_date=D(2023, 12, 31)),
    (["CMCACD002"], {"DER_CAC": dict(loan_type="contingent_loans"), None: dict(notional_oc=None)}),
    one("CMCACD003", frst_pymt_amt_in_orig_ccy=0),
    one("CMCACD004", lending_business_type=None),
    one("CMCACD005", original_eir=101),
    one("CMCACD005", employee_flag=None),
    one("CMCACD006", account_purpose="consumption_purposes", lending_business_type=None,
        digital_loan_flag=None),
    one("CMCACD007", country_to_invest=None),
    one("CMCACD008", interbank_flag=None),
    one("CMCACD008", account_purpose="other_purposes", interbank_flag=BLANK),
    one("CMCACD009", total_rate=-1),
    gone("RICACD001", "DER_CAC"),
    gone("RICACD002", "DER_CL"),
    gone("RICACD003", "DER_PRT"),
    gone("RICACD004", "DER_PPG"),
]
FXL = [
    (["CNFXL001"], {"DER_CAC": dict(loan_type="baht_loans")}),
    (["CNFXL001"], {"DER_CAC": dict(loan_type="contingent_loans")}),
    one("CNFXL002", first_disbursement_date=D(2024, 1, 1)),
    one("CMFXL001", put_date=None),
    one("CMFXL001", put_amount_oc=None),
    one("CMFXL002", call_date=None),
    one("CMFXL003", n_disbursement=None),
    one("CMFXL003", first_payment_date=None),
    gone("RIFXL001", "DER_CAC"),
    gone("RIFXL002", "DER_CPID"),
    # a parent row that occurs twice changes nothing
    ([], {"DER_CAC": [{}, {}]}),
    (["CMFXL002"], {"DER_CAC": [{}, {}], None: dict(call_amount_oc=None)}),
]
HOUSE = {"DER_CACD": dict(account_purpose="mortgage_purposes")}
OTHER_HOUSE = {"DER_CACD": dict(account_purpose="other_mortgage_purposes")}
MGL = [
    one("CNMGL001", ltv=0),
    (["CMMGL001"], {**HOUSE, None: dict(order_of_contracts=0)}),
    (["CMMGL001"], {"DER_CAC": dict(loan_type="reverse_mortgage"), None: dict(order_of_contracts=None)}),
    (["CMMGL002"], {**OTHER_HOUSE, None: dict(ltv=None)}),
    (["CMMGL003"], {**HOUSE, None: dict(sale_date=D(2024, 1, 3))}),
    (["CMMGL003"], {**HOUSE, None: dict(sale_date=None)}),
    (["CMMGL004"], {**OTHER_HOUSE, None: dict(burden_free_flag=BLANK)}),
    one("CMMGL005", order_of_contracts=9999),
    one("CMMGL006", ltv="0.01"),
    gone("RIMGL001", "DER_CACD"),
    ([], {None: dict(order_of_contracts=None, ltv=None, sale_date=None)}),
]
PJF = [
    one("CNPJF001", estimated_value_baht=0),
    one("CMPJF001", location=None),
    gone("RIPJF001", "DER_CAC"),
    ([], {None: dict(country="SG", location=None)}),
]
SHM = [
    (["CNSHM001"], {"DER_CAC": dict(syndication_role="member")}),
    gone("CMSHM001", "DER_SHM"),
    ([], {"DER_SHM": None, "DER_CAC": dict(effective_date=D(2022, 12, 31))}),
    gone("RISHM001", "DER_CAC"),
    gone("RISHM002", "DER_CPID"),
]
ACXAC = [
    (["CNACXAC001"], {None: dict(prev_ac_id="A#f0")}),
    gone("RIACXAC001", "DER_CAC"),
    one("RIACXAC002", prev_ac_id="none"),
]


def _dated(entity, kind, text):
    return [
        one(f"CN{entity}001", effective_date=D(2024, 1, 1)),
        one(f"CN{entity}002", end_date=D(2024, 1, 1)),
        (([f"CM{entity}001"]), {None: {text: BLANK}}),
        gone(f"RI{entity}001", "DER_CAC"),
        ([], {None: {text: None, kind: "named"}}),
        ([], {None: dict(end_date=None)}),
    ]


PLC = _dated("PLC", "policy", "policy_description")
GRPD = _dated("GRPD", "grace_type", "grace_type_description")
DR = [
    one("CNDR002", post_principal_baht=-1),
    one("CNDR003", post_interest_baht=-1),
    one("CNDR004", days_past_due=-1),
    one("CNDR005", principal_haircut_baht=-1),
    one("CNDR006", interest_haircut_baht=-1),
    one("CNDR007", cond_principal_haircut_baht=0),
    one("CNDR008", cond_interest_haircut_baht=0),
    one("CMDR001", pv_loss_baht="0.01"),
    one("CMDR001", principal_haircut_baht="0.01", interest_haircut_baht=None),
    one("CMDR002", cond_principal_haircut_baht="0.01"),
    one("CMDR003", cond_interest_haircut_baht="0.01"),
    gone("RIDR001", "DER_CAC"),
    ([], {None: dict(pv_loss_baht="0.01"), "DER_CAC": dict(effective_date=D(2023, 9, 30))}),
    ([], {None: dict(cond_principal_haircut_baht=None)}),
]
DRM = [one("CNDRM001", method_description=None), gone("RIDRM001", "DER_DR")]
LOP = [one("CNLOP001", legal_operation_date=D(2024, 1, 1)), gone("RILOP001", "DER_CAC")]

COL = [
    one("CMCOL001", registration_flag=None),
    (["CMCOL001"], {None: dict(registration_flag=BLANK), "DER_LND": None}),
    ([], {None: dict(registration_flag=None), "DER_LND": None, "DER_BLD": None}),
    ([], {None: dict(registration_flag=None), "DER_LND": dict(country="SG"),
          "DER_BLD": dict(country="SG")}),
]
LND = [
    one("CNLND001", land_area=0),
    one("CMLND001", ownership_flag=None),
    one("CMLND002", dopa_location=None),
    gone("RILND001", "DER_COL"),
    ([], {None: dict(country="SG", ownership_flag=None, dopa_location=None)}),
]
HOME = dict(account_purpose="residential_purchase_purposes")
BLD = [
    one("CMBLD001", dopa_location=None),
    one("CMBLD001", n_floors=0),
    one("CMBLD001", area_utilization=None),
    (["CMBLD002"], {"DER_CACD": HOME, None: dict(developer_type=None)}),
    one("CMBLD003", project_name=BLANK),
    (["CMBLD004"], {"DER_COL": dict(collateral_type="building_or_land_with_building"),
                    None: dict(completion_year=None)}),
    one("CMBLD005", floor_number=None),
    gone("RIBLD001", "DER_COL"),
    ([], {None: dict(developer_type=None)}),
    ([], {"DER_CACD": HOME, "DER_CLP": None, None: dict(developer_type=None)}),
]
RER = [
    one("RIRER001", land_collateral_id="none#{w}"),
    one("RIRER002", building_collateral_id="none"),
]
CVG = [gone("RICVG001", "DER_COL")]
GE = [
    (["CMGE001", "RIGE001"], {None: dict(guarantor_name=None, cntpr_id=BLANK)}),
    gone("RIGE001", "DER_CPID"),
]
PVG = [gone("RIPVG001", "DER_CVG")]

BAD_ID = "1101700230707"
RERUN_CPID = [
    one("CNCPID001", id_no=BAD_ID),
    one("CNCPID001", id_no=None),
    one("CNCPID002", id_type="tax_id", id_no="110170023070"),
    one("CNCPID003", id_type="juristic_id", id_no="x101700230708"),
    one("CNCPID004", id_type="cooperative_id", id_no=BAD_ID),
    one("CMCPID001", id_type="offshore_branch_number", branch_fi_code=BLANK),
    one("CMCPID001", id_type="offshore_branch_number", branch_fi_code="none"),
    (["CMCPID002"], {"DER_JCP": None, "DER_OCP": None}),
    ([], {"DER_JCP": None}),
    ([], {"DER_JCP": None, "DER_OCP": None, None: dict(id_type="exempt_id")}),
    ([], {None: dict(id_type="passport", id_no=BAD_ID)}),
]
CPID = RERUN_CPID + [
    one("CMCPID003", id_type_country="unclassified"),
    ([], {None: dict(id_type_country="unclassified"),
          "DER_APP": dict(application_date=D(2023, 9, 30))}),
]
JCP = [
    one("CMJCP002", juristic_date=D(1753, 12, 31)),
    one("CMJCP003", name_thai=BLANK),
    one("CMJCP004", hq_nationality="unclassified"),
    one("CMJCP004", registered_country="unclassified"),
    gone("RIJCP001", "DER_CPID"),
    ([], {None: dict(registered_country="unclassified", data_dt=D(2023, 9, 30))}),
]
OCP = [
    one("CNOCP001", birthdate=D(1753, 1, 1)),
    one("CMOCP002", first_name_en=None),
    one("CMOCP003", last_name_th=BLANK),
    gone("RIOCP001", "DER_CPID"),
    one("CMOCP004", nationality="unclassified"),
]
P1_BLP = [
    one("CNBLP001", labor=-1),
    (["CNBLP002"], {None: dict(domestic_income_baht=-1, export_income_baht=1)}),
    one("CMBLP002", factory_location=None),
    one("CMBLP003", domestic_income_baht=0, export_income_baht=0),
    one("CMBLP003", domestic_income_baht=0),
    one("CMBLP003", export_income_baht=-1),
    gone("RIBLP001", "DER_CPID"),
    ([], {None: dict(domestic_income_baht=0, export_income_baht=1)}),
]
BLP = P1_BLP + [
    gone("CMBLP001", "DER_BLP"),
    ([], {"DER_BLP": None, "DER_CACD": dict(interbank_flag="1")}),
    ([], {"DER_BLP": None, "DER_CPEN": None}),
]
PLP = [
    one("CNPLP001", other_debt_burden_baht=-1),
    (["CMPLP001"], {None: None, "DER_CACD": dict(account_purpose="consumption_purposes")}),
    one("CMPLP002", employment_characteristic=None),
    one("CMPLP002", employment_status="unemployed"),
    one("CMPLP004", income_baht=-1),
    one("CMPLP005", contact_location=None),
    (["CMPLP005"], {None: dict(contact_location=BLANK), "DER_CPID": dict(id_type="passport")}),
    gone("RIPLP001", "DER_CPID"),
    ([], {None: None}),
    ([], {None: dict(employment_status="unemployed", occupation="unemployed_occupations")}),
    ([], {None: dict(income_baht=-1), "DER_CACD": dict(employee_flag="1")}),
    ([], {None: dict(contact_location=None), "DER_CPID": dict(id_type="passport"),
          "DER_OCP": dict(residence_country="SG")}),
]
RTR = [
    (["CMRTR001"], {None: None, "DER_CACD": dict(related_lending_flag="1")}),
    gone("RIRTR001", "DER_CPID"),
    ([], {None: None}),
]
CPEN = [gone("RICPEN001", "DER_CPID")]
CPDG = [gone("RICPDG001", "DER_DG"), gone("RICPDG002", "DER_CPID")]

CL = [
    one("CNCL001", approve_date=D(2024, 1, 2)),
    one("CNCL002", line_amount_oc=-1),
    one("CMCL001", level_number=1),
    one("CMCL001", root_credit_line_id="L#clean"),
    one("CMCL001", parent_credit_line_id="L#clean"),
    gone("RICL001", "DER_CPEN"),
    one("RICL002", root_credit_line_id="L#clean", parent_credit_line_id="none", level_number=1),
    one("RICL003", root_credit_line_id="none", parent_credit_line_id="L#clean", level_number=1),
    gone("RICL004", "DER_APP"),
    ([], {None: dict(application_id=None)}),
    ([], {None: dict(root_credit_line_id="L#clean", parent_credit_line_id="L#clean",
                     level_number=1)}),
]
CLLT = [gone("RICLLT001", "DER_CL")]
CLP = [
    one("CNCLP001", protection_amount_baht=0),
    gone("RICLP001", "DER_CL"),
    gone("RICLP002", "DER_COLP"),
    ([], {None: dict(protection_id="U#clean")}),
    ([], {None: dict(protection_id="X#clean")}),
    ([], {None: dict(protection_amount_baht=None)}),
]
COLP = [
    one("CNCOLP001", pledge_amount_baht=-1),
    one("CMCOLP001", mortgage_seq_no=0),
    gone("RICOLP001", "DER_PVG"),
    ([], {None: dict(mortgage_seq_no=0), "DER_COL": dict(collateral_type="car")}),
    ([], {None: dict(mortgage_seq_no=0), "DER_LND": None, "DER_BLD": dict(country="SG")}),
]
OVD = [gone("RIOVD001", "DER_CL")]

INTP = [
    one("CNINTP001", rate_end_date=D(2023, 12, 31)),
    one("CNINTP002", tier_threshold=-1),
    one("CMINTP002", calculation_description=None),
    (["CMINTP003"], {"DER_INTR": dict(rate_type="MLR")}),
    one("CMINTP004", fix_rate_margin=None),
    one("CMINTP004", fix_rate_qted_fm_refr_rate_id=None),
    gone("RIINTP001", "DER_CAC"),
    one("RIINTP002", reference_rate_id="none"),
    one("RIINTP003", fix_rate_qted_fm_refr_rate_id="none"),
    ([], {None: dict(rate_end_date=None)}),
    ([], {None: dict(fix_rate_qted_fm_refr_rate_id=BLANK, fix_rate_margin=None),
          "DER_INTR": dict(rate_type="MLR")}),
]
INTR = [
    one("CMINTR001", rate_type="other_rate_type"),
    one("CMINTR002", rate_type="BIBOR", tenor=0),
    one("CMINTR002", rate_type="EURIBOR", tenor_unit=BLANK),
    ([], {None: dict(rate_type="MLR", tenor=None)}),
]
INTRV = [gone("RIINTRV001", "DER_INTR")]


def _positions(code, loans, positions, equal):
    over = {"DER_CAC": dict(loan_type=loans, account_status="open")}
    more = {"DS_FCP": dict(position_item=positions, fc_amount=6)}
    same = {"DS_FCP": dict(position_item=positions, fc_amount=5)}
    less = {"DS_FCP": dict(position_item=positions, fc_amount=4)}
    return [([code], {**over, **more}), ([], {**over, **same}),
            ([code] if equal else [], {**over, **less})]


def _otdd(closed, equal):
    return [
        (["CNOTDD001"], {"DER_CAC": dict(loan_type="baht_loans")}),
        (["CNOTDD001"], {"DER_CAC": dict(loan_type="offshore_branch_loans")}),
        one("CNOTDD002", otsnd_amt_in_orig_ccy=-1),
        (["CNOTDD003"], {"DER_CAC": dict(account_status=closed)}),
        gone("RIOTDD001", "DER_CAC"),
        *_positions("CMOTDD001", "onshore_lending", "onshore_lending_positions", False),
        *_positions("CMOTDD002", "offshore_lending", "offshore_lending_positions", False),
        *_positions("CMOTDD003", "overdraft_from_deposit", "overdraft_positions", equal),
        *_positions("CMOTDD004", "foreign_bill_inward", "bill_inward_positions", False),
        *_positions("CMOTDD005", "foreign_bill_outward", "bill_outward_positions", equal),
    ]


OTDD = _otdd("closed_status", True)
P1_OTDD = _otdd("inactive_or_closed_status", False)

CONTINGENT = {"DER_CAC": dict(loan_type="contingent_loans")}
OTDM = [
    one("CNOTDM001", accrued_fee_baht=-1),
    one("CNOTDM002", accrued_interest_baht=-1),
    one("CNOTDM003", undue_interest_baht=-1),
    one("CNOTDM004", contractual_interest_baht=-1),
    one("CNOTDM005", current_eir=101),
    one("CNOTDM006", uern_rev_in_orig_ccy=-1),
    one("CNOTDM007", uern_rev_in_baht=-1),
    one("CNOTDM008", suspended_baht=-1),
    one("CNOTDM009", days_past_due=-1),
    one("CMOTDM001", undue_interest_baht=None),
    one("CMOTDM001", days_past_due=None),
    one("CMOTDM002", total_rate=None),
    one("CMOTDM002", total_rate=101),
    one("CMOTDM009", account_status="inactive_or_closed_status", otsnd_amt_in_orig_ccy=1),
    (["CMOTDM010"], {**CONTINGENT, None: dict(credit_equivalent_baht=None)}),
    (["CMOTDM010"], {**CONTINGENT, None: dict(credit_equivalent_baht=-1)}),
    one("CMOTDM011", class_reason=BLANK),
    one("CMOTDM011", ast_and_cntg_clss=None),
    gone("RIOTDM001", "DER_CACD"),
    ([], {**CONTINGENT, None: dict(undue_interest_baht=None)}),
    ([], {"DER_CACD": dict(regulated_product=None), None: dict(total_rate=None)}),
]


def _txf(purpose, movement):
    return {"DER_TXF": dict(purpose=purpose, mvmt_tp=movement)}


EMPTY = dict(term_range=None, loan_declaration_type=None)
RLI = [
    (["CMRLI001"], {**_txf("debt_instrument_purposes", "x"), None: EMPTY}),
    one("CMRLI001", investment_type="direct"),
    (["CMRLI001", "CMRLI002"], {None: dict(investment_type="portfolio_investment")}),
    one("CMRLI003", term_range=BLANK),
    (["CMRLI003"], {**_txf("portfolio_purposes", "x"),
                    None: dict(EMPTY, instrument_type="bond_instruments")}),
    (["CMRLI003"], {**_txf("portfolio_purposes", "x"), None: dict(EMPTY, term_range="y")}),
    (["CMRLI008"], {**_txf("foreign_loan_purpose", "increasing_loan"), None: EMPTY}),
    one("CMRLI008", repayment_due_ind="x"),
    (["CMRLI009"], {**_txf("lending_purposes", "increasing_loan"),
                    None: dict(loan_declaration_type=None)}),
    one("CMRLI009", maturity_date=D(2024, 1, 1)),
    one("CMRLI010", loan_declaration_type=BLANK),
    gone("CMRLI011", "DER_RLI"),
    ([], {"DER_RLI": None, "DER_TXF": dict(purpose="other")}),
    ([], {"DER_RLI": None, "DER_CAC": dict(loan_type="overdraft")}),
    ([], {"DER_CAC": dict(loan_type="overdraft"), None: EMPTY}),
    (["RIRLI001"], {"DER_TXF": None, None: EMPTY}),
]
BRD = [one("CMBRD001", bot_doc_date=None), gone("RIBRD001", "DER_TXF")]
RDA = [gone("RIRDA001", "DER_TXF")]


def _by_type(prefix):
    kinds = ["account", "credit_line", "counterparty", "entity"]
    ids = {"account": "A#clean", "credit_line": "L#clean", "counterparty": "P#clean",
           "entity": "E#clean"}
    bad = [one(f"{prefix}{i:03}", reference_type=f"reference_{kind}", reference_id="none#{w}")
           for i, kind in enumerate(kinds, 1)]
    good = [([], {None: dict(reference_type=f"reference_{kind}", reference_id=ids[kind])})
            for kind in kinds]
    return bad + good


REV = [one("CNREV001", review_date=D(2024, 4, 1)), *_by_type("RIREV")]
RSK = [
    one("CNRSK001", assessment_date=D(2024, 4, 1)),
    one("CMRSK001", risk_measure="Internal Credit Rating", model_reference=None),
    one("CMRSK002", risk_value="n/a"),
    one("CMRSK002", risk_value=None),
    one("CMRSK002", risk_measure="Watch List Flag", risk_value="2"),
    *_by_type("RIRSK"),
    ([], {None: dict(risk_measure="Watch List Flag", risk_value="0")}),
    ([], {None: dict(risk_measure="Grade", risk_value="AA")}),
]

FAULTS = {
    "daily_cpid": CPID, "rerun_daily_cpid": RERUN_CPID, "daily_jcp": JCP, "daily_ocp": OCP,
    "daily_cac": DAILY_CAC, "daily_fxl": FXL, "daily_otdd": OTDD, "daily_rli": RLI,
    "daily_brd": BRD, "daily_rda": RDA, "daily_cpen": CPEN, "daily_intp": INTP, "daily_intr": INTR,
    "daily_intrv": INTRV, "monthly_grpd": GRPD, "monthly_dr": DR, "monthly_drm": DRM,
    "monthly_lop": LOP, "monthly_cac": MONTHLY_CAC, "monthly_cacd": MONTHLY_CACD,
    "monthly_mgl": MGL, "monthly_pjf": PJF, "monthly_shm": SHM, "monthly_acxac": ACXAC,
    "monthly_plc": PLC, "monthly_cl": CL, "monthly_cllt": CLLT, "monthly_clp": CLP,
    "monthly_colp": COLP, "monthly_ovd": OVD, "monthly_col": COL, "monthly_rer": RER,
    "monthly_cvg": CVG, "monthly_ge": GE, "monthly_pvg": PVG, "monthly_blp": BLP,
    "monthly_rtr": RTR, "monthly_cpen": CPEN, "monthly_cpdg": CPDG, "monthly_intr": INTR,
    "monthly_rev": REV, "p1_daily_otdd": P1_OTDD, "p1_daily_cpen": CPEN, "p1_monthly_cacd": P1_CACD,
    "p1_monthly_otdm": OTDM, "p1_monthly_lnd": LND, "p1_monthly_bld": BLD, "p1_monthly_blp": P1_BLP,
    "p1_monthly_plp": PLP, "p1_monthly_cpen": CPEN, "p1_monthly_cpdg": CPDG, "p1_monthly_rsk": RSK,
}
