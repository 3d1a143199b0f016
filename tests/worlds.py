"""Small worlds of linked entity rows: a clean one, and one per planted fault.

Every id of a world carries the world's name after ``#``, so a violation key tells its world.
"""

import datetime
from decimal import Decimal

from veriledger.specs.entities import ENTITIES

D = datetime.date


def clean(w):
    ac, ent, cp = f"A#{w}", f"E#{w}", f"P#{w}"
    line, pledge, group, col = f"L#{w}", f"G#{w}", f"V#{w}", f"C#{w}"
    txn = f"T#{w}"
    return {
        "DER_CAC": dict(
            ac_id=ac, ent_id=ent, ccy="USD", loan_type="loans", term_type="fixed_term",
            account_status="open", principal_freq_unit="M", interest_freq_unit="M",
            payment_freq_condition="x", been_extended_flag="0",
            syndication_role="lead_manager_loans", contract_date=D(2024, 1, 1),
            effective_date=D(2024, 1, 2), maturity_date=D(2025, 1, 1), share_lending_total_baht=10,
            share_lending_total_oc=10, contract_amount_oc=100, n_principal=1, principal_freq=1,
            n_interest=1, interest_freq=1),
        "DER_CACD": dict(
            ac_id=ac, credit_line_id=line, portfolio_id=f"F#{w}", product_program_id=f"R#{w}",
            account_purpose="commercial_purposes", lending_business_type="x", revolving_flag="0",
            refinance_flag="0", employee_flag="0", related_lending_flag="0", digital_loan_flag="0",
            bridge_loan_flag="0", interbank_flag="0", country_to_invest="TH", regulated_product="x",
            factor="x", open_date=D(2024, 1, 5), notional_oc=5, notional_baht=5,
            frst_pymt_amt_in_orig_ccy=10, total_rate=5, original_eir=5),
        "DER_MGL": dict(ac_id=ac, burden_free_flag="1", sale_date=D(2024, 1, 1),
                        order_of_contracts=1, ltv=1),
        "DER_PJF": dict(ac_id=ac, country="TH", location="x", estimated_value_baht=1),
        "DER_FXL": dict(ac_id=ac, cntpr_id=cp, put_option_flag="1", call_option_flag="1",
                        first_disbursement_date=D(2024, 2, 1), first_payment_date=D(2024, 3, 1),
                        put_date=D(2024, 2, 1), call_date=D(2024, 2, 1), put_amount_oc=1,
                        call_amount_oc=1, n_disbursement=0),
        "DER_SHM": dict(ac_id=ac, cntpr_id=cp),
        "DER_ACXAC": dict(ac_id=ac, prev_ac_id="A#clean" if w != "clean" else "A#other"),
        "DER_PLC": dict(ac_id=ac, policy="other_policy", policy_description="x",
                        effective_date=D(2024, 1, 2), end_date=D(2024, 1, 2)),
        "DER_GRPD": dict(ac_id=ac, grace_type="other_grace_period", grace_type_description="x",
                         effective_date=D(2024, 1, 2), end_date=D(2024, 1, 2)),
        "DER_PRT": dict(portfolio_id=f"F#{w}"),
        "DER_DR": dict(ac_id=ac, post_principal_baht=0, post_interest_baht=0,
                       principal_haircut_baht=0, interest_haircut_baht=0,
                       cond_principal_haircut_baht=1, cond_interest_haircut_baht=1, pv_loss_baht=0,
                       days_past_due=0),
        "DER_DRM": dict(ac_id=ac, method="other_dr_method", method_description="x"),
        "DER_LOP": dict(ac_id=ac, legal_operation_date=D(2024, 1, 2)),
        "DER_COL": dict(collateral_id=col, collateral_type="land_with_building",
                        registration_flag="1"),
        "DER_LND": dict(collateral_id=col, country="TH", ownership_flag="1", dopa_location="x",
                        dol_location=None, land_area=1),
        "DER_BLD": dict(collateral_id=col, country="TH", dopa_location="x", dol_location="  ",
                        developer_type="project_developers", project_name="x",
                        property_type="condominium", floor_number="1", n_floors=1,
                        completion_year=2000, area_utilization=1),
        "DER_RER": dict(land_collateral_id=col, building_collateral_id=col),
        "DER_CVG": dict(valuation_group_id=group, collateral_id=col),
        "DER_GE": dict(guarantor_group_id=f"U#{w}", cntpr_id=cp, credit_line_id=line,
                       guarantor_name="x"),
        "DER_PVG": dict(valuation_group_id=group, pledge_id=pledge),
        "DER_CPID": dict(cntpr_id=cp, application_id=f"N#{w}", id_type="personal_id",
                         id_no="1101700230708", id_type_country="TH", branch_fi_code=f"B#{w}"),
        "DER_JCP": dict(cntpr_id=cp, registered_country="TH", hq_nationality="TH", name_thai="x",
                        name_english=None, juristic_date=D(1990, 1, 1)),
        "DER_OCP": dict(cntpr_id=cp, first_name_en="x", first_name_th=None, last_name_en=None,
                        last_name_th="x", residence_country="TH", nationality="TH",
                        birthdate=D(1990, 1, 1)),
        "DER_BLP": dict(cntpr_id=cp, factory_country="TH", factory_location="x",
                        domestic_income_baht=1, export_income_baht=None, labor=0),
        "DER_PLP": dict(cntpr_id=cp, employment_status="employed", employment_characteristic="x",
                        occupation="y", contact_location="x", other_debt_burden_baht=0,
                        income_baht=0),
        "DER_RTR": dict(cntpr_id=cp),
        "DER_CPEN": dict(ent_id=ent, cntpr_id=cp, ac_id=ac, credit_line_id=line),
        "DER_DG": dict(debtor_group_id=f"H#{w}"),
        "DER_CPDG": dict(debtor_group_id=f"H#{w}", cntpr_id=cp),
        "DER_APP": dict(application_id=f"N#{w}", application_date=D(2024, 1, 1)),
        "DER_CL": dict(credit_line_id=line, root_credit_line_id=line, parent_credit_line_id=None,
                       ent_id=ent, application_id=f"N#{w}", approve_date=D(2024, 1, 1),
                       effective_date=D(2024, 1, 1), line_amount_oc=0, level_number=0),
        "DER_CLLT": dict(credit_line_id=line, loan_type="loans"),
        "DER_CLP": dict(credit_line_id=line, protection_id=pledge, protection_amount_baht=1),
        "DER_COLP": dict(pledge_id=pledge, pledge_amount_baht=0, mortgage_seq_no=1),
        "DER_EAM": dict(endorsement_id=f"X#{w}"),
        "DER_OVD": dict(credit_line_id=line),
        "DER_INTP": dict(ac_id=ac, reference_rate_id=f"I#{w}",
                         calculation="other_interest_calculation", calculation_description="x",
                         fix_rate_qted_fm_refr_rate_id=f"I#{w}", rate_effective_date=D(2024, 1, 1),
                         rate_end_date=D(2024, 1, 1), tier_threshold=0, fix_rate_margin=1),
        "DER_INTR": dict(reference_rate_id=f"I#{w}", rate_type="fixed_rate",
                         rate_type_description=None, tenor_unit="M", tenor=1),
        "DER_INTRV": dict(reference_rate_id=f"I#{w}"),
        "DER_OTDM": dict(ac_id=ac, account_status="open", ast_and_cntg_clss="c", class_reason="x",
                         otsnd_amt_in_orig_ccy=0, otsnd_amt_in_baht=0, uern_rev_in_orig_ccy=0,
                         uern_rev_in_baht=0, accrued_fee_baht=0, accrued_interest_baht=0,
                         undue_interest_baht=0, contractual_interest_baht=0, suspended_baht=0,
                         credit_equivalent_baht=0, days_past_due=0, current_eir=100, total_rate=0),
        "DER_OTDD": dict(ac_id=ac, ccy="USD", otsnd_amt_in_orig_ccy=5),
        "DER_TXF": dict(txn_id=txn, ac_id=ac, purpose="borrowing_purposes",
                        mvmt_tp="increasing_loan"),
        "DER_RLI": dict(txn_id=txn, investment_type=None, instrument_type=None, term_range="y",
                        repayment_due_ind=None, loan_declaration_type="x", maturity_date=None),
        "DER_BRD": dict(txn_id=txn, bot_doc_tp="approval_document", bot_doc_date=D(2024, 1, 1)),
        "DER_RDA": dict(txn_id=txn),
        "DER_REV": dict(reference_id=ac, reference_type="reference_account",
                        review_date=D(2024, 3, 31)),
        "DER_RSK": dict(reference_id=ac, reference_type="reference_account", risk_measure="DSR",
                        model_reference="x", risk_value="1.5", assessment_date=D(2024, 3, 31)),
        "DER_PPG": dict(product_program_id=f"R#{w}"),
        "REF_FI_CODE": dict(fi_code=f"B#{w}"),
        "DS_FCP": dict(position_item="none", ccy="USD", fc_amount=0),
    }


def _typed(value, dtype):
    if isinstance(value, (int, float, str)) and dtype.startswith("decimal"):
        return Decimal(str(value))
    return value


def frames(spark, names, faults, period="20240331", day=D(2024, 3, 31)):
    """One frame per entity: the clean worlds and one world per fault.

    A fault is ``{entity: changed columns}``; ``None`` drops the row, a list gives several rows.
    """
    worlds = {"clean": {}, "other": {}, **faults}
    result = {}
    for name in names:
        if name not in clean("clean"):
            continue
        schema = ENTITIES[name].schema
        rows = []
        for w, changes in worlds.items():
            change = changes.get(name, {})
            if change is None:
                continue
            for one in change if isinstance(change, list) else [change]:
                row = {"msr_prd_id": period, "org_id": f"O#{w}", "data_dt": day, "src_stm": "CMS",
                       **clean(w)[name], **one}
                rows.append(tuple(_typed(row.get(f.name), f.dataType.simpleString())
                                  for f in schema.fields))
        result[name] = spark.createDataFrame(rows, schema)
    return result
