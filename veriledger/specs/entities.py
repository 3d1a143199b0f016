"""Report entities: key and columns. Column names are this library's; rename a source to match."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

AMOUNT = "decimal(18,2)"
RATE = "decimal(9,4)"


@dataclass(frozen=True)
class Entity:
    """``once`` marks entities stored when they occur and valid from then on."""

    name: str
    title: str
    key: tuple[str, ...]
    columns: tuple[tuple[str, str], ...]
    once: bool = False

    @property
    def schema(self) -> T.StructType:
        fields = [("msr_prd_id", "string"), ("org_id", "string"), ("data_dt", "date"), *self.columns,
                  ("src_stm", "string"), ("ppn_tm", "timestamp")]
        return T.StructType([T.StructField(n, T.DataType.fromDDL(t)) for n, t in fields])


def _entity(name: str, title: str, key: str, texts: str = "", dates: str = "", amounts: str = "",
            numbers: str = "", rates: str = "", once: bool = False) -> Entity:
    keys = tuple(key.split())
    columns = [(k, "string") for k in keys]
    for names, kind in ((texts, "string"), (dates, "date"), (amounts, AMOUNT), (numbers, "int"),
                        (rates, RATE)):
        columns += [(n, kind) for n in names.split()]
    return Entity(name, title, keys, tuple(columns), once)


ENTITIES = {e.name: e for e in [
    # accounts
    _entity("DER_CAC", "Credit Account", "ac_id",
            "ent_id ccy loan_type term_type account_status principal_freq_unit interest_freq_unit "
            "payment_freq_condition been_extended_flag syndication_role",
            "contract_date effective_date maturity_date",
            "share_lending_total_baht share_lending_total_oc contract_amount_oc",
            "n_principal principal_freq n_interest interest_freq"),
    _entity("DER_CACD", "Credit Account Detail", "ac_id",
            "credit_line_id portfolio_id product_program_id account_purpose lending_business_type "
            "revolving_flag refinance_flag employee_flag related_lending_flag digital_loan_flag "
            "bridge_loan_flag interbank_flag country_to_invest regulated_product factor",
            "open_date", "notional_oc notional_baht frst_pymt_amt_in_orig_ccy", "",
            "total_rate original_eir"),
    _entity("DER_CC", "Credit Card", "ac_id", "credit_card_type parent_ac_id card_holder_cntpr_id"),
    _entity("DER_MGL", "Mortgage Loan", "ac_id", "burden_free_flag", "sale_date", "",
            "order_of_contracts", "ltv"),
    _entity("DER_PJF", "Project Finance", "ac_id", "country location", "", "estimated_value_baht"),
    _entity("DER_FXL", "FX Loan", "ac_id", "cntpr_id put_option_flag call_option_flag",
            "first_disbursement_date first_payment_date put_date call_date",
            "put_amount_oc call_amount_oc", "n_disbursement"),
    _entity("DER_SHM", "Share Lending Member", "ac_id cntpr_id"),
    _entity("DER_ACXAC", "Account x Account", "ac_id prev_ac_id"),
    _entity("DER_PLC", "Policy Adoption", "ac_id", "policy policy_description",
            "effective_date end_date"),
    _entity("DER_GRPD", "Grace Period", "ac_id", "grace_type grace_type_description",
            "effective_date end_date"),
    _entity("DER_PRT", "Portfolio", "portfolio_id", "portfolio_name"),
    _entity("DER_DR", "Debt Restructuring", "ac_id", "", "",
            "post_principal_baht post_interest_baht principal_haircut_baht interest_haircut_baht "
            "cond_principal_haircut_baht cond_interest_haircut_baht pv_loss_baht", "days_past_due"),
    _entity("DER_DRM", "Debt Restructuring Method", "ac_id", "method method_description"),
    _entity("DER_LOP", "Legal Operation", "ac_id", "operation_type", "legal_operation_date"),
    # collateral
    _entity("DER_COL", "Collateral", "collateral_id", "collateral_type registration_flag", once=True),
    _entity("DER_LND", "Land", "collateral_id", "country ownership_flag dopa_location dol_location",
            "", "", "", "land_area"),
    _entity("DER_BLD", "Building", "collateral_id",
            "country dopa_location dol_location developer_type project_name property_type "
            "floor_number", "", "", "n_floors completion_year", "area_utilization"),
    _entity("DER_RER", "Real Estate Relationship", "land_collateral_id building_collateral_id"),
    _entity("DER_CVG", "Collateral Valuation Group", "valuation_group_id collateral_id"),
    _entity("DER_GE", "Guarantor or Endorser", "guarantor_group_id cntpr_id",
            "credit_line_id guarantor_name"),
    _entity("DER_PVG", "Pledge Valuation Group", "valuation_group_id pledge_id"),
    # counterparties
    _entity("DER_CPID", "Counterparty x Id", "cntpr_id",
            "application_id id_type id_no id_type_country branch_fi_code", once=True),
    _entity("DER_JCP", "Juristic Counterparty", "cntpr_id",
            "registered_country hq_nationality name_thai name_english", "juristic_date", once=True),
    _entity("DER_OCP", "Ordinary Counterparty", "cntpr_id",
            "first_name_en first_name_th last_name_en last_name_th residence_country nationality",
            "birthdate", once=True),
    _entity("DER_BLP", "Business Loan Profile", "cntpr_id", "factory_country factory_location", "",
            "domestic_income_baht export_income_baht", "labor"),
    _entity("DER_PLP", "Personal Loan Profile", "cntpr_id",
            "employment_status employment_characteristic occupation contact_location", "",
            "other_debt_burden_baht income_baht"),
    _entity("DER_RTR", "Relationship to Reporter", "cntpr_id", "relationship_type", once=True),
    _entity("DER_CPEN", "Counterparty Entity", "ent_id cntpr_id", "ac_id credit_line_id"),
    _entity("DER_DG", "Debtor Group", "debtor_group_id", "group_name"),
    _entity("DER_CPDG", "Counterparty Debtor Group", "debtor_group_id cntpr_id"),
    _entity("DER_APP", "Application", "application_id", "", "application_date"),
    # credit lines
    _entity("DER_CL", "Credit Line", "credit_line_id",
            "root_credit_line_id parent_credit_line_id ent_id application_id",
            "approve_date effective_date", "line_amount_oc", "level_number"),
    _entity("DER_CLLT", "Credit Line Loan Type", "credit_line_id loan_type"),
    _entity("DER_CLP", "Credit Line Protection", "credit_line_id protection_id", "", "",
            "protection_amount_baht"),
    _entity("DER_COLP", "Collateral Pledge", "pledge_id", "", "", "pledge_amount_baht",
            "mortgage_seq_no"),
    _entity("DER_EAM", "Endorsement Amount", "endorsement_id", "", "", "amount_baht"),
    _entity("DER_OVD", "Override or Deviation", "credit_line_id", "override_type"),
    # interest
    _entity("DER_INTP", "Interest Plan", "ac_id",
            "reference_rate_id calculation calculation_description fix_rate_qted_fm_refr_rate_id",
            "rate_effective_date rate_end_date", "tier_threshold", "", "fix_rate_margin"),
    _entity("DER_INTR", "Interest Reference", "reference_rate_id",
            "rate_type rate_type_description tenor_unit", "", "", "tenor"),
    _entity("DER_INTRV", "Interest Reference Value", "reference_rate_id", "", "value_date", "", "",
            "rate_value"),
    # outstanding and flows
    _entity("DER_OTDM", "Outstanding Monthly", "ac_id",
            "account_status ast_and_cntg_clss class_reason", "",
            "otsnd_amt_in_orig_ccy otsnd_amt_in_baht uern_rev_in_orig_ccy uern_rev_in_baht "
            "accrued_fee_baht accrued_interest_baht undue_interest_baht contractual_interest_baht "
            "suspended_baht credit_equivalent_baht", "days_past_due", "current_eir total_rate"),
    _entity("DER_OTDD", "Outstanding Daily", "ac_id", "ccy", "", "otsnd_amt_in_orig_ccy"),
    _entity("DER_AGF", "Aggregated Flow", "ac_id mvmt_tp", "", "", "mvmt_amt_in_baht"),
    _entity("DER_TXF", "Transaction Flow", "txn_id",
            "ac_id purpose mvmt_tp bot_doc_tp bot_doc_no", "", "amount_baht"),
    _entity("DER_RLI", "Related Loan or Investment", "txn_id",
            "investment_type instrument_type term_range repayment_due_ind loan_declaration_type",
            "maturity_date"),
    _entity("DER_BRD", "BOT Reference Document", "txn_id", "bot_doc_tp bot_doc_no", "bot_doc_date"),
    _entity("DER_RDA", "Related Deposit Account", "txn_id", "deposit_ac_id"),
    # reviews
    _entity("DER_REV", "Review", "reference_id", "reference_type", "review_date"),
    _entity("DER_RSK", "Risk Assessment", "reference_id",
            "reference_type risk_measure model_reference risk_value", "assessment_date"),
    # tables the rules and loads read beside the entities
    _entity("DER_PPG", "Product Program", "product_program_id"),
    _entity("REF_FI_CODE", "Financial Institution Code", "fi_code"),
    _entity("DS_FCP", "Foreign Currency Position", "position_item", "ccy", "", "fc_amount"),
    _entity("DS_BLS", "Balance Sheet", "fi_rpt_grp_id bsh_itm_tp_id", "", "ds_dt", "bsh_amt"),
    _entity("DS_PVS", "Provision Summary", "fi_rpt_grp_id ast_cl_tp_id prvn_smy_itm_tp_id", "",
            "ds_dt", "amt"),
    _entity("MAS_ENT", "Master Entity", "ent_id"),
    _entity("MAS_ENT_DTL", "Master Entity Detail", "ent_id cntpr_id"),
    _entity("STG_ENT", "Staged Entity", "ent_id"),
    _entity("STG_ENT_DTL", "Staged Entity Detail", "ent_id cntpr_id"),
    _entity("STG_CTP", "Staged Counterparty", "cntpr_id", "ent_id name"),
    _entity("STG_CTP_ETT", "Staged Counterparty Entity", "ent_id cntpr_id"),
    _entity("STG_CAC", "Staged Credit Account", "ac_id", "loan_type"),
]}

ENTITIES["STG_BLD"] = replace(ENTITIES["DER_BLD"], name="STG_BLD", title="Staged Building")

# Words of the report's column names for the short names above.
REPORT_NAMES = {
    "ac_id": "Account Id",
    "cntpr_id": "Counterparty Id",
    "data_dt": "Data Date",
    "ent_id": "Entity Id",
    "org_id": "Organization Id",
}


def report_names(entity: Entity) -> dict[str, str]:
    """Report column name -> column, in table order, without the load's own columns."""
    columns = ["org_id", "data_dt", *[n for n, _ in entity.columns]]
    return {REPORT_NAMES.get(n, n.replace("_", " ").title()): n for n in columns}
