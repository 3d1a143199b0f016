"""Values the rules compare with."""

from datetime import date

# Fixed values named in the rule texts.
THAILAND = "TH"
HOME_CURRENCY = "THB"
UNCLASSIFIED = "unclassified"
INITIAL_DATA = "Initial Data"
UNKNOWN_AMOUNT = 0.01
UNKNOWN_ORDER = 9999
FIRST_YEAR = 1753
CUTOVER = date(2023, 10, 1)
SYNDICATION_START = date(2023, 1, 1)
YES, NO = "1", "0"

# Risk measures by the type of their value.
NUMERIC_MEASURES = (
    "DSR", "DSR BOT", "DTI", "B-Score", "MANAGEMENT OVERLAY", "D/E Ratio", "DSCR",
)
MODEL_MEASURES = ("Internal Credit Rating", "B-SCORE")
FLAG_MEASURE = "Watch List Flag"

# Interest rate types that need a tenor.
TENOR_RATE_TYPES = (
    "Term Deposit", "BIBOR", "SIBOR", "USD LIBOR / Fallback SOFR", "GBP LIBOR / Fallback SONIA",
    "CHF LIBOR / Fallback SARON", "EUR LIBOR / Fallback ESTER", "JPY LIBOR / Fallback TONA", "TIBOR",
    "HIBOR", "EURIBOR", "THBFIX / Fallback THBFIX", "SOR / Fallback SOR",
)

# Balance sheet items, provision item, and per rule the asset class of an account and
# of the provision summary.
BALANCE_SHEET_ITEMS = ("955010", "955015", "955030", "955051", "955070", "955124")
PROVISION_ITEM = "960080"
CLASS_PAIRS = {
    "CMOTDM004": ("2000800001", "020011"),
    "CMOTDM005": ("2000800002", "020012"),
    "CMOTDM006": ("2000800003", "020013"),
    "CMOTDM007": ("2000800004", "020014"),
    "CMOTDM008": ("2000800005", "020015"),
}
# Reporting group of a ledger row by organisation.
BALANCE_SHEET_GROUPS = {"TCB": "116002", "FCB": "116003"}
PROVISION_GROUPS = {"TCB": "116002", "FCB": "116008"}

# Code lists the rule texts name without listing them; the user binds each to its codes.
CODE_LISTS = (
    "fixed_term", "unknown_term_unit", "contingent_loans", "contingents_view", "loans",
    "bills_of_exchange", "aval_to_bills", "bill_certifications", "loan_guarantees",
    "unconditional_loan_guarantees", "baht_loans", "credit_card_loans", "offshore_branch_loans",
    "overdraft", "first_payment_loans", "reverse_mortgage", "lead_manager_loans",
    "commercial_purposes", "consumption_purposes", "other_purposes", "mortgage_purposes",
    "other_mortgage_purposes", "residential_purchase_purposes", "closed_status",
    "inactive_or_closed_status", "personal_id", "tax_id", "juristic_id", "cooperative_id",
    "offshore_branch_number", "exempt_id", "other_grace_period", "other_policy", "other_dr_method",
    "other_interest_calculation", "other_rate_type", "fixed_rate", "unemployed",
    "unemployed_occupations", "land_with_building", "building_or_land_with_building",
    "condominium", "project_developers", "approval_document", "reference_account",
    "reference_credit_line", "reference_counterparty", "reference_entity", "portfolio_investment",
    "debt_instrument_purposes", "bond_instruments", "portfolio_purposes", "borrowing_purposes",
    "lending_purposes", "foreign_loan_purpose", "increasing_loan", "decreasing_loan",
    "open_term_ranges", "onshore_lending", "offshore_lending", "overdraft_from_deposit",
    "foreign_bill_inward", "foreign_bill_outward", "onshore_lending_positions",
    "offshore_lending_positions", "overdraft_positions", "bill_inward_positions",
    "bill_outward_positions",
)


def sample_codes() -> dict[str, list[str]]:
    """Every list holding just its own name: a stand-in until real codes are bound."""
    return {name: [name] for name in CODE_LISTS}
