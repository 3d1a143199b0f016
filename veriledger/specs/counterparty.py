"""Rule sets of the counterparty entities."""

from veriledger.operators import conditions as c
from veriledger.operators import families as f
from veriledger.operators.ruleset import Pass, RuleSet, any_row, latest
from veriledger.specs import codes as k
from veriledger.specs.shared import COUNTERPARTY_ACCOUNTS, counterparty_id, is_true, lookup

COUNTERPARTY = ("cntpr_id",)
SINCE_CUTOVER = c.at_least("data_dt", k.CUTOVER)


def _unclassified(*columns: str) -> c.Condition:
    return c.Condition(
        lambda s: c.true_when(c.equals(columns[0], k.UNCLASSIFIED)(s))
        | c.true_when(c.equals(columns[-1], k.UNCLASSIFIED)(s)))


def _identification(rerun: bool) -> RuleSet:
    rules = [
        f.check_digit("CNCPID001", c.in_codes("id_type", "personal_id"), "id_no"),
        f.check_digit("CNCPID002", c.in_codes("id_type", "tax_id"), "id_no"),
        f.check_digit("CNCPID003", c.in_codes("id_type", "juristic_id"), "id_no"),
        f.check_digit("CNCPID004", c.in_codes("id_type", "cooperative_id"), "id_no"),
        f.in_list("CMCPID001", c.in_codes("id_type", "offshore_branch_number"),
                  c.filled("branch_fi_code") & f.found("fi"), needs=("fi",)),
        f.references_any("CMCPID002", "jcp", "ocp", when=~c.in_codes("id_type", "exempt_id")),
    ]
    lookups = [
        lookup("fi", "REF_FI_CODE", {"branch_fi_code": "fi_code"}),
        lookup("jcp", "DER_JCP", "cntpr_id"),
        lookup("ocp", "DER_OCP", "cntpr_id"),
    ]
    if not rerun:
        rules.append(f.placeholder_ban(
            "CMCPID003", c.at_least("app__application_date", k.CUTOVER),
            c.equals("id_type_country", k.UNCLASSIFIED), needs=("app",)))
        lookups.append(lookup("app", "DER_APP", "application_id", latest("application_date")))
    return RuleSet("DER_CPID", (Pass("DER_CPID", COUNTERPARTY, tuple(rules), tuple(lookups)),))


CPID_DAILY = _identification(rerun=False)
CPID_RERUN = _identification(rerun=True)

JCP_DAILY = RuleSet("DER_JCP", (Pass("DER_JCP", COUNTERPARTY, (
    f.date_rule("CMJCP002", c.sql(f"year(juristic_date) > {k.FIRST_YEAR}"),
                c.equals("registered_country", k.THAILAND)),
    f.either_filled("CMJCP003", "name_thai", "name_english"),
    f.placeholder_ban("CMJCP004", SINCE_CUTOVER,
                      _unclassified("registered_country", "hq_nationality")),
    f.references("RIJCP001", "cpid"),
), (counterparty_id(),)),))

OCP_DAILY = RuleSet("DER_OCP", (Pass("DER_OCP", COUNTERPARTY, (
    f.date_rule("CNOCP001", c.sql(f"year(birthdate) > {k.FIRST_YEAR}")),
    f.either_filled("CMOCP002", "first_name_en", "first_name_th"),
    f.either_filled("CMOCP003", "last_name_en", "last_name_th"),
    f.references("RIOCP001", "cpid"),
    f.placeholder_ban("CMOCP004", SINCE_CUTOVER, _unclassified("residence_country", "nationality")),
), (counterparty_id(),)),))


def _business_profile(first_phase: bool) -> RuleSet:
    export = c.Condition(lambda s: c.true_when(c.above("domestic_income_baht", 0)(s)))
    rules = (
        f.within("CNBLP001", "labor", c.at_least("labor", 0)),
        f.within("CNBLP002", "domestic_income_baht", c.at_least("domestic_income_baht", 0)),
        f.required_if("CMBLP002", c.equals("factory_country", k.THAILAND), "factory_location"),
        f.Rule("CMBLP003", "V2", (export & c.sql("export_income_baht < 0"))
               | (~export & ~c.sql("coalesce(export_income_baht > 0, false)"))),
        f.references("RIBLP001", "cpid"),
    )
    own = Pass("DER_BLP", COUNTERPARTY, rules, (counterparty_id(),))
    if first_phase:
        return RuleSet("DER_BLP", (own,))
    reported = Pass("counterparty_accounts", COUNTERPARTY, (
        f.must_be_reported("CMBLP001", is_true("commercial"), "blp"),
    ), (lookup("blp", "DER_BLP", "cntpr_id"),))
    return RuleSet("DER_BLP", (own, reported), views=(COUNTERPARTY_ACCOUNTS,))


BLP_MONTHLY = _business_profile(first_phase=False)
BLP_P1 = _business_profile(first_phase=True)

PLP_P1 = RuleSet("DER_PLP", (
    Pass("DER_PLP", COUNTERPARTY, (
        f.within("CNPLP001", "other_debt_burden_baht", c.at_least("other_debt_burden_baht", 0)),
        f.Rule("CMPLP002", "V4", c.Condition(lambda s: (
            c.true_when((~c.in_codes("employment_status", "unemployed"))(s))
            & c.blank("employment_characteristic")(s)
        ) | (
            c.true_when(c.in_codes("employment_status", "unemployed")(s))
            & ~c.true_when(c.in_codes("occupation", "unemployed_occupations")(s))
        ))),
        f.within("CMPLP004", "income_baht", c.at_least("income_baht", 0),
                 when=is_true("accounts__not_employee"), needs=("accounts",)),
        f.required_if("CMPLP005", c.Condition(
            lambda s: c.true_when(is_true("cpid__personal")(s))
            | c.true_when(is_true("ocp__thai")(s))), "contact_location", needs=("cpid", "ocp")),
        f.references("RIPLP001", "cpid"),
    ), (
        lookup("cpid", "DER_CPID", "cntpr_id",
               any_row("personal", c.in_codes("id_type", "personal_id"))),
        lookup("ocp", "DER_OCP", "cntpr_id",
               any_row("thai", c.equals("residence_country", k.THAILAND))),
        lookup("accounts", "counterparty_accounts", "cntpr_id",
               any_row("not_employee", is_true("not_employee"))),
    )),
    Pass("counterparty_accounts", COUNTERPARTY, (
        f.must_be_reported("CMPLP001", is_true("consumption"), "plp"),
    ), (lookup("plp", "DER_PLP", "cntpr_id"),)),
), views=(COUNTERPARTY_ACCOUNTS,))

RTR_MONTHLY = RuleSet("DER_RTR", (
    Pass("counterparty_accounts", COUNTERPARTY, (
        f.must_be_reported("CMRTR001", is_true("related"), "rtr"),
    ), (lookup("rtr", "DER_RTR", "cntpr_id"),)),
    Pass("DER_RTR", COUNTERPARTY, (f.references("RIRTR001", "cpid"),), (counterparty_id(),)),
), views=(COUNTERPARTY_ACCOUNTS,))

CPEN = RuleSet("DER_CPEN", (
    Pass("DER_CPEN", COUNTERPARTY, (f.references("RICPEN001", "cpid"),), (counterparty_id(),)),
))

CPDG = RuleSet("DER_CPDG", (Pass("DER_CPDG", ("debtor_group_id", "cntpr_id"), (
    f.references("RICPDG001", "dg"),
    f.references("RICPDG002", "cpid"),
), (lookup("dg", "DER_DG", "debtor_group_id"), counterparty_id())),))
