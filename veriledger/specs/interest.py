"""Rule sets of the interest entities."""

from veriledger.operators import conditions as c
from veriledger.operators import families as f
from veriledger.operators.ruleset import Pass, RuleSet, any_row
from veriledger.specs import codes as k
from veriledger.specs.shared import account, is_true, lookup

QUOTED = "fix_rate_qted_fm_refr_rate_id"

INTP_DAILY = RuleSet("DER_INTP", (Pass("DER_INTP", ("ac_id",), (
    f.date_rule("CNINTP001", c.not_before("rate_end_date", "rate_effective_date")),
    f.within("CNINTP002", "tier_threshold", c.at_least("tier_threshold", 0)),
    f.described_if_other("CMINTP002", c.in_codes("calculation", "other_interest_calculation"),
                         "calculation_description"),
    f.implies("CMINTP003", "V1", is_true("intr__not_fixed"), c.blank(QUOTED), needs=("intr",)),
    f.iff_filled("CMINTP004", c.filled(QUOTED), "fix_rate_margin"),
    f.references("RIINTP001", "cac"),
    f.references("RIINTP002", "intr"),
    f.references_if("RIINTP003", c.filled(QUOTED), "quoted"),
), (
    account(),
    lookup("intr", "DER_INTR", "reference_rate_id",
           any_row("not_fixed", ~c.in_codes("rate_type", "fixed_rate"))),
    lookup("quoted", "DER_INTR", {QUOTED: "reference_rate_id"}),
)),))

INTR = RuleSet("DER_INTR", (Pass("DER_INTR", ("reference_rate_id",), (
    f.described_if_other("CMINTR001", c.in_codes("rate_type", "other_rate_type"),
                         "rate_type_description"),
    f.required_if("CMINTR002", c.one_of("rate_type", *k.TENOR_RATE_TYPES), "tenor", "tenor_unit",
                  holds=c.above("tenor", 0)),
)),))

INTRV_DAILY = RuleSet("DER_INTRV", (Pass("DER_INTRV", ("reference_rate_id",), (
    f.references("RIINTRV001", "intr"),
), (lookup("intr", "DER_INTR", "reference_rate_id"),)),))
