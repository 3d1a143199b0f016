"""Rule sets of reviews and risk assessments."""

from veriledger.operators import conditions as c
from veriledger.operators import families as f
from veriledger.operators.ruleset import Pass, RuleSet
from veriledger.specs import codes as k
from veriledger.specs.shared import lookup


def _by_type(prefix: str) -> tuple[f.Rule, ...]:
    """One reference rule per reference type."""
    parents = {"account": "cac", "credit_line": "cl", "counterparty": "cpid", "entity": "cpen"}
    return tuple(
        f.references_if(f"{prefix}{i:03}", c.in_codes("reference_type", f"reference_{kind}"), parent)
        for i, (kind, parent) in enumerate(parents.items(), 1))


# all four parents are joined on the same column, so the rows are shuffled once
_PARENTS = (
    lookup("cac", "DER_CAC", {"reference_id": "ac_id"}),
    lookup("cl", "DER_CL", {"reference_id": "credit_line_id"}),
    lookup("cpid", "DER_CPID", {"reference_id": "cntpr_id"}),
    lookup("cpen", "DER_CPEN", {"reference_id": "ent_id"}),
)

REV_MONTHLY = RuleSet("DER_REV", (Pass("DER_REV", ("review_date", "reference_id"), (
    f.date_rule("CNREV001", c.not_before("data_dt", "review_date")),
    *_by_type("RIREV"),
), _PARENTS),))

RSK_P1 = RuleSet("DER_RSK", (Pass("DER_RSK", ("reference_id",), (
    f.date_rule("CNRSK001", c.not_before("data_dt", "assessment_date")),
    f.required_if("CMRSK001", c.one_of("risk_measure", *k.MODEL_MEASURES), "model_reference"),
    f.typed_value("CMRSK002", "risk_value", c.one_of("risk_measure", *k.NUMERIC_MEASURES),
                  c.equals("risk_measure", k.FLAG_MEASURE)),
    *_by_type("RIRSK"),
), _PARENTS),))
