"""Rule sets of the credit line entities."""

from pyspark.sql import DataFrame

from veriledger.operators import conditions as c
from veriledger.operators import families as f
from veriledger.operators import hierarchy
from veriledger.operators.ruleset import Codes, Pass, RuleSet, Tables, View, latest
from veriledger.specs.shared import PLEDGED_THAI_BUILDINGS, lookup

LINE = ("credit_line_id",)

_TOP = c.Condition(lambda s: c.true_when(c.same("root_credit_line_id", "credit_line_id")(s)))
_LEVELS_AGREE = c.Condition(lambda s: (
    _TOP(s) & c.blank("parent_credit_line_id")(s) & c.equals("level_number", 0)(s)
) | (
    ~_TOP(s) & c.filled("parent_credit_line_id")(s) & c.above("level_number", 0)(s)
))

CL_MONTHLY = RuleSet("DER_CL", (Pass("DER_CL", LINE, (
    f.date_rule("CNCL001", c.not_before("effective_date", "approve_date")),
    f.within("CNCL002", "line_amount_oc", c.at_least("line_amount_oc", 0)),
    f.hierarchy("CMCL001", _LEVELS_AGREE),
    f.references("RICL001", "cpen"),
    f.hierarchy("RICL002", f.found("parent"), when=c.filled("parent_credit_line_id"),
                needs=("parent",)),
    f.hierarchy("RICL003", f.found("root"), needs=("root",)),
    f.references_if("RICL004", c.filled("application_id"), "app"),
), (
    lookup("cpen", "DER_CPEN", "ent_id"),
    lookup("parent", "DER_CL", {"parent_credit_line_id": "credit_line_id"}),
    lookup("root", "DER_CL", {"root_credit_line_id": "credit_line_id"}),
    lookup("app", "DER_APP", "application_id"),
)),))



def _chains(tables: Tables, codes: Codes) -> DataFrame:
    """Per credit line the root and level that its chain of parents really has."""
    return hierarchy.resolved(tables["DER_CL"], "credit_line_id", "parent_credit_line_id")


_ENDS = c.equals("chain__state", hierarchy.ENDS)

# Beyond the sentences of the rules, which look one parent up: the chain as a whole. No job names these, so a
# job's counts stay those of its own rules.
CL_CHAINS = RuleSet("DER_CL", (Pass("DER_CL", LINE, (
    f.hierarchy("CHAIN_ROOT", c.same("root_credit_line_id", "chain__root"), when=_ENDS, needs=("chain",)),
    f.hierarchy("CHAIN_LEVEL", c.same("level_number", "chain__depth"), when=_ENDS, needs=("chain",)),
    f.hierarchy("CHAIN_LOOPS", ~c.equals("chain__state", hierarchy.LOOPS), when=c.filled("credit_line_id"), needs=("chain",)),
    f.hierarchy("CHAIN_PARENT", ~c.equals("chain__state", hierarchy.MISSING), when=c.filled("credit_line_id"),
                needs=("chain",)),
), (lookup("chain", "credit_line_chains", {"credit_line_id": "node"}, latest("root"), latest("depth"), latest("state")),)),
), views=(View("credit_line_chains", _chains, ("DER_CL",)),))

_LINE = lookup("cl", "DER_CL", "credit_line_id")

CLLT_MONTHLY = RuleSet("DER_CLLT", (
    Pass("DER_CLLT", LINE, (f.references("RICLLT001", "cl"),), (_LINE,)),
))

CLP_MONTHLY = RuleSet("DER_CLP", (Pass("DER_CLP", LINE, (
    f.within("CNCLP001", "protection_amount_baht", c.above("protection_amount_baht", 0)),
    f.references("RICLP001", "cl"),
    f.references_any("RICLP002", "pledge", "guarantee", "endorsement"),
), (
    _LINE,
    lookup("pledge", "DER_COLP", {"protection_id": "pledge_id"}),
    lookup("guarantee", "DER_GE", {"protection_id": "guarantor_group_id"}),
    lookup("endorsement", "DER_EAM", {"protection_id": "endorsement_id"}),
)),))

COLP_MONTHLY = RuleSet("DER_COLP", (Pass("DER_COLP", ("pledge_id",), (
    f.within("CNCOLP001", "pledge_amount_baht", c.at_least("pledge_amount_baht", 0)),
    f.within("CMCOLP001", "mortgage_seq_no", c.above("mortgage_seq_no", 0),
             when=f.found("building"), needs=("building",)),
    f.references("RICOLP001", "pvg"),
), (
    lookup("building", "pledged_thai_buildings", "pledge_id"),
    lookup("pvg", "DER_PVG", "pledge_id"),
)),), views=(PLEDGED_THAI_BUILDINGS,))

OVD_MONTHLY = RuleSet("DER_OVD", (
    Pass("DER_OVD", LINE, (f.references("RIOVD001", "cl"),), (_LINE,)),
))
