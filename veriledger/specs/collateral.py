"""Rule sets of the collateral entities."""

from veriledger.operators import conditions as c
from veriledger.operators import families as f
from veriledger.operators.ruleset import Pass, RuleSet, any_row
from veriledger.specs.shared import (
    IN_THAILAND,
    RESIDENTIAL_COLLATERAL,
    counterparty_id,
    is_true,
    lookup,
)

COLLATERAL = ("collateral_id",)
_THAI = any_row("thai", IN_THAILAND)

COL_MONTHLY = RuleSet("DER_COL", (Pass("DER_COL", COLLATERAL, (
    f.required_if("CMCOL001", c.Condition(
        lambda s: c.true_when(is_true("lnd__thai")(s)) | c.true_when(is_true("bld__thai")(s))),
        "registration_flag", needs=("lnd", "bld")),
), (
    lookup("lnd", "DER_LND", "collateral_id", _THAI),
    lookup("bld", "DER_BLD", "collateral_id", _THAI),
)),))

LND_P1 = RuleSet("DER_LND", (Pass("DER_LND", COLLATERAL, (
    f.within("CNLND001", "land_area", c.above("land_area", 0)),
    f.required_if("CMLND001", IN_THAILAND, "ownership_flag"),
    f.either_filled("CMLND002", "dopa_location", "dol_location", when=IN_THAILAND),
    f.references("RILND001", "col"),
), (lookup("col", "DER_COL", "collateral_id"),)),))

BLD_P1 = RuleSet("DER_BLD", (Pass("DER_BLD", COLLATERAL, (
    f.either_filled("CMBLD001", "dopa_location", "dol_location", when=IN_THAILAND,
                    also=c.above("n_floors", 0) & c.above("area_utilization", 0)),
    f.required_if("CMBLD002", IN_THAILAND & f.found("residential"), "developer_type",
                  needs=("residential",)),
    f.required_if("CMBLD003", IN_THAILAND & c.in_codes("developer_type", "project_developers"),
                  "project_name"),
    f.required_if("CMBLD004", IN_THAILAND & is_true("col__building"), "completion_year",
                  needs=("col",)),
    f.required_if("CMBLD005", IN_THAILAND & c.in_codes("property_type", "condominium"),
                  "floor_number"),
    f.references("RIBLD001", "col"),
), (
    lookup("col", "DER_COL", "collateral_id", any_row(
        "building", c.in_codes("collateral_type", "building_or_land_with_building"))),
    lookup("residential", "residential_collateral", "collateral_id"),
)),), views=(RESIDENTIAL_COLLATERAL,))

RER_MONTHLY = RuleSet("DER_RER", (Pass("DER_RER", ("land_collateral_id",), (
    f.references("RIRER001", "lnd"),
    f.references("RIRER002", "bld"),
), (
    lookup("lnd", "DER_LND", {"land_collateral_id": "collateral_id"}),
    lookup("bld", "DER_BLD", {"building_collateral_id": "collateral_id"}),
)),))

CVG_MONTHLY = RuleSet("DER_CVG", (Pass("DER_CVG", ("valuation_group_id",), (
    f.references("RICVG001", "col"),
), (lookup("col", "DER_COL", "collateral_id"),)),))

GE_MONTHLY = RuleSet("DER_GE", (Pass("DER_GE", ("guarantor_group_id", "cntpr_id", "credit_line_id"), (
    f.either_filled("CMGE001", "guarantor_name", "cntpr_id"),
    f.references("RIGE001", "cpid"),
), (counterparty_id(),)),))

PVG_MONTHLY = RuleSet("DER_PVG", (Pass("DER_PVG", ("valuation_group_id",), (
    f.references("RIPVG001", "cvg"),
), (lookup("cvg", "DER_CVG", "valuation_group_id"),)),))
