"""The jobs: which entity, from where, with which checks. Data only; :mod:`run` executes them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from veriledger.functions.periods import FILLER_DATE
from veriledger.operators.ruleset import RuleSet
from veriledger.specs import account, collateral, counterparty, credit_line, interest, outstanding
from veriledger.specs import review
from veriledger.specs.entities import ENTITIES, Entity

DAILY, MONTHLY = "daily", "monthly"
WAREHOUSE, STAGING, TEXT, INSIDE, NOTHING = (
    "warehouse", "staging tables", "pipe text", "in-warehouse", "none")
NO_STEP = "none"
LOAD, RESHAPE, APPLY, VALIDATE, EXPORT = "load", "reshape", "apply", "validate", "export"
LINES = ("p1_", "rerun_")
ALL_STAGES = (LOAD, RESHAPE, APPLY, VALIDATE, EXPORT)

# Organisation of rows that name none, and the filler of fields a source lacks.
DEFAULT_ORG = "006"
MISSING_FIELD = "999999999"


@dataclass(frozen=True)
class Job:
    """One pipeline.

    ``stamped`` rows all get the organisation and data date of the run.
    ``new_only`` stores only keys that are not stored yet. ``set_from`` names the table and the
    (column, key) that fill a column by key. ``dependents`` are tables filled from the entity after
    it is stored, with the columns that identify their rows. ``step`` is how the period moves on when
    that is not the cadence.
    """

    name: str
    entity: str
    cadence: str
    input: str
    rules: RuleSet | None = None
    stages: tuple[str, ...] = ALL_STAGES
    prevalidation: str | None = None
    clear: tuple[str, ...] = ()
    constants: Mapping[str, object] = field(default_factory=dict)
    fill: Mapping[str, object] = field(default_factory=dict)
    stamped: bool = False
    new_only: bool = False
    set_from: tuple[str, str, str] | None = None
    dependents: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    exports_when_failed: bool = True
    step: str | None = None

    @property
    def target(self) -> Entity:
        return ENTITIES[self.entity]

    @property
    def line(self) -> str:
        """The line of jobs it belongs to: the first phase's, a hand-run copy's, or the current ones."""
        return next((p for p in LINES if self.name.startswith(p)), "")

    def table(self, entity: str) -> str:
        """The table it stores an entity in: the entity's, unless several jobs write it."""
        if len(WRITERS.get(entity, ())) < 2:
            return entity
        daily = "_D" if self.cadence == DAILY else ""
        return f"{self.line.upper()}{entity}{daily}"

    def sources(self, entity: str) -> list[str]:
        """The tables its rules may read an entity from, the nearest first: of its own line and cadence,
        of its line, of the current line."""
        writers = WRITERS.get(entity, ())
        if self.name in writers:
            return [self.table(entity)]
        others = sorted((JOBS[n] for n in writers), key=lambda j: (
            j.line != self.line, bool(j.line), j.cadence != self.cadence, j.name))
        return list(dict.fromkeys(j.table(entity) for j in others)) or [entity]


@dataclass(frozen=True)
class Landing:
    """One source of a daily entity. ``placeholders`` fill the fields the source does not deliver."""

    name: str
    entity: str
    source: str
    input: str
    placeholders: Mapping[str, str] = field(default_factory=dict)

    @property
    def table(self) -> str:
        return f"{self.entity}_{self.source}"


SOURCES = {"CMS": WAREHOUSE, "TFS": TEXT, "TRS": TEXT}
LANDED_ENTITIES = ("DER_CAC", "DER_FXL", "DER_OTDD", "DER_TXF", "DER_RLI", "DER_BRD", "DER_RDA",
                   "DER_INTP", "DER_INTR", "DER_INTRV")
_DOCUMENT = {"bot_doc_tp": MISSING_FIELD, "bot_doc_no": MISSING_FIELD}
PLACEHOLDERS = {
    ("DER_TXF", "TRS"): _DOCUMENT,
    ("DER_BRD", "TRS"): _DOCUMENT,
    ("DER_INTP", "TRS"): {"fix_rate_qted_fm_refr_rate_id": MISSING_FIELD},
}


def _short(entity: str) -> str:
    return entity.removeprefix("DER_").lower()


LANDINGS = {
    l.name: l
    for l in (
        Landing(f"land_{_short(e)}_{s.lower()}", e, s, kind, PLACEHOLDERS.get((e, s), {}))
        for e in LANDED_ENTITIES for s, kind in SOURCES.items()
    )
}


def _job(entity: str, cadence: str, input_: str, rules: RuleSet | None = None, prefix: str = "",
         **more) -> Job:
    return Job(f"{prefix}{cadence}_{_short(entity)}", entity, cadence, input_, rules, **more)


_SINGLE, _MULTIPLE = "single", "multiple"
_PASSES_ON = (LOAD, APPLY)
_ENTITY_MASTER = {"MAS_ENT": ("ent_id",), "MAS_ENT_DTL": ("ent_id", "cntpr_id")}
_FROM_MAPPING_CAC = ("DER_CPEN", "ent_id", "ac_id")
_FROM_MAPPING_CL = ("DER_CPEN", "ent_id", "credit_line_id")

JOBS = {j.name: j for j in [
    # stored when they occur
    _job("DER_CPID", DAILY, WAREHOUSE, counterparty.CPID_DAILY, prevalidation=_SINGLE),
    _job("DER_JCP", DAILY, WAREHOUSE, counterparty.JCP_DAILY, prevalidation=_SINGLE),
    _job("DER_OCP", DAILY, WAREHOUSE, counterparty.OCP_DAILY, prevalidation=_SINGLE),
    # daily
    _job("DER_CAC", DAILY, STAGING, account.CAC_DAILY, prevalidation=_MULTIPLE),
    _job("DER_FXL", DAILY, STAGING, account.FXL_DAILY, prevalidation=_MULTIPLE),
    _job("DER_OTDD", DAILY, STAGING, outstanding.OTDD_DAILY, prevalidation=_MULTIPLE),
    _job("DER_RLI", DAILY, STAGING, outstanding.RLI_DAILY, prevalidation=_MULTIPLE),
    _job("DER_BRD", DAILY, STAGING, outstanding.BRD_DAILY, prevalidation=_MULTIPLE),
    _job("DER_RDA", DAILY, STAGING, outstanding.RDA_DAILY),
    _job("DER_CPEN", DAILY, WAREHOUSE, counterparty.CPEN, clear=("ent_id", "cntpr_id"),
         stamped=True, exports_when_failed=False),
    _job("DER_INTP", DAILY, STAGING, interest.INTP_DAILY, prevalidation=_MULTIPLE),
    _job("DER_INTR", DAILY, STAGING, interest.INTR, prevalidation=_MULTIPLE),
    _job("DER_INTRV", DAILY, STAGING, interest.INTRV_DAILY),
    # monthly
    _job("DER_GRPD", MONTHLY, WAREHOUSE, account.GRPD_MONTHLY),
    _job("DER_DR", MONTHLY, WAREHOUSE, account.DR_MONTHLY, prevalidation=_SINGLE),
    _job("DER_DRM", MONTHLY, WAREHOUSE, account.DRM_MONTHLY, prevalidation=_SINGLE),
    _job("DER_LOP", MONTHLY, WAREHOUSE, account.LOP_MONTHLY),
    _job("DER_CAC", MONTHLY, WAREHOUSE, account.CAC_MONTHLY, prevalidation=_SINGLE,
         set_from=_FROM_MAPPING_CAC),
    _job("DER_CACD", MONTHLY, WAREHOUSE, account.CACD_MONTHLY, prevalidation=_SINGLE),
    _job("DER_CC", MONTHLY, NOTHING, stages=(EXPORT,)),
    _job("DER_MGL", MONTHLY, WAREHOUSE, account.MGL_MONTHLY, prevalidation=_SINGLE),
    _job("DER_PJF", MONTHLY, WAREHOUSE, account.PJF_MONTHLY),
    _job("DER_SHM", MONTHLY, WAREHOUSE, account.SHM_MONTHLY),
    _job("DER_ACXAC", MONTHLY, WAREHOUSE, account.ACXAC_MONTHLY),
    _job("DER_PLC", MONTHLY, WAREHOUSE, account.PLC_MONTHLY, prevalidation=_SINGLE),
    _job("DER_CL", MONTHLY, WAREHOUSE, credit_line.CL_MONTHLY, prevalidation=_SINGLE,
         set_from=_FROM_MAPPING_CL),
    _job("DER_CLLT", MONTHLY, WAREHOUSE, credit_line.CLLT_MONTHLY),
    _job("DER_CLP", MONTHLY, WAREHOUSE, credit_line.CLP_MONTHLY, prevalidation=_SINGLE),
    _job("DER_COLP", MONTHLY, WAREHOUSE, credit_line.COLP_MONTHLY, prevalidation=_SINGLE),
    _job("DER_OVD", MONTHLY, WAREHOUSE, credit_line.OVD_MONTHLY),
    _job("DER_AGF", MONTHLY, WAREHOUSE, clear=("ac_id", "mvmt_tp"),
         stamped=True, fill={"org_id": DEFAULT_ORG, "data_dt": FILLER_DATE},
         exports_when_failed=False),
    _job("DER_COL", MONTHLY, WAREHOUSE, collateral.COL_MONTHLY, new_only=True),
    _job("DER_RER", MONTHLY, WAREHOUSE, collateral.RER_MONTHLY),
    _job("DER_CVG", MONTHLY, WAREHOUSE, collateral.CVG_MONTHLY),
    _job("DER_GE", MONTHLY, WAREHOUSE, collateral.GE_MONTHLY, prevalidation=_SINGLE),
    _job("DER_PVG", MONTHLY, WAREHOUSE, collateral.PVG_MONTHLY),
    _job("DER_BLP", MONTHLY, WAREHOUSE, counterparty.BLP_MONTHLY, step=DAILY),
    _job("DER_RTR", MONTHLY, WAREHOUSE, counterparty.RTR_MONTHLY, new_only=True),
    _job("DER_CPEN", MONTHLY, STAGING, counterparty.CPEN, dependents=_ENTITY_MASTER,
         step=DAILY),
    _job("DER_CPDG", MONTHLY, WAREHOUSE, counterparty.CPDG, step=DAILY),
    _job("DER_INTR", MONTHLY, WAREHOUSE, interest.INTR),
    _job("DER_REV", MONTHLY, WAREHOUSE, review.REV_MONTHLY),
    # first phase
    _job("DER_OTDD", DAILY, TEXT, outstanding.OTDD_P1, "p1_", fill={"org_id": DEFAULT_ORG},
         constants={"src_stm": "SFTP"}, step=MONTHLY),
    _job("DER_CPEN", DAILY, WAREHOUSE, counterparty.CPEN, "p1_", step=MONTHLY),
    _job("DER_PRT", MONTHLY, WAREHOUSE, None, "p1_", stages=(LOAD, RESHAPE, APPLY, EXPORT)),
    _job("DER_CACD", MONTHLY, WAREHOUSE, account.CACD_P1, "p1_"),
    _job("DER_OTDM", MONTHLY, WAREHOUSE, outstanding.OTDM_P1, "p1_"),
    _job("DER_LND", MONTHLY, WAREHOUSE, collateral.LND_P1, "p1_"),
    _job("DER_BLD", MONTHLY, WAREHOUSE, collateral.BLD_P1, "p1_"),
    _job("STG_BLD", MONTHLY, WAREHOUSE, None, "p1_", stages=_PASSES_ON, step=NO_STEP),
    _job("DER_BLP", MONTHLY, WAREHOUSE, counterparty.BLP_P1, "p1_"),
    _job("DER_PLP", MONTHLY, WAREHOUSE, counterparty.PLP_P1, "p1_"),
    _job("DER_CPEN", MONTHLY, WAREHOUSE, counterparty.CPEN, "p1_",
         dependents={**_ENTITY_MASTER, "STG_ENT": ("ent_id",), "STG_ENT_DTL": ("ent_id", "cntpr_id")}),
    _job("DER_DG", MONTHLY, WAREHOUSE, None, "p1_", stages=(LOAD, RESHAPE, APPLY, EXPORT)),
    _job("DER_CPDG", MONTHLY, WAREHOUSE, counterparty.CPDG, "p1_"),
    _job("DER_RSK", MONTHLY, WAREHOUSE, review.RSK_P1, "p1_"),
    # a second, hand-run copy of one pipeline
    _job("DER_CPID", DAILY, WAREHOUSE, counterparty.CPID_RERUN, "rerun_"),
    # tables built from other tables, without checks
    Job("stage_counterparty_daily", "STG_CTP", DAILY, WAREHOUSE, stages=_PASSES_ON, step=NO_STEP,
        dependents={"STG_ENT": ("ent_id",), "STG_ENT_DTL": ("ent_id", "cntpr_id")}),
    Job("stage_counterparty", "STG_CTP", MONTHLY, INSIDE, stages=(APPLY,)),
    Job("stage_counterparty_entity", "STG_CTP_ETT", MONTHLY, INSIDE, stages=(APPLY,)),
    Job("stage_credit_account", "STG_CAC", MONTHLY, INSIDE, stages=(APPLY,)),
    Job("copy_from_source", "STG_CAC", DAILY, WAREHOUSE, stages=_PASSES_ON, step=NO_STEP),
]}

#: The jobs that store an entity, as their target or a dependent.
WRITERS: dict[str, tuple[str, ...]] = {}
for _writer in JOBS.values():
    if APPLY in _writer.stages:
        for _entity in (_writer.entity, *_writer.dependents):
            WRITERS[_entity] = (*WRITERS.get(_entity, ()), _writer.name)
