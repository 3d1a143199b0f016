"""Every rule of every job: clean worlds break nothing, each planted fault breaks its rules."""

import re

import pytest
from pyspark.sql import functions as F
from faults import FAULTS
from worlds import frames

from veriledger.operators.ruleset import evaluate
from veriledger.plans.jobs import JOBS
from veriledger.specs.codes import sample_codes
from veriledger.specs.entities import ENTITIES

PERIOD = "20240331"


def planted(job):
    """World name -> changes, and the (world, rule) pairs that must come out."""
    changes, expected = {}, set()
    for i, (codes, by_entity) in enumerate(FAULTS[job.name]):
        w = f"f{i}"
        changes[w] = {}
        for entity, columns in by_entity.items():
            if isinstance(columns, dict):
                columns = {k: v.format(w=w) if isinstance(v, str) else v for k, v in columns.items()}
            changes[w][entity or job.entity] = columns
        expected |= {(w, code) for code in codes}
    return changes, expected


def empty_ledgers(spark):
    return {n: spark.createDataFrame([], ENTITIES[n].schema) for n in ("DS_BLS", "DS_PVS")}


def found(spark, job):
    changes, expected = planted(job)
    tables = {**empty_ledgers(spark), **frames(spark, job.rules.reads, changes)}
    rows = evaluate(tables, job.rules, PERIOD, sample_codes()).collect()
    assert all(r["entity"] == job.entity and r["msr_prd_id"] == PERIOD for r in rows)
    by_world = [(re.search(r"#(\w+)", r["key"]), r["rule"], r["key"]) for r in rows]
    return sorted((m.group(1) if m else key, rule) for m, rule, key in by_world), sorted(expected)


@pytest.mark.parametrize("name", sorted(FAULTS))
def test_planted_faults(spark, name):
    mine, expected = found(spark, JOBS[name])
    assert mine == expected


@pytest.mark.parametrize("name", ["daily_rli", "monthly_cacd", "monthly_clp", "p1_monthly_rsk"])
def test_planted_faults_without_broadcasts(spark, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mine, expected = found(spark, JOBS[name])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert mine == expected


def test_more_rules_than_a_number_has_bits(spark):
    from veriledger.operators import conditions as c
    from veriledger.operators import families as f
    from veriledger.operators.ruleset import Pass, RuleSet

    rules = tuple(f.implies(f"R{i}", "V1", c.sql("true"), c.sql(f"id % 140 <> {i}")) for i in range(140))
    rows = evaluate({"t": spark.range(280).withColumn("src_stm", F.lit("x"))},
                    RuleSet("t", (Pass("t", ("id",), rules),)), PERIOD).collect()
    assert sorted((r["rule"], int(r["key"])) for r in rows) == sorted(
        (f"R{i % 140}", i) for i in range(280))


def test_keys_of_several_parts_never_read_alike(spark):
    from veriledger.operators.ruleset import key_text

    rows = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a\\", "b"), ("a", "\\b")], "x string, y string")
    assert len({r[0] for r in rows.select(key_text(["x", "y"])).collect()}) == 4


@pytest.mark.parametrize("name", sorted(FAULTS))
def test_every_rule_has_a_fault(name):
    job = JOBS[name]
    covered = {code for codes, _ in FAULTS[name] for code in codes}
    ledger = {b.code for r in job.rules.reconciliations for a in r.against for b in a.balances
              if a.entity != "DS_FCP"}
    assert set(job.rules.codes) - ledger == covered


def test_all_jobs_with_rules_are_covered():
    assert {j.name for j in JOBS.values() if j.rules} == set(FAULTS)


def test_ledgers(spark):
    """Each of the six balances is off by one in its own period, and holds in a clean one."""
    import datetime
    from decimal import Decimal

    from veriledger.specs import codes as k
    from veriledger.specs.outstanding import OTDM_BALANCES, OTDM_P1

    quarter, other = datetime.date(2024, 3, 31), datetime.date(2024, 2, 29)
    classes = [a for a, _ in k.CLASS_PAIRS.values()]
    otdm = [(d, org, cls, Decimal(100), Decimal(30)) for d in (quarter, other)
            for org in ("TCB", "FCB") for cls in classes]
    bls = [(d, g, item, Decimal(250)) for d in (quarter, other) for g in ("116002", "116003")
           for item in ("955010", "955124")]
    bls += [(quarter, "116008", "955010", Decimal(7)), (quarter, "116002", "955011", Decimal(7))]
    pvs = [(quarter, g, p, "960080", Decimal(70)) for g in ("116002", "116008")
           for _, p in k.CLASS_PAIRS.values()]
    pvs += [(quarter, "116003", "020011", "960080", Decimal(9)), (quarter, "116002", "020011", "1", Decimal(9))]

    def differences(otdm, bls, pvs):
        tables = {
            "DER_OTDM": spark.createDataFrame(otdm, "data_dt date, org_id string, ast_and_cntg_clss "
                                              "string, otsnd_amt_in_baht decimal(18,2), "
                                              "uern_rev_in_baht decimal(18,2)"),
            "DS_BLS": spark.createDataFrame(bls, "ds_dt date, fi_rpt_grp_id string, bsh_itm_tp_id "
                                            "string, bsh_amt decimal(18,2)"),
            "DS_PVS": spark.createDataFrame(pvs, "ds_dt date, fi_rpt_grp_id string, ast_cl_tp_id "
                                            "string, prvn_smy_itm_tp_id string, amt decimal(18,2)"),
        }
        for view in OTDM_P1.views:
            tables[view.name] = view.build(tables, {})
        return OTDM_BALANCES.differences(tables, {}).collect()

    clean = differences(otdm, bls, pvs)
    assert len(clean) == 24 and all(r["ok"] for r in clean)
    off = differences(otdm, bls[1:], [*pvs[1:], (quarter, "116002", "020013", "960080", Decimal(1))])
    broken = {(r["rule"], r["org_id"], r["data_dt"]): r["difference"] for r in off if not r["ok"]}
    assert broken == {
        ("CMOTDM003", "TCB", quarter): Decimal(250),
        ("CMOTDM004", "TCB", quarter): Decimal(70),
        ("CMOTDM006", "TCB", quarter): Decimal(-1),
    }
    alone = differences(otdm[:0], bls, pvs[:0])
    assert {r["rule"] for r in alone} == {"CMOTDM003"} and not any(r["ok"] for r in alone)


@pytest.mark.parametrize("name", ["rules_outstanding_monthly", "rules_account_detail", "rules_credit_account",
                                  "rules_flexible_payment"])
def test_generated_methods_are_compiled(spark, name):
    """The JVM interprets methods of more than 8000 bytes; the largest rule sets stay below that."""
    from __spark_entry__ import SMOKE_DIR, queries

    violations = queries()[name](spark, SMOKE_DIR)
    violations.collect()
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package")
    stages = debug.codegenStringSeq(violations._jdf.queryExecution().executedPlan())
    assert stages.size()
    assert max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) < 8000
