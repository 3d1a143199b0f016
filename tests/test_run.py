"""Whole runs of jobs: load, store, validate, export, advance."""

import datetime

import pytest
from pyspark.sql import functions as F
from worlds import frames

from veriledger.operators import conditions as c
from veriledger.operators import families as f
from veriledger.plans.jobs import JOBS
from veriledger.plans.run import Setting, run_job
from veriledger.specs.codes import sample_codes

MOMENT = datetime.datetime(2024, 3, 31, 12, 0, tzinfo=datetime.timezone.utc)


@pytest.fixture
def setting(spark, tmp_path):
    spark.sql("create database if not exists runs")

    def make(run_id="1", frames_=None, organization=None):
        return Setting(spark, str(tmp_path), run_id, MOMENT, "runs", organization,
                       sample_codes(), frames_ or {})

    yield make
    spark.sql("drop database runs cascade")


def _source(spark, entity, faults=None):
    return frames(spark, [entity], faults or {})[entity].drop("msr_prd_id", "ppn_tm")


def test_passing_run_advances_and_repeats(spark, setting):
    job = JOBS["daily_cac"]
    parents = frames(spark, ["DER_CPEN"], {})
    first = run_job(setting("1", parents), job, "20240331", _source(spark, "DER_CAC"))
    assert first.passed and first.next_period == "20240401"
    assert set(first.counts) == set(job.rules.codes)
    again = run_job(setting("2", parents), job, "20240331", _source(spark, "DER_CAC"))
    assert again.passed and spark.table("runs.der_cac_d").count() == 2
    report = spark.read.option("header", True).csv(again.report)
    assert report.count() == 2 and "Account Id" in report.columns
    row = spark.table("runs.der_cac_d").head()
    assert row["ppn_tm"] == datetime.datetime(2024, 3, 31, 19, 0)


def test_failing_run_stays_but_exports(spark, setting, tmp_path):
    faults = {"f0": {"DER_CAC": dict(contract_amount_oc=-1)},
              "f1": {"DER_CAC": dict(contract_amount_oc=-1, interest_freq_unit=None)}}
    result = run_job(setting("7", frames(spark, ["DER_CPEN"], faults)), JOBS["daily_cac"], "20240331",
                     _source(spark, "DER_CAC", faults))
    assert not result.passed and result.next_period == "20240331"
    assert {k: v for k, v in result.counts.items() if v} == {"CNCAC002": 2, "CMCAC009": 1}
    assert spark.read.option("header", True).csv(result.report).count() == 4
    failed = spark.read.option("header", True).csv(str(tmp_path / "failed" / "daily_cac" / "7"))
    assert sorted((r["rule"], r["key"], r["src_stm"]) for r in failed.collect()) == [
        ("CMCAC009", "A#f1", "CMS"), ("CNCAC002", "A#f0", "CMS"), ("CNCAC002", "A#f1", "CMS")]


def test_prevalidation_counts_and_passes_rows_on(spark, setting, tmp_path):
    rules = [f.required_if("P1", c.always(), "ccy"), f.within("P2", "contract_amount_oc", c.above("contract_amount_oc", 100))]
    result = run_job(setting("3", frames(spark, ["DER_CPEN"], {})), JOBS["daily_cac"], "20240331",
                     _source(spark, "DER_CAC"), rules)
    assert result.prevalidation == {"P1": 0, "P2": 2}
    path = str(tmp_path / "prevalidation" / "daily_cac" / "20240331" / "3")
    assert spark.read.option("header", True).csv(path).count() == 2
    assert "P1" not in spark.table("runs.der_cac_d").columns


def test_entity_id_comes_from_the_mapping(spark, setting):
    rows = _source(spark, "DER_CAC").drop("ent_id")
    result = run_job(setting("1", frames(spark, ["DER_CPEN"], {})), JOBS["monthly_cac"], "20240331", rows)
    assert result.passed and result.next_period == "20240430"
    assert sorted(r["ent_id"] for r in spark.table("runs.der_cac").collect()) == ["E#clean", "E#other"]


def test_new_only_keeps_what_is_stored(spark, setting):
    job = JOBS["monthly_col"]
    parents = frames(spark, ["DER_LND", "DER_BLD"], {})
    first = _source(spark, "DER_COL")
    run_job(setting("1", parents), job, "20240229", first)
    more = _source(spark, "DER_COL", {"new": {}})
    for run in ("2", "3"):
        run_job(setting(run, parents), job, "20240331", more)
    stored = sorted((r["collateral_id"], r["msr_prd_id"]) for r in spark.table("runs.der_col").collect())
    assert stored == [("C#clean", "20240229"), ("C#new", "20240331"), ("C#other", "20240229")]


def test_dependents_are_filled(spark, setting):
    run_job(setting("1", frames(spark, ["DER_CPID"], {})), JOBS["p1_monthly_cpen"], "20240331",
            _source(spark, "DER_CPEN"))
    for table in ("mas_ent", "mas_ent_dtl", "stg_ent", "stg_ent_dtl"):
        assert spark.table(f"runs.p1_{table}").count() == 2


def test_staging_jobs(spark, setting):
    rows = spark.createDataFrame([("P1", "E1", "x"), ("P2", "E1", "y")],
                                 "cntpr_id string, ent_id string, name string")
    result = run_job(setting(), JOBS["stage_counterparty_daily"], "20240331", rows)
    assert result.passed and result.report is None and result.next_period == "20240331"
    assert spark.table("runs.stg_ctp_d").count() == 2 and spark.table("runs.stg_ent_d").count() == 1
    assert spark.table("runs.stg_ent_dtl_d").count() == 2
    inside = spark.table("runs.stg_ctp_d").select("ent_id", "cntpr_id")
    run_job(setting(), JOBS["stage_counterparty_entity"], "20240331", inside)
    assert spark.table("runs.stg_ctp_ett").count() == 2
    staged = run_job(setting(), JOBS["p1_monthly_stg_bld"], "20240331", _source(spark, "DER_BLD"))
    assert staged.next_period == "20240331" and spark.table("runs.stg_bld").count() == 2


def test_spaces_and_fillers(spark, setting):
    rows = spark.createDataFrame([("A1", "  ", 5), ("  ", "IN", 6)],
                                 "ac_id string, mvmt_tp string, mvmt_amt_in_baht int")
    result = run_job(setting(), JOBS["monthly_agf"], "20240331", rows)
    stored = spark.table("runs.der_agf").orderBy("mvmt_amt_in_baht").collect()
    assert result.passed and [r["org_id"] for r in stored] == ["006", "006"]
    assert stored[0]["mvmt_tp"] is None and stored[1]["ac_id"] is None
    assert stored[0]["data_dt"] == datetime.date(2024, 3, 31)


def test_stamped_rows_get_the_organisation_and_date(spark, setting):
    rows = spark.createDataFrame([(" E1 ", "P1"), ("  ", "P1")], "ent_id string, cntpr_id string")
    parents = frames(spark, ["DER_CPID"], {})
    run_job(setting("1", parents, "042"), JOBS["daily_cpen"], "20240331", rows)
    stored = spark.table("runs.der_cpen_d").collect()
    assert {(r["ent_id"], r["org_id"], str(r["data_dt"])) for r in stored} == {
        ("E1", "042", "2024-03-31"), (None, "042", "2024-03-31")}


def test_empty_report(spark, setting):
    result = run_job(setting(), JOBS["monthly_cc"], "20240331")
    rows = spark.read.option("header", True).csv(result.report).collect()
    assert len(rows) == 1 and rows[0]["Data Date"] == "2020-05-17" and rows[0]["Account Id"] is None


def test_export_without_rules(spark, setting):
    result = run_job(setting(), JOBS["p1_monthly_prt"], "20240331", _source(spark, "DER_PRT"))
    assert result.passed and result.counts == {}
    assert spark.read.option("header", True).csv(result.report).count() == 2


def test_older_jobs_export_only_when_passed(spark, setting):
    result = run_job(setting("1", frames(spark, ["DER_CPID"], {"f": {"DER_CPID": None}})),
                     JOBS["daily_cpen"], "20240331", _source(spark, "DER_CPEN", {"f": {}}))
    assert not result.passed and result.report is None and result.counts == {"RICPEN001": 1}


def test_from_landed_text_to_report(spark, setting, tmp_path):
    """Two sources land, are read together, and run as one daily job."""
    from veriledger.plans import landing
    from veriledger.plans.jobs import LANDINGS

    (tmp_path / "RV_20240331.TXT").write_text("|2024-03-31|I#clean|2024-03-31|1.5\n")
    (tmp_path / "RW_20240331.TXT").write_text("007|2024-03-31|none|2024-03-31|2\n007|2024-03-31|R|2024-03-31|bad\n")
    loads = [landing.land_text(spark, LANDINGS[f"land_intrv_{s}"], str(tmp_path), name, "20240331",
                               MOMENT, n, "runs")
             for s, name, n in (("tfs", "RV", 1), ("trs", "RW", 2))]
    assert [(x.kept, x.rejected) for x in loads] == [(1, 0), (1, 1)]
    rows = landing.staged_rows(spark, [LANDINGS["land_intrv_tfs"], LANDINGS["land_intrv_trs"]],
                               "20240331", "runs")
    result = run_job(setting("1", frames(spark, ["DER_INTR"], {})), JOBS["daily_intrv"], "20240331", rows)
    assert result.counts == {"RIINTRV001": 1} and not result.passed
    failed = spark.read.option("header", True).csv(str(tmp_path / "failed" / "daily_intrv" / "1")).head()
    assert (failed["rule"], failed["key"], failed["src_stm"]) == ("RIINTRV001", "none", "TRS")


def test_text_job_with_a_fixed_column_list(spark, setting, tmp_path):
    from pyspark.sql import types as T

    from veriledger.sources import text

    (tmp_path / "OT_a.TXT1").write_text("|2024-03-31|A#clean|USD|10\n")
    (tmp_path / "OT_b.TXT2").write_text("007|2024-03-31|A#other|USD|-1\n")
    schema = T.StructType([T.StructField(n, t) for n, t in [
        ("org_id", T.StringType()), ("data_dt", T.DateType()), ("ac_id", T.StringType()),
        ("ccy", T.StringType()), ("otsnd_amt_in_orig_ccy", T.DecimalType(18, 2))]])
    rows = text.read_pipe_text(spark, text.landed_pattern(str(tmp_path), "OT"), schema).rows
    parents = frames(spark, ["DER_CAC", "DS_FCP"], {})
    result = run_job(setting("1", parents), JOBS["p1_daily_otdd"], "20240331", rows)
    assert {k for k, v in result.counts.items() if v} == {"CNOTDD002"}
    stored = {r["ac_id"]: (r["org_id"], r["src_stm"]) for r in spark.table("runs.p1_der_otdd_d").collect()}
    assert stored == {"A#clean": ("006", "SFTP"), "A#other": ("007", "SFTP")}


def test_jobs_of_one_entity_keep_their_own_rows(spark, setting):
    """A daily and a monthly job of the same period, with different accounts."""
    parents = frames(spark, ["DER_CPEN"], {})
    daily = _source(spark, "DER_CAC").withColumn("ac_id", F.concat(F.lit("D"), "ac_id"))
    run_job(setting("1", parents), JOBS["daily_cac"], "20240331", daily)
    run_job(setting("2", parents), JOBS["monthly_cac"], "20240331", _source(spark, "DER_CAC"))
    assert {r["ac_id"][0] for r in spark.table("runs.der_cac_d").collect()} == {"D"}
    assert {r["ac_id"][0] for r in spark.table("runs.der_cac").collect()} == {"A"}


def test_no_two_jobs_store_into_one_table():
    from collections import Counter

    from veriledger.plans.jobs import APPLY

    stored = Counter(j.table(e) for j in JOBS.values() if APPLY in j.stages for e in (j.entity, *j.dependents))
    assert max(stored.values()) == 1
    assert JOBS["daily_cac"].table("DER_CAC") == "DER_CAC_D" and JOBS["monthly_cac"].table("DER_CAC") == "DER_CAC"
    assert JOBS["p1_daily_otdd"].sources("DER_CAC")[0] == "DER_CAC_D"
    assert JOBS["p1_monthly_otdm"].sources("DER_CACD") == ["P1_DER_CACD", "DER_CACD"]


# How a period moves on where that is not the job's cadence.
STEPS = {"p1_daily_otdd": "monthly", "p1_daily_cpen": "monthly", "monthly_blp": "daily", "monthly_cpdg": "daily",
         "monthly_cpen": "daily", "p1_monthly_stg_bld": "none", "stage_counterparty_daily": "none",
         "copy_from_source": "none"}


def test_steps():
    assert {n: j.step for n, j in JOBS.items() if j.step} == STEPS
