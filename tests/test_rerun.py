"""Counts observed by writes, and checks that are run again only where something changed."""

import datetime
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from worlds import frames

from veriledger.operators import conditions as c
from veriledger.operators import families as f
from veriledger.operators import observed
from veriledger.plans import rerun
from veriledger.plans.catalogue_queries import entities
from veriledger.plans.jobs import JOBS
from veriledger.plans.run import Setting, run_job
from veriledger.specs.codes import sample_codes

SF = "/root/testdata/sf0.001"
PERIOD = "20240131"
MOMENT = datetime.datetime(2024, 2, 1)


# counts

def test_counts_are_those_of_the_rows(spark, tmp_path):
    df = spark.range(0, 1000, 1, 7).select(F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").alias("rule"))
    for rows in (df, df.hint("rebalance", F.col("rule")), df.filter("rule = 'a'"), df.limit(0), df.repartition(3)):
        counts = observed.write_parquet(rows, f"{tmp_path}/x", {
            "all": observed.rows(), **observed.by_value("rule", ["a", "b", "c", "a"])})
        stored = spark.read.schema(rows.schema).parquet(f"{tmp_path}/x")
        assert counts == {"all": stored.count(), **{k: stored.filter(F.col("rule") == k).count() for k in "abc"}}


@pytest.fixture
def counted(spark):
    """Makes a frame that tells how often its rows were read."""
    read = spark.sparkContext.accumulator(0)

    def make(df):
        def see(batches):
            for batch in batches:
                read.add(batch.num_rows)
                yield batch
        return df.mapInArrow(see, df.schema)

    return make, read


def test_a_source_is_read_once(spark, counted, tmp_path):
    """Loading counts, stores and lists rows that break rules from one read of the source."""
    make, read = counted
    spark.sql("create database if not exists reading")
    try:
        given = frames(spark, ["DER_CPEN"], {})
        setting = Setting(spark, str(tmp_path), "1", MOMENT, "reading", codes=sample_codes(), frames=given)
        source = make(frames(spark, ["DER_CAC"], {})["DER_CAC"].drop("msr_prd_id", "ppn_tm"))
        rules = [f.within("E1", "contract_amount_oc", c.above("contract_amount_oc", 100)), f.required_if("E2", c.always(), "ccy")]
        result = run_job(setting, JOBS["daily_cac"], PERIOD, source, rules)
        assert result.prevalidation == {"E1": 2, "E2": 0} and read.value == 2
        assert spark.table("reading.der_cac_d").count() == 2
    finally:
        spark.sql("drop database reading cascade")


# checks run again

@pytest.fixture
def world(spark, tmp_path):
    job = JOBS["monthly_cacd"]
    tables = {n: t.cache() for n, t in entities(spark, SF, job.rules.reads).items()}
    setting = Setting(spark, str(tmp_path), "first", MOMENT, codes=sample_codes(), frames=tables)
    yield setting, job, tables
    for t in tables.values():
        t.unpersist()


def violations(checked):
    return Counter((r["rule"], r["key"], r["src_stm"]) for r in checked.violations.collect())


def again(setting, job, tables, run="second", before="first"):
    """The check that looks at changes only, and a whole one."""
    own = rerun.check(replace(setting, run_id=run, frames=tables), job, PERIOD, before)
    whole = rerun.check(replace(setting, run_id=f"{run}-whole", frames=tables), job, PERIOD)
    assert violations(own) == violations(whole) and dict(own.counts) == dict(whole.counts)
    assert whole.checked == whole.rows == own.rows
    return own


def test_nothing_changed(world):
    setting, job, tables = world
    first = rerun.check(setting, job, PERIOD)
    assert first.checked == first.rows == tables["DER_CACD"].count() and sum(first.counts.values())
    assert again(setting, job, tables).checked == 0
    # another load time is no change
    stamped = {**tables, "DER_CACD": tables["DER_CACD"].withColumn("ppn_tm", F.current_timestamp())}
    assert again(setting, job, stamped, "third", "second").checked == 0


def test_planted_changes(spark, world):
    """Changed, new and missing rows and parents; keys that several rows have."""
    setting, job, tables = world
    rerun.check(setting, job, PERIOD)
    details, accounts, lines = tables["DER_CACD"], tables["DER_CAC"], tables["DER_CL"]
    mix, parent = F.pmod(F.xxhash64("ac_id", "open_date"), F.lit(100)), F.pmod(F.xxhash64("ac_id"), F.lit(100))
    worlds = {
        "rows": {"DER_CACD": details.withColumn("regulated_product", F.when(mix == 1, "x").otherwise(F.col("regulated_product")))},
        "new": {"DER_CACD": details.union(details.filter(mix == 2).withColumn("ac_id", F.concat("ac_id", F.lit("new"))))},
        "twice": {"DER_CACD": details.union(details.filter(mix == 3))},
        "gone": {"DER_CACD": details.filter(mix != 4)},
        "parent": {"DER_CAC": accounts.withColumn("loan_type", F.when(parent == 5, "contingent_loans").otherwise(F.col("loan_type")))},
        "no parent": {"DER_CAC": accounts.filter(parent != 6), "DER_CL": lines.filter("credit_line_id <> 'L1'")},
        "more parents": {"DER_CL": lines.union(lines.limit(1).withColumn("credit_line_id", F.lit("L2000")))},
    }
    before = "first"
    for name, changed in worlds.items():
        own = again(setting, job, {**tables, **changed}, name, before)
        assert own.checked < own.rows / 2, name
        before = name
    assert again(setting, job, tables, "back", before).checked < 2000


def test_irrelevant_parent_columns_do_not_matter(world):
    """Facts are compared, not parent rows: a column that no rule looks up changes nothing."""
    setting, job, tables = world
    rerun.check(setting, job, PERIOD)
    other = {**tables, "DER_CAC": tables["DER_CAC"].withColumn("payment_freq_condition", F.lit("other"))}
    assert again(setting, job, other).checked == 0


def test_jobs_with_several_passes_and_balances(spark, tmp_path):
    """Passes over other entities keep their own violations; balances are taken anew."""

    from veriledger.plans import account_queries, party_queries

    for name, derived in (("monthly_shm", account_queries.DERIVED), ("p1_monthly_otdm", party_queries.DERIVED)):
        job = JOBS[name]
        given = entities(spark, SF, job.rules.reads, derived)
        setting = Setting(spark, f"{tmp_path}/{name}", "first", MOMENT, codes=sample_codes(), frames=given)
        rerun.check(setting, job, PERIOD)
        entity = job.rules.passes[-1].entity
        fewer = {**given, entity: given[entity].filter("ac_id <> 'A7'")}
        own = rerun.check(replace(setting, run_id="second", frames=fewer), job, PERIOD, "first")
        whole = rerun.check(replace(setting, run_id="third", frames=fewer), job, PERIOD)
        assert violations(own) == violations(whole) and sum(whole.counts.values()), name


def test_a_sieve_lets_all_rows_with_a_key_through(spark, tmp_path):
    from veriledger.operators.sieve import Sieve

    rows = spark.range(0, 20_000, 1, 4).selectExpr("case when id % 10 > 0 then id end as k", "string(id % 7) as t", "id as row")
    for name, keys, on in (("some", spark.range(0, 20_000, 50).selectExpr("int(id) as a"), [("k", "a")]),
                           ("pairs", spark.range(0, 20_000, 30).selectExpr("id as a", "int(id % 7) as b"), [("k", "a"), ("t", "b")]),
                           ("none", spark.range(0).selectExpr("id as a"), [("k", "a")])):
        may, cannot = Sieve.of(keys, rows, on, f"{tmp_path}/{name}").parted(rows)
        assert may.columns == cannot.columns == rows.columns
        parts = Counter(map(tuple, may.collect())) + Counter(map(tuple, cannot.collect()))
        assert parts == Counter(map(tuple, rows.collect()))
        plain = [F.col(c) == F.col(k) for c, k in on]
        with_key = rows.join(keys, plain, "left_semi").select("row")
        assert with_key.exceptAll(may.select("row")).count() == 0
        assert may.count() <= with_key.count() + 20_000 / 10


def test_rows_that_did_not_change_are_not_shuffled(spark, world, monkeypatch):
    """Of a whole table and its violations, joins see little more than what changed."""
    setting, job, tables = world
    rerun.check(setting, job, PERIOD)
    seen, plain = Counter(), rerun.join_parent

    def watched(child, parent, on, how):
        seen[how, on[0][0]] += child.count()
        return plain(child, parent, on, how)

    monkeypatch.setattr(rerun, "join_parent", watched)
    mix = F.pmod(F.xxhash64("ac_id", "open_date"), F.lit(100))
    details = tables["DER_CACD"].withColumn("regulated_product", F.when(mix == 1, "x").otherwise(F.col("regulated_product")))
    own = rerun.check(replace(setting, run_id="second", frames={**tables, "DER_CACD": details}), job, PERIOD, "first")
    assert 0 < own.checked and seen["left_semi", "__key"] < own.rows / 2
    assert sum(n for (how, c), n in seen.items() if how == "left_semi" and c != "__key") < own.rows / 20
    assert seen["left_anti", "key"] < sum(own.counts.values()) / 2
