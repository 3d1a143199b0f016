"""Facts that rule sets share, and tables laid out so that joins move no rows."""

import datetime
import re
import uuid
from collections import Counter
from functools import partial

import pytest
from faults import FAULTS
from pyspark.sql import functions as F
from worlds import frames

from veriledger.operators import facts
from veriledger.operators.ruleset import Pass, RuleSet, any_row, evaluate, with_views
from veriledger.plans import account_queries, party_queries, shared_queries
from veriledger.plans.catalogue_queries import PERIOD, entities
from veriledger.plans.jobs import JOBS
from veriledger.plans.run import Setting, run_job, validate, validate_all
from veriledger.operators import conditions as c
from veriledger.operators import families as f
from veriledger.sources import layout
from veriledger.specs import account
from veriledger.specs.codes import sample_codes
from veriledger.specs.shared import account as account_lookup
from veriledger.specs.shared import is_true, lookup

SF = "/root/testdata/sf0.001"
MOMENT = datetime.datetime(2024, 3, 31, 12, 0, tzinfo=datetime.timezone.utc)


def rows(df):
    return Counter(tuple(r) for r in df.select("rule", "key").collect())


def kept(place, frame):
    return frame.cache()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("module", [account_queries, party_queries])
def test_same_rows_as_own_parents(spark, module):
    """All rule sets of a module over one set of facts."""
    codes = sample_codes()
    # the first-phase sets read the catalogue's entities
    named = {n: rules for n, (rules, _) in module.RULES.items() if n not in party_queries.FIRST_RULES}
    rule_sets = list(named.values())
    tables = entities(spark, SF, sorted({e for r in rule_sets for e in r.reads}), module.DERIVED)
    for rules in rule_sets:
        tables = with_views(tables, rules, codes)
    parents = facts.share(tables, codes, rule_sets, kept)
    mine, plain = Counter(), Counter()
    for name, rules in named.items():
        for total, own in ((mine, parents), (plain, None)):
            found = evaluate(tables, rules, PERIOD, codes, own).groupBy("rule").agg(
                F.count("*"), F.sum(F.xxhash64("key").cast("decimal(38,0)")))
            total.update((name, *r) for r in found.collect())
    for frame in parents.stored.values():
        frame.unpersist()
    assert mine == plain and sum(plain.values()) > 20


def test_lookups_with_conditions_and_equal_facts(spark):
    """Facts under a condition count only rows that meet it; a lookup finds nothing if no row does."""
    open_ = c.equals("account_status", "open")
    thb = any_row("thb", c.equals("ccy", "THB"))
    rule_sets = [RuleSet("DER_CACD", (Pass("DER_CACD", ("ac_id",), (
        f.references("R1", "open"), f.references("R2", "every"),
        f.must_not_be_reported("R3", is_true("open__thb"), ("open",)),
        f.must_not_be_reported("R4", is_true("every__thb"), ("every",)),
    ), (lookup("open", "DER_CAC", "ac_id", thb, where=open_), lookup("every", "DER_CAC", "ac_id", thb))),))]
    rule_sets.append(RuleSet("DER_MGL", (Pass("DER_MGL", ("ac_id",), (
        f.must_not_be_reported("R5", is_true("cac__thb"), ("cac",)),), (account_lookup(thb),)),)))
    tables = entities(spark, SF, ["DER_CAC", "DER_CACD", "DER_MGL"], account_queries.DERIVED)
    parents = facts.share(tables, sample_codes(), rule_sets, kept)
    assert [len(t.columns) for t in parents.places.values()] == [3]  # found if open, thb if open, thb
    for rules in rule_sets:
        assert rows(evaluate(tables, rules, PERIOD, sample_codes(), parents)) == rows(
            evaluate(tables, rules, PERIOD, sample_codes()))


@pytest.fixture
def whole_paths(spark):
    """Plans name the files they read in full."""
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    yield
    spark.conf.set("spark.sql.maxMetadataStringLength", before)


def test_each_parent_is_scanned_once(spark, tmp_path, whole_paths):
    codes, family = sample_codes(), list(shared_queries.FAMILY.values())
    derived = entities(spark, SF, sorted({e for r in family for e in r.reads}), account_queries.DERIVED)
    tables = {}
    for name, frame in derived.items():
        frame.write.parquet(f"{tmp_path}/entity_{name}")
        tables[name] = spark.read.parquet(f"{tmp_path}/entity_{name}")
    for rules in family:
        tables = with_views(tables, rules, codes)
    scans = Counter()

    def store(place, frame):
        path = f"{tmp_path}/facts_{'_'.join([place[0], *place[1]])}"
        scans.update((place, e) for e in re.findall(r"FileScan parquet.*?entity_(\w+)\]", plan_of(frame)))
        frame.write.parquet(path)
        return spark.read.parquet(path)

    parents = facts.share(tables, codes, family, store)
    accounts = {place: n for (place, e), n in scans.items() if e == "DER_CAC"}
    assert accounts == {("DER_CAC", ("ac_id",)): 1}
    assert set(scans.values()) == {1}
    for rules in family:
        read = set(re.findall(r"FileScan parquet.*?entity_(\w+)\]", plan_of(evaluate(tables, rules, PERIOD, codes, parents))))
        assert read <= {p.entity for p in rules.passes}


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_nothing_is_exchanged(spark, no_broadcast):
    found = shared_queries.rules_without_exchange(spark, SF)
    found.collect()
    plan = plan_of(found)
    assert plan.count("SortMergeJoin") >= 2 and "Exchange" not in plan
    own = evaluate(entities(spark, SF, account.MGL_MONTHLY.reads, account_queries.DERIVED), account.MGL_MONTHLY, PERIOD,
                   sample_codes())
    own.collect()
    assert "Exchange" in plan_of(own)
    assert Counter(map(tuple, found.collect())) == rows(own)


def test_a_family_shares_one_layout(spark, no_broadcast):
    """No exchange for any of the rule sets, and every parent's facts are laid out once."""
    found = shared_queries.rules_of_a_family_without_exchange(spark, SF)
    mine = Counter(map(tuple, found.collect()))
    assert "Exchange" not in plan_of(found)
    plain = Counter()
    for name, rules in shared_queries.LAID.items():
        tables = entities(spark, SF, rules.reads, account_queries.DERIVED)
        plain.update((name, *r) for r in rows(evaluate(tables, rules, PERIOD, sample_codes())).elements())
    assert mine == plain and {n for n, *_ in plain} == set(shared_queries.LAID)


def test_layouts_are_merged():
    a = layout.Layout("k", 8, (("x", 3), ("y", 2)), 1)
    b = layout.Layout("k", 8, (("x", 2), ("z", 4)), 5)
    assert layout.merged([a, b]) == layout.Layout("k", 8, (("x", 3), ("y", 2), ("z", 4)), 5)
    assert layout.merged([a]) == a
    with pytest.raises(ValueError):
        layout.merged([a, layout.Layout("k", 16)])


def test_rule_sets_that_look_up_by_several_columns(spark, tmp_path):
    """Only what is looked up by the layout's column is laid out; rule sets whose table lacks it stay as they are."""
    rule_sets = [account.CACD_MONTHLY, account.SHM_MONTHLY]
    tables = entities(spark, SF, sorted({e for r in rule_sets for e in r.reads}), account_queries.DERIVED)
    made = []

    def bucketed_(name, df, key, lay):
        made.append(name)
        return bucketed(spark, tmp_path, df, key, lay)

    laid, parents = facts.laid_out(tables, sample_codes(), rule_sets, "ac_id", 8, bucketed_, kept)
    assert sorted(made) == ["DER_CAC", "DER_CACD", "DER_SHM", "facts_DER_CAC_ac_id", "facts_DER_SHM_ac_id"]
    for rules in rule_sets:
        assert rows(evaluate(laid, rules, PERIOD, sample_codes(), parents)) == rows(
            evaluate(tables, rules, PERIOD, sample_codes()))
    none, plain = facts.laid_out(tables, sample_codes(), rule_sets, "no_such_column", 8, bucketed_, kept)
    assert not plain.layouts and none == dict(tables)


def skewed(spark, n=6000):
    """A third of the rows has one key, a quarter none."""
    return spark.range(0, n, 1, 4).select(
        F.when(F.col("id") % 12 < 4, "A0").when(F.col("id") % 12 < 7, None)
        .otherwise(F.concat(F.lit("A"), F.col("id") % 500)).alias("ac_id"), F.col("id").alias("row"))


def bucketed(spark, tmp_path, df, key, lay):
    return layout.write_buckets(df, f"laid_{uuid.uuid4().hex}", key, lay, f"{tmp_path}/{uuid.uuid4().hex}")


def test_hot_keys_are_spread_over_buckets(spark, tmp_path, no_broadcast):
    child = skewed(spark)
    lay = layout.layout_of(child, "ac_id", 16)
    assert dict(lay.hot).keys() == {"A0"} and dict(lay.hot)["A0"] >= 5 and lay.null_parts >= 4
    laid = bucketed(spark, tmp_path, layout.dealt(child, lay), "ac_id", lay)
    share = 6000 / 16
    most = layout.bucket_rows(laid, "ac_id", lay).agg(F.max("rows")).head()[0]
    plain = layout.bucket_rows(child.withColumn(layout.PART, F.lit(0)), "ac_id", lay).agg(F.max("rows")).head()[0]
    assert plain > 5 * share and most < 4 * share
    parent = spark.range(0, 400).select(F.concat(F.lit("A"), "id").alias("k"), (F.col("id") * 2).alias("v"))
    side = bucketed(spark, tmp_path, layout.replicated(parent, "k", lay), "k", lay)
    joined = laid.join(side, (laid["ac_id"] == side["k"]) & (laid[layout.PART] == side[layout.PART]), "left")
    found = Counter(map(tuple, joined.select("row", "v").collect()))
    assert "Exchange" not in plan_of(joined)
    assert found == Counter(map(tuple, child.join(parent, F.col("ac_id") == F.col("k"), "left").select("row", "v").collect()))


def test_hot_keys_are_never_more_than_buckets(spark):
    for n in (1, 7, 40):
        df = spark.range(0, 2000).select((F.col("id") % n).alias("k"))
        lay = layout.layout_of(df, "k", 16)
        assert len(lay.hot) <= 16 and sum(p for _, p in lay.hot) <= 32
    empty = layout.layout_of(spark.range(0).select(F.col("id").alias("k")), "k", 16)
    assert empty.hot == () and layout.dealt(spark.range(0).select(F.col("id").alias("k")), empty).collect() == []


def test_dealing_again_gives_the_same_parts(spark):
    lay = layout.layout_of(skewed(spark), "ac_id", 16)
    one, two = (layout.dealt(skewed(spark).repartition(n), lay) for n in (2, 9))
    assert Counter(map(tuple, one.collect())) == Counter(map(tuple, two.collect()))


def test_other_joins_of_laid_out_tables(spark, tmp_path):
    """Rules that look up by another column, or from a table that is not laid out, join as usual."""
    tables = entities(spark, SF, ["DER_CAC", "DER_CACD"], account_queries.DERIVED)
    lay = layout.layout_of(tables["DER_CACD"], "ac_id", 8)
    rules = RuleSet("DER_CACD", (Pass("DER_CACD", ("ac_id",), (
        f.references("R1", "cac"), f.references("R2", "line")), (
        account_lookup(), lookup("line", "DER_CAC", {"credit_line_id": "ac_id"}))),))

    def store(place, frame):
        return bucketed(spark, tmp_path, layout.replicated(frame, "ac_id", lay), "ac_id", lay)

    parents = facts.share(tables, sample_codes(), [rules], store)
    laid = facts.SharedParents(parents.tables, parents.codes, parents.places, parents.stored, dict.fromkeys(parents.places, lay))
    plain = rows(evaluate(tables, rules, PERIOD, sample_codes()))
    assert rows(evaluate(tables, rules, PERIOD, sample_codes(), laid)) == plain  # the base table has no parts
    tables = {**tables, "DER_CACD": bucketed(spark, tmp_path, layout.dealt(tables["DER_CACD"], lay), "ac_id", lay)}
    assert rows(evaluate(tables, rules, PERIOD, sample_codes(), laid)) == plain


# whole jobs

def test_jobs_of_a_period_share_parents(spark, tmp_path):
    """Every job's counts are those of its own run, with planted faults."""
    jobs = [JOBS[n] for n in ("monthly_mgl", "monthly_pjf", "monthly_shm", "monthly_dr", "monthly_cacd", "monthly_colp",
                              "monthly_rer", "p1_monthly_cacd")]
    names = sorted({e for job in jobs for e in job.rules.reads})
    worlds = {}
    for i, (_, by_entity) in enumerate(FAULTS["monthly_mgl"]):
        worlds[f"f{i}"] = {e or "DER_MGL": v for e, v in by_entity.items() if isinstance(v, dict)}
    given = frames(spark, names, worlds)
    setting = Setting(spark, str(tmp_path), "1", MOMENT, codes=sample_codes(), frames=given)
    shared = validate_all(setting, jobs, "20240331")
    plain = {job.name: validate(Setting(spark, str(tmp_path), "2", MOMENT, codes=sample_codes(), frames=given), job,
                                "20240331") for job in jobs}
    assert shared == plain and any(plain["monthly_mgl"].values())


def test_jobs_read_the_tables_of_their_own_line(spark, tmp_path):
    """A daily and a monthly job look up different account tables; their facts are kept apart."""
    database = f"facts_{uuid.uuid4().hex}"
    spark.sql(f"create database {database}")
    try:
        make = partial(Setting, spark, str(tmp_path), moment=MOMENT, database=database, codes=sample_codes())

        def source(entity, faults=None):
            return frames(spark, [entity], faults or {})[entity].drop("msr_prd_id", "ppn_tm")

        given = frames(spark, ["DER_CPEN", "DER_CPID"], {})
        run_job(make(run_id="1", frames=given), JOBS["daily_cac"], "20240331", source("DER_CAC"))
        run_job(make(run_id="2", frames=given), JOBS["monthly_cac"], "20240331",
                source("DER_CAC", {"x": {"DER_CAC": dict(ac_id="A#only")}}))
        run_job(make(run_id="3", frames=given), JOBS["daily_fxl"], "20240331", source("DER_FXL"))
        run_job(make(run_id="4", frames=given), JOBS["monthly_pjf"], "20240331", source("DER_PJF"))
        jobs = [JOBS["daily_fxl"], JOBS["monthly_pjf"]]
        setting = make(run_id="5", frames=given)
        shared = validate_all(setting, jobs, "20240331")
        assert shared == {j.name: validate(make(run_id="6", frames=given), j, "20240331") for j in jobs}
        assert sorted(p.name for p in (tmp_path / "facts").iterdir()) == [
            "DER_CPID-cntpr_id", f"{database}.der_cac-ac_id", f"{database}.der_cac_d-ac_id"]
    finally:
        spark.sql(f"drop database {database} cascade")
