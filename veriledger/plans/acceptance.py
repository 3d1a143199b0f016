"""Acceptance queries: the operators applied to the benchmark tables.

Roles: orders are credit accounts, lineitem account details, customer counterparties, nation
entities, part collateral, events the transaction flow; the order status stands for the source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriledger.functions import (
    amount,
    blank,
    next_period_daily,
    next_period_month_end,
    thai_id_check,
)
from veriledger.operators import conditions as c
from veriledger.operators import families as f
from veriledger.operators import keys, prevalidate, report, reshape
from veriledger.operators.conditions import Scope
from veriledger.operators.reconcile import Balance, Side, reconcile
from veriledger.operators.ruleset import Lookup, Pass, RuleSet, evaluate, flag_rows, latest
from veriledger.operators.skew import join_parent
from veriledger.sources import files
from veriledger.sources.shared import shared_folder

SOURCES = {"O": "CMS", "F": "TFS"}
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey"]
EXPORT_PERIOD = "20010630"
PRIORITY_UNSET = "4-NOT SPECIFIED"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _set_when(df: DataFrame, column: str, when, value) -> DataFrame:
    return df.withColumn(column, F.when(when, F.lit(value)).otherwise(F.col(column)))


def _broken(df: DataFrame, rule: f.Rule) -> DataFrame:
    return df.filter(rule.broken(Scope.of(df)))


def _orders_without_priority(spark, sf, text: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return _set_when(orders, "o_orderpriority", F.col("o_orderpriority") == PRIORITY_UNSET, text)


# -- reshaping ---------------------------------------------------------------------------------

def stage_union_by_source(spark, sf):
    staged = reshape.tag_source(table(spark, sf, "orders"), "o_orderstatus", SOURCES, "TRS")
    return staged.select("o_orderkey", "src_stm", "o_totalprice")


def counterparty_stack(spark, sf):
    customers = reshape.in_order(table(spark, sf, "customer"), {
        "cntpr_id": "c_custkey", "name": "c_name", "balance": "c_acctbal", "segment": "c_mktsegment"})
    suppliers = reshape.in_order(table(spark, sf, "supplier"), {
        "cntpr_id": "s_suppkey", "name": "s_name", "balance": "s_acctbal"})
    return reshape.stack_sources({"CMS": customers, "TFS": suppliers})


def clear_space_to_null(spark, sf):
    orders = _orders_without_priority(spark, sf, "  ")
    cleared = reshape.clear_spaces(orders, ["o_orderpriority"])
    return reshape.in_order(cleared, {"o_orderkey": "o_orderkey", "priority": "o_orderpriority"})


def constant_and_fill(spark, sf):
    customers = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("org_id"))
    staged = reshape.with_constants(customers, {"msr_prd_id": "20240131"})
    filled = reshape.fill_missing(staged, {"org_id": "006"})
    return reshape.in_order(filled, ["c_custkey", "msr_prd_id", "org_id"])


def projection_order(spark, sf):
    return reshape.in_order(table(spark, sf, "lineitem"), {
        "ac_id": "l_orderkey", "seq": "l_linenumber", "amt": "l_extendedprice"})


def amount_cast(spark, sf):
    text = table(spark, sf, "lineitem").withColumn("amt", F.col("l_extendedprice").cast("string"))
    return reshape.cast_columns(text.select(*LINE_KEY, "amt"), {"amt": "double"})


def entity_id_mapping(spark, sf):
    nations = table(spark, sf, "nation").filter("n_regionkey < 3")
    mapping = join_parent(table(spark, sf, "customer"), nations.select("n_nationkey").withColumn(
        "ent_id", F.col("n_nationkey")), [("c_nationkey", "n_nationkey")], "inner")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    mapped = reshape.set_from(orders, mapping, [("o_custkey", "c_custkey")], {"ent_id": "ent_id"},
                              default={"ent_id": -1})
    return mapped.select("o_orderkey", "ent_id")


# -- periods -----------------------------------------------------------------------------------

def period_advance_daily(spark, sf):
    day = F.col("o_orderdate").cast("date").alias("d")
    days = table(spark, sf, "orders").select(day).distinct()
    return days.select("d", next_period_daily(F.col("d")).alias("next_d"))


def period_advance_month_end(spark, sf):
    day = F.last_day(F.col("o_orderdate").cast("date")).alias("d")
    days = table(spark, sf, "orders").select(day).distinct()
    return days.select("d", next_period_month_end(F.col("d")).alias("next_d"))


# -- keys and controls -------------------------------------------------------------------------

def duplicate_skip(spark, sf):
    stored = table(spark, sf, "orders").filter("o_orderstatus = 'F'")
    lines = table(spark, sf, "lineitem").select(*LINE_KEY)
    return keys.skip_stored(lines, stored, [("l_orderkey", "o_orderkey")])


def duplicate_report(spark, sf):
    return keys.duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def record_count_control(spark, sf):
    from veriledger.sources.control import check_counts

    # the totals come from another table, disagree for some sources and lack one
    orders = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("src"))
    control = (table(spark, sf, "lineitem").filter("l_linenumber = 1")
               .groupBy(F.col("l_linestatus").alias("src")).agg(F.count("*").alias("expected")))
    return check_counts(orders, control, "src")


# -- pre-validation ----------------------------------------------------------------------------

def _customer_flags():
    return [
        f.Rule("r1", "V2", c.sql("c_acctbal < 0")),
        f.Rule("r2", "V15", c.equals("c_mktsegment", "MACHINERY")),
    ]


def prevalidation_flags(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    flagged = prevalidate.add_flags(customers, _customer_flags())
    return flagged.select("c_custkey", "r1", "r2")


def prevalidation_share(spark, sf):
    flagged = prevalidate.add_flags(table(spark, sf, "customer"), _customer_flags()[:1])
    shares = prevalidate.shares(flagged, ["r1"], by=["c_mktsegment"])
    return shares.select("c_mktsegment", "bad", "n", "share")


def prevalidation_failures(spark, sf):
    rules = _customer_flags()
    flagged = prevalidate.add_flags(table(spark, sf, "customer"), rules)
    return prevalidate.failures(flagged, [r.code for r in rules], ["c_custkey"]).select("rule", "key")


# -- rule families -----------------------------------------------------------------------------

def v1_required_if(spark, sf):
    orders = _orders_without_priority(spark, sf, "")
    rule = f.required_if("V1", c.equals("o_orderstatus", "F"), "o_orderpriority")
    return _broken(orders, rule).select("o_orderkey")


def v1_required_if_lookup(spark, sf):
    lines = _set_when(table(spark, sf, "lineitem"), "l_returnflag", F.col("l_returnflag") == "N", "")
    partial = table(spark, sf, "orders").filter("o_orderstatus = 'P'")
    unflagged = lines.filter(blank(F.col("l_returnflag"))).select(*LINE_KEY)
    return keys.with_parent(unflagged, partial, [("l_orderkey", "o_orderkey")])


def v2_non_negative(spark, sf):
    rule = f.within("V2", "c_acctbal", c.at_least("c_acctbal", 0))
    return _broken(table(spark, sf, "customer"), rule).select("c_custkey", "c_acctbal")


def v2_between(spark, sf):
    rule = f.within("V2", "l_quantity", c.between("l_quantity", 5, 45))
    return _broken(table(spark, sf, "lineitem"), rule).select(*LINE_KEY, "l_quantity")


def v3_date_order(spark, sf):
    lines = table(spark, sf, "lineitem").select(*LINE_KEY, "l_shipdate")
    account = Lookup("ac", "orders", (("l_orderkey", "o_orderkey"),), (latest("o_orderdate"),))
    rule = f.date_rule("V3", c.not_before("l_shipdate", "ac__o_orderdate"), needs=("ac",))
    tables = {"lineitem": lines, "orders": table(spark, sf, "orders")}
    late = flag_rows(tables, Pass("lineitem", tuple(LINE_KEY), (rule,), (account,)))
    return late.select(*LINE_KEY, "l_shipdate", F.col("ac__o_orderdate").alias("o_orderdate"))


def v4_iff_blank(spark, sf):
    rule = f.iff_filled("V4", c.equals("o_orderstatus", "F"), "o_orderpriority")
    return _broken(_orders_without_priority(spark, sf, ""), rule).select("o_orderkey")


def v5_either_present(spark, sf):
    lines = table(spark, sf, "lineitem")
    lines = _set_when(lines, "l_returnflag", F.col("l_returnflag") == "N", None)
    lines = _set_when(lines, "l_linestatus", F.col("l_linestatus") == "O", None)
    rule = f.either_filled("V5", "l_returnflag", "l_linestatus")
    return _broken(lines, rule).select(*LINE_KEY)


def v6_ref_integrity(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    parents = table(spark, sf, "customer").filter("c_mktsegment <> 'MACHINERY'")
    return keys.without_parent(orders, parents, [("o_custkey", "c_custkey")])


def v7_conditional_ref(spark, sf):
    purchases = table(spark, sf, "events").filter("event_type = 'purchase'")
    parents = table(spark, sf, "customer").filter("c_acctbal >= 0")
    return keys.without_parent(purchases.select("event_id", "user_id"), parents,
                               [("user_id", "c_custkey")])


def v8_either_parent(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id")
    building = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'")
    parents = building.select(F.col("c_custkey").alias("k")).unionByName(
        table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k")))
    return keys.without_parent(events, parents, [("user_id", "k")]).select("event_id")


def v9_must_be_reported(spark, sf):
    accounts = table(spark, sf, "orders").select("o_orderkey")
    return keys.without_parent(accounts, table(spark, sf, "lineitem"), [("o_orderkey", "l_orderkey")])


def v10_must_not_be_reported(spark, sf):
    lines = table(spark, sf, "lineitem").select(*LINE_KEY)
    forbidden = table(spark, sf, "orders").filter("o_orderstatus = 'P'")
    return keys.with_parent(lines, forbidden, [("l_orderkey", "o_orderkey")])


def v11_reconcile_ge(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.sum(amount(F.col("l_extendedprice"))).alias("s"))
    orders = table(spark, sf, "orders").select(
        "o_orderkey", amount(F.col("o_totalprice")).alias("t"))
    both = join_parent(orders, lines, [("o_orderkey", "l_orderkey")], "inner")
    return both.select("o_orderkey", "t", "s", (F.col("s") >= F.col("t")).alias("ok"))


def v11_reconcile_equal_quarter(spark, sf):
    quarter_end = c.sql("month(l_shipdate) in (3, 6, 9, 12)")
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice", "l_tax", "l_shipdate")
    totals = lines.filter(quarter_end(Scope.of(lines))).groupBy("l_returnflag").agg(
        F.sum(amount(F.col("l_extendedprice"))).alias("a"), F.sum(amount(F.col("l_tax"))).alias("b"))
    return totals.select("l_returnflag", (F.col("a") - F.col("b")).alias("net"),
                         (F.col("a") == F.col("b")).alias("ok"))


def v11_reconcile_sources(spark, sf):
    """Orders against their lines by source system, both sides summed first."""
    line_source = F.when(F.col("l_linestatus") == "O", "O").otherwise("F").alias("o_orderstatus")
    lines = table(spark, sf, "lineitem").select(line_source, "l_extendedprice", "l_quantity")
    balances = [
        Balance("CM1", Side("o_totalprice"), Side("l_extendedprice"), at_least=True),
        Balance("CM2", Side("o_totalprice", c.sql("o_totalprice > 100000")),
                Side("l_extendedprice", c.sql("l_quantity > 10"))),
    ]
    return reconcile(table(spark, sf, "orders"), lines, balances, ["o_orderstatus"])


def totals_by_day(spark, sf):
    """Filtered sums of two tables, joined on two keys that have other names on each side."""
    orders = table(spark, sf, "orders").groupBy(
        F.col("o_orderdate").alias("ds_dt"), F.col("o_orderstatus").alias("org")).agg(
        F.sum(amount(F.col("o_totalprice"))).alias("total"),
        F.sum(F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"),
                     amount(F.col("o_totalprice")))).alias("urgent"))
    lines = table(spark, sf, "lineitem").groupBy(
        F.col("l_shipdate").alias("data_dt"), F.col("l_linestatus").alias("org_id")).agg(
        F.sum(amount(F.col("l_extendedprice"))).alias("shipped"))
    both = join_parent(orders, lines, [("ds_dt", "data_dt"), ("org", "org_id")], "inner")
    return both.select(F.col("ds_dt").cast("date").alias("ds_dt"), "org",
                       (F.col("total") - F.col("shipped")).alias("difference"), "urgent")


def v12_check_digit(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", thai_id_check(F.lpad(F.col("c_custkey").cast("string"), 13, "1")).alias("ok"))


def v13_typed_value(spark, sf):
    text = F.when(F.col("event_id") % 5 == 0, "n/a").otherwise(F.col("value").cast("string"))
    events = table(spark, sf, "events").select("event_id", "event_type", text.alias("text"))
    rule = f.typed_value("V13", "text", c.one_of("event_type", "error", "view"), c.sql("false"))
    return _broken(events, rule).select("event_id")


def v14_sentinel_after_cutoff(spark, sf):
    rule = f.placeholder_ban("V14", c.sql("o_orderdate >= timestamp_ntz '2000-10-01'"),
                             c.equals("o_orderpriority", PRIORITY_UNSET))
    return _broken(table(spark, sf, "orders"), rule).select("o_orderkey")


def v15_code_list(spark, sf):
    rule = f.in_list("V15", c.always(), c.one_of("p_type", "PROMO", "SMALL", "LARGE"))
    return _broken(table(spark, sf, "part"), rule).select("p_partkey", "p_type")


def v15_list_from_table(spark, sf):
    """Values that a table lists: a large part must be of a brand and type that some small part is of."""
    parts = table(spark, sf, "part").selectExpr("p_partkey", "p_size", "p_brand || p_type as kind")
    listed = parts.filter("p_size < 10").select(F.col("kind").alias("value"))
    rule = f.in_list_table("LISTED", c.sql("p_size > 40"), "kinds")
    kinds = Lookup("kinds", "listed", (("kind", "value"),))
    return flag_rows({"parts": parts, "listed": listed}, Pass("parts", ("p_partkey",), (rule,), (kinds,))).select(
        "p_partkey", "kind")


def v16_hierarchy(spark, sf):
    # a tenth of the customers has a parent that does not exist, another no level
    lines = table(spark, sf, "customer").selectExpr(
        "c_custkey as id",
        "case when c_custkey < 10 then null when c_custkey % 10 = 3 then -c_custkey else c_custkey div 10 end as parent",
        "case when c_custkey < 5 then 0 when c_custkey % 10 = 7 then null else 1 end as lvl")
    rules = (
        f.hierarchy("LEVEL", c.equals("lvl", 0), when=c.blank("parent")),
        f.hierarchy("PARENT", f.found("up"), when=c.filled("parent"), needs=("up",)),
    )
    up = Lookup("up", "lines", (("parent", "id"),))
    return flag_rows({"lines": lines}, Pass("lines", ("id",), rules, (up,))).select("id")


def v17_self_reference(spark, sf):
    orders = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_custkey", "o_orderkey % 1000 as ac_id", "o_custkey % 1000 as prev_ac_id")
    return _broken(orders, f.must_differ("V17", "ac_id", "prev_ac_id")).select("o_orderkey", "o_custkey")


def v18_other_described(spark, sf):
    parts = _set_when(table(spark, sf, "part"), "p_name", F.col("p_size") < 10, "")
    return _broken(parts, f.described_if_other("V18", c.equals("p_type", "PROMO"), "p_name")).select("p_partkey")


# -- reporting ---------------------------------------------------------------------------------

def _summary_rules() -> RuleSet:
    overdrawn = f.within("CN1", "c_acctbal", c.at_least("c_acctbal", 0))
    return RuleSet("accounts", (
        Pass("customer", ("c_custkey",), (overdrawn,)),
        Pass("orders", ("o_orderkey",), (f.must_be_reported("RI1", c.always(), "detail"),),
             (Lookup("detail", "lineitem", (("o_orderkey", "l_orderkey"),)),)),
    ))


def violation_list(spark, sf):
    names = ["customer", "orders", "lineitem"]
    tables = {n: table(spark, sf, n) for n in names}
    return evaluate(tables, _summary_rules(), "20240131").select("entity", "msr_prd_id", "rule", "key")


def violation_summary(spark, sf):
    return report.summary(violation_list(spark, sf))


def gate(spark, sf):
    rules = RuleSet("accounts", (
        Pass("customer", ("c_custkey",),
             (f.within("CN1", "c_acctbal", c.at_least("c_acctbal", 0)),)),
        Pass("orders", ("o_orderkey",),
             (f.within("CN2", "o_totalprice", c.at_least("o_totalprice", 0)),)),
    ))
    tables = {n: table(spark, sf, n) for n in ["customer", "orders"]}
    return report.gate(evaluate(tables, rules, "20240131"))


def violation_by_source(spark, sf):
    orders = table(spark, sf, "orders").withColumn("src_stm", F.col("o_orderstatus"))
    rule = f.Rule("CM1", "V14", c.equals("o_orderpriority", PRIORITY_UNSET))
    rules = RuleSet("accounts", (Pass("orders", ("o_orderkey",), (rule,)),))
    return report.by_source(evaluate({"orders": orders}, rules, "20240131"))


def period_export(spark, sf):
    """The report of one period, by the code that exports a job's, read back."""
    orders = table(spark, sf, "orders").withColumn(
        "period", F.date_format(F.last_day("o_orderdate"), "yyyyMMdd")).filter(F.col("period") == EXPORT_PERIOD)
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    customers = customers.withColumn("counterparty_id", F.col("c_custkey"))
    rows = join_parent(orders, customers, [("o_custkey", "c_custkey")], "inner")
    rows = join_parent(rows, nations, [("c_nationkey", "n_nationkey")], "inner")
    path = files.export_report(rows, shared_folder(spark, "period"), EXPORT_PERIOD, {
        "account_id": "o_orderkey", "counterparty_id": "counterparty_id", "country": "n_name",
        "amount": "o_totalprice"})
    return spark.read.csv(path, header=True,
                          schema="account_id long, counterparty_id long, country string, amount double")


QUERIES = {q.__name__: q for q in [
    stage_union_by_source, counterparty_stack, clear_space_to_null, constant_and_fill,
    projection_order, amount_cast, entity_id_mapping, period_advance_daily,
    period_advance_month_end, duplicate_skip, duplicate_report, record_count_control,
    prevalidation_flags, prevalidation_share, prevalidation_failures, v1_required_if,
    v1_required_if_lookup, v2_non_negative, v2_between, v3_date_order, v4_iff_blank,
    v5_either_present, v6_ref_integrity, v7_conditional_ref, v8_either_parent,
    v9_must_be_reported, v10_must_not_be_reported, v11_reconcile_ge, v11_reconcile_equal_quarter,
    v11_reconcile_sources, totals_by_day, v12_check_digit, v13_typed_value, v14_sentinel_after_cutoff,
    v15_code_list, v15_list_from_table, v16_hierarchy, v17_self_reference, v18_other_described, violation_list,
    violation_summary, gate, violation_by_source, period_export,
]}
