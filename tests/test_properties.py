"""Clean rows plus n planted faults give exactly n violations, whatever the size and the path."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veriledger.functions import blank, clear_space, null_words_to_null, thai_id_check
from veriledger.operators import conditions as c
from veriledger.operators import families as f
from veriledger.operators import report
from veriledger.operators.ruleset import Lookup, Pass, RuleSet, any_row, evaluate

RULES = RuleSet("child", (Pass("child", ("id",), (
    f.required_if("V1", c.equals("kind", "a"), "text"),
    f.within("V2", "n", c.at_least("n", 0)),
    f.references("V6", "p"),
    f.must_not_be_reported("V10", c.sql("q__closed"), ("q",)),
), (
    Lookup("p", "parent", (("pid", "id"),)),
    Lookup("q", "parent", (("qid", "id"),), (any_row("closed", c.equals("status", "closed")),)),
)),))


def child(spark, n_clean, faults, hot):
    """Clean rows, then per rule a number of rows that break just it; many rows share one parent."""
    rows = []

    def add(kind="a", text="x", n=0, pid="P0", qid="P0"):
        rows.append((str(len(rows)), kind, text, n, pid, qid))

    for i in range(n_clean):
        parent = "P0" if hot else f"P{i % 50}"
        add(pid=parent, qid=None if i % 3 else parent)
    for _ in range(faults[0]):
        add(text="   ")
    for _ in range(faults[1]):
        add(n=-1)
    for i in range(faults[2]):
        add(pid=None if i % 2 else "none")
    for _ in range(faults[3]):
        add(qid="CLOSED")
    add(kind="b", text=None, n=None)
    return spark.createDataFrame(rows, "id string, kind string, text string, n int, pid string, qid string")


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(n_clean=st.integers(0, 400), hot=st.booleans(),
       faults=st.tuples(*[st.integers(0, 40)] * 4))
def test_planted_faults_come_out(spark, n_clean, hot, faults):
    parents = [(f"P{i}", "open") for i in range(50)] + [("P0", "open"), ("CLOSED", "closed")]
    tables = {
        "child": child(spark, n_clean, faults, hot),
        "parent": spark.createDataFrame(parents, "id string, status string"),
    }
    found = evaluate(tables, RULES, "20240131")
    counts = report.rule_counts(found, RULES.codes).head()
    assert tuple(counts[r] for r in ("V1", "V2", "V6", "V10")) == faults
    gate = report.gate(found).head()
    assert (gate["passed"], gate["violations"]) == (sum(faults) == 0, sum(faults))


def test_check_digit_against_brute_force(spark):
    def holds(text):
        if text is None:
            return None
        if len(text) != 13 or not (text.isascii() and text.isdigit()):
            return False
        total = sum(int(d) * (13 - i) for i, d in enumerate(text[:12]))
        return (11 - total % 11) % 10 == int(text[12])

    texts = [str(1_000_000_000_000 + i * 7_919_317) for i in range(500)]
    texts += ["1101700230708", "", " " * 13, "12345", "11017002307081", "1101700230 08", "+101700230708",
              "１１０１７００２３０７０８", None]
    rows = spark.createDataFrame([(t,) for t in texts], "id string")
    mine = {r["id"]: r["ok"] for r in rows.select("id", thai_id_check(F.col("id")).alias("ok")).collect()}
    assert mine == {t: holds(t) for t in texts}
    assert mine["1101700230708"] is True


@pytest.mark.parametrize("text,is_blank,cleared,landed", [
    (None, True, None, None),
    ("", True, None, None),
    ("  ", True, None, "  "),
    (" a ", False, "a", " a "),
    ("NULL", False, "NULL", None),
    ("006", False, "006", "006"),
])
def test_blanks(spark, text, is_blank, cleared, landed):
    row = spark.createDataFrame([(text,)], "t string").select(
        blank(F.col("t")).alias("b"), clear_space(F.col("t")).alias("c"),
        null_words_to_null(F.col("t")).alias("n")).head()
    assert (row["b"], row["c"], row["n"]) == (is_blank, cleared, landed)


@pytest.mark.parametrize("when,then,broken", [
    (True, True, False), (True, False, True), (True, None, True),
    (False, False, False), (None, False, False), (None, None, False),
])
def test_unknown_conditions_do_not_fire_and_missing_values_do(spark, when, then, broken):
    rule = f.implies("R", "V1", c.sql("w"), c.sql("t"))
    row = spark.createDataFrame([(when, then)], "w boolean, t boolean")
    assert row.select(rule.broken(c.Scope.of(row)).alias("b")).head()["b"] is broken


def test_unbound_code_list_is_named(spark):
    with pytest.raises(KeyError, match="fixed_term"):
        c.in_codes("x", "fixed_term")(c.Scope({}, {"loans": ["1"]}))


def test_rule_without_its_lookup_is_refused(spark):
    one = Pass("t", ("id",), (f.references("R", "gone"),))
    with pytest.raises(ValueError, match="R"):
        evaluate({"t": spark.range(1)}, RuleSet("t", (one,)), "20240131")


def test_rules_settle_before_the_join_what_rows_say():
    """After the join, the rules of account details read no column of the row but what is compared with the account's."""
    import re
    from dataclasses import replace

    from veriledger.operators import ruleset
    from veriledger.operators.conditions import Scope
    from veriledger.specs import account
    from veriledger.specs.codes import sample_codes

    for rules in (account.CACD_MONTHLY, account.CACD_P1):
        parts = ruleset.independent(rules.passes[0])
        assert [[l.name for l in p.lookups] for p in parts] == [["cac"], ["cl"], ["prt"], ["ppg"]]
        assert sorted(r.code for p in parts for r in p.rules) == sorted(rules.codes)
        scope = Scope({}, sample_codes())
        columns, known = ruleset._settled(parts[0], scope)
        after = " ".join(str(r.broken(replace(scope, known=known))) for r in parts[0].rules if r.needs)
        named = set(re.findall(r"\b(?:[a-z]+_[a-z_]+|factor)\b", after)) - {"is_null", "when_then"}
        own = {"notional_oc", "revolving_flag", "digital_loan_flag", "country_to_invest", "frst_pymt_amt_in_orig_ccy", "account_purpose"}
        assert "open_date" in named and not named & own
        assert all(any(c in str(column) for column in columns.values()) for c in own)


def test_lookups_stay_together_where_a_rule_needs_both():
    from veriledger.operators import conditions as c
    from veriledger.operators import families as f
    from veriledger.operators.ruleset import Lookup, Pass, independent, latest

    def names(*rules):
        one = Pass("t", ("id",), (f.must_differ("OWN", "a", "b"), *rules), (
            Lookup("x", "X", (("a", "k"),), (latest("d"),)), Lookup("y", "Y", (("b", "k"),)),
            Lookup("z", "Z", (("x__d", "k"),)), Lookup("w", "W", (("c", "k"),))))
        return [([l.name for l in p.lookups], [r.code for r in p.rules]) for p in independent(one)]

    each = [f.references(n.upper(), n) for n in "xyzw"]
    assert names(*each) == [(["x", "z"], ["OWN", "X", "Z"]), (["y"], ["Y"]), (["w"], ["W"])]
    both = f.references_any("YW", "y", "w")
    assert names(*each, both) == [(["x", "z"], ["OWN", "X", "Z"]), (["y", "w"], ["Y", "W", "YW"])]
    assert names() == [(["x", "z"], ["OWN"])]


def test_settled_conditions_keep_what_is_unknown(spark):
    """True, false and unknown travel through the join, alone and negated, for more conditions than a number holds."""
    from veriledger.operators import conditions as c
    from veriledger.operators import families as f
    from veriledger.operators.ruleset import Lookup, Pass, RuleSet, evaluate

    found = c.sql("p__found is not null")
    rules = []
    for i in range(40):
        big = c.sql(f"v > {i}")
        rules += [f.Rule(f"A{i}", "V1", big & found, ("p",)), f.Rule(f"B{i}", "V1", ~big & found, ("p",)),
                  f.implies(f"C{i}", "V1", found, big, ("p",))]
    tables = {"t": spark.sql("select id, id as k, case when id % 3 > 0 then int(id) end v from range(60)"),
              "P": spark.range(0, 60, 2).toDF("k")}
    one = Pass("t", ("id",), tuple(rules), (Lookup("p", "P", (("k", "k"),)),))
    mine = {(r["rule"], int(r["key"])) for r in evaluate(tables, RuleSet("t", (one,)), "20240101").collect()}
    expected = set()
    for k in range(0, 60, 2):
        v = k if k % 3 else None
        for i in range(40):
            expected |= {(n, k) for n, broken in ((f"A{i}", v is not None and v > i), (f"B{i}", v is not None and v <= i),
                                                  (f"C{i}", v is None or v <= i)) if broken}
    assert mine == expected
