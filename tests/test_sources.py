"""Landing, storage and files as round trips."""

import datetime
import json

import pytest
from pyspark.sql import types as T

from veriledger.functions.periods import advance, data_date, load_time
from veriledger.operators import keys, prevalidate, reshape
from veriledger.operators import conditions as c
from veriledger.operators import families as f
from veriledger.plans import landing
from veriledger.plans.jobs import LANDINGS
from veriledger.sources import control, files, jdbc, tables, text
from veriledger.sources.shared import shared_folder

MOMENT = datetime.datetime(2024, 1, 31, 18, 0, tzinfo=datetime.timezone.utc)
OTDD = T.StructType([
    T.StructField("org_id", T.StringType()),
    T.StructField("data_dt", T.DateType()),
    T.StructField("ac_id", T.StringType()),
    T.StructField("ccy", T.StringType()),
    T.StructField("otsnd_amt_in_orig_ccy", T.DecimalType(18, 2)),
])


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "OTDD_20240131.TXT").write_text(
        "006|2024-01-31|0001|USD|10.50\n|2024-01-31|0002|EUR|NULL\n")
    (tmp_path / "OTDD_20240131.TXT.2").write_text("007|2024-01-31|0003|  |bad\n")
    (tmp_path / "OTDD_20240130.TXT").write_text("008|2024-01-30|0009|USD|1\n")
    return str(tmp_path)


def test_pipe_text(spark, folder):
    landed = text.read_pipe_text(spark, text.landed_pattern(folder, "OTDD", "20240131"), OTDD)
    rows = {r["ac_id"]: r for r in landed.rows.collect()}
    assert set(rows) == {"0001", "0002"}
    assert rows["0001"]["org_id"] == "006" and str(rows["0001"]["otsnd_amt_in_orig_ccy"]) == "10.50"
    assert rows["0002"]["org_id"] is None and rows["0002"]["otsnd_amt_in_orig_ccy"] is None
    rejects = landed.rejects.collect()
    assert [(r["record"], r["reasons"]) for r in rejects] == [
        ("007|2024-01-31|0003|  |bad", "otsnd_amt_in_orig_ccy")]
    assert rejects[0]["file"].endswith("OTDD_20240131.TXT.2")
    everything = text.read_pipe_text(spark, text.landed_pattern(folder, "OTDD"), OTDD)
    assert everything.rows.count() == 3


def test_records_of_another_length_are_rejected_whole(spark, tmp_path):
    (tmp_path / "OTDD_20240131.TXT").write_text(
        "006|2024-01-31|0001|USD|1\n006|2024-01-31|0002|USD|1|EXTRA\n006|2024-01-31\n006|bad|0004|USD|x\n")
    landed = text.read_pipe_text(spark, text.landed_pattern(str(tmp_path), "OTDD", "20240131"), OTDD)
    assert [r["ac_id"] for r in landed.rows.collect()] == ["0001"]
    assert sorted((r["record"], r["reasons"]) for r in landed.rejects.collect()) == [
        ("006|2024-01-31", text.WRONG_NUMBER), ("006|2024-01-31|0002|USD|1|EXTRA", text.WRONG_NUMBER),
        ("006|bad|0004|USD|x", "data_dt, otsnd_amt_in_orig_ccy")]


def test_text_only_schema_has_no_rejects(spark, folder):
    only_text = T.StructType([T.StructField(x, T.StringType()) for x in "abcde"])
    landed = text.read_pipe_text(spark, text.landed_pattern(folder, "OTDD", "20240131"), only_text)
    assert landed.rows.count() == 3 and landed.rejects.count() == 0


def _land(spark, name, folder, file_name, period, expected=1):
    return landing.land_text(spark, LANDINGS[name], folder, file_name, period, MOMENT, expected)


def test_rejects_are_stored(spark, tmp_path):
    (tmp_path / "RV_20240430.TXT").write_text(
        "006|2024-04-30|R1|2024-04-30|1.5\n006|2024-04-30|R1|2024-04-30|x\n006\n")
    for _ in range(2):
        load = _land(spark, "land_intrv_tfs", str(tmp_path), "RV", "20240430", 3)
        assert (load.kept, load.rejected) == (1, 2)
    stored = spark.table("default.der_intrv_tfs_rejects").filter("msr_prd_id = '20240430'").collect()
    assert sorted((r["record"], r["reasons"]) for r in stored) == [
        ("006", text.WRONG_NUMBER), ("006|2024-04-30|R1|2024-04-30|x", "rate_value")]


def test_land_and_stack(spark, tmp_path):
    one = LANDINGS["land_intrv_tfs"]
    assert [x.name for x in landing.file_schema(one).fields] == [
        "org_id", "data_dt", "reference_rate_id", "value_date", "rate_value"]
    (tmp_path / "RV_20240131.TXT").write_text("006|2024-01-31|R1|2024-01-31|1.5\n")
    for _ in range(2):
        _land(spark, "land_intrv_tfs", str(tmp_path), "RV", "20240131", expected=1)
    _land(spark, "land_intrv_trs", str(tmp_path), "RV", "20240131")
    query = spark.sql("select '006' org_id, 'R2' reference_rate_id, 2.5 rate_value")
    landing.land_query(LANDINGS["land_intrv_cms"], query, "20240131", MOMENT)
    sources = [LANDINGS[f"land_intrv_{s}"] for s in ("cms", "tfs", "trs")]
    rows = landing.staged_rows(spark, sources, "20240131").collect()
    assert sorted((r["src_stm"], r["reference_rate_id"]) for r in rows) == [
        ("CMS", "R2"), ("TFS", "R1"), ("TRS", "R1")]
    assert rows[0]["ppn_tm"] == datetime.datetime(2024, 2, 1, 1, 0)
    assert landing.staged_rows(spark, sources, "20240130").count() == 0


def test_count_mismatch_stores_nothing(spark, tmp_path):
    (tmp_path / "RDA_20240131.TXT").write_text("006|2024-01-31|T1|D1\n")
    with pytest.raises(landing.CountMismatch):
        _land(spark, "land_rda_tfs", str(tmp_path), "RDA", "20240131", expected=2)
    assert not spark.catalog.tableExists("default.der_rda_tfs")


def test_placeholders(spark, tmp_path):
    (tmp_path / "BRD_20240131.TXT").write_text("006|2024-01-31|T1|2024-01-30\n")
    _land(spark, "land_brd_trs", str(tmp_path), "BRD", "20240131")
    row = spark.table("default.der_brd_trs").head()
    assert (row["bot_doc_tp"], row["bot_doc_no"], row["src_stm"]) == ("999999999", "999999999", "TRS")


SMALL = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.IntegerType()),
                      T.StructField("msr_prd_id", T.StringType())])


def _content(spark, table):
    return sorted(tuple(r) for r in spark.table(table).select("id", "v", "msr_prd_id").collect())


def test_replace_period(spark):
    tables.create_table(spark, "t_replace", SMALL)
    first = spark.createDataFrame([("a", 1, "20240101"), ("b", 2, "20240102")], SMALL)
    tables.write_period(first, "t_replace")
    tables.write_period(first, "t_replace")
    assert _content(spark, "t_replace") == [("a", 1, "20240101"), ("b", 2, "20240102")]
    second = spark.createDataFrame([("c", 3, "20240102")], SMALL)
    tables.write_period(second, "t_replace")
    assert _content(spark, "t_replace") == [("a", 1, "20240101"), ("c", 3, "20240102")]
    tables.replace_period(second.filter("false"), "t_replace", "20240101")
    assert _content(spark, "t_replace") == [("c", 3, "20240102")]
    assert tables.read_period(spark, "t_replace", "20240102").count() == 1
    assert tables.read_until(spark, "t_replace", "20240101").count() == 0
    with pytest.raises(ValueError):
        tables.replace_period(second, "t_replace", "2024' or 1=1")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_location_outlives_the_catalog(spark, tmp_path):
    place = str(tmp_path / "kept")
    tables.create_table(spark, "t_kept", SMALL, place)
    tables.write_period(spark.createDataFrame([("a", 1, "20240101")], SMALL), "t_kept")
    spark.sql("drop table t_kept")
    tables.create_table(spark, "t_kept", SMALL, place)
    assert _content(spark, "t_kept") == [("a", 1, "20240101")]


def test_parameters_and_nested_queries(spark):
    inner = spark.range(10).selectExpr("id", "cast(id as string) as k")
    got = tables.query(spark, "select k from {code} where id > :low and k <> :not_k",
                       {"low": 6, "not_k": "8' or '1'='1"}, {"code": inner})
    assert sorted(r["k"] for r in got.collect()) == ["7", "8", "9"]


def test_insert_select_and_schema(spark):
    tables.create_table(spark, "t_src", SMALL)
    tables.create_table(spark, "t_dst", SMALL)
    tables.write_period(spark.createDataFrame(
        [("a", 1, "20240101"), ("b", 2, "20240102")], SMALL), "t_src")
    for _ in range(2):
        tables.insert_select(spark, "t_dst", "select * from t_src where msr_prd_id = :p",
                             {"p": "20240102"})
    assert _content(spark, "t_dst") == [("b", 2, "20240102")]
    tables.append_rows(spark.table("t_src").filter("id = 'a'"), "t_dst")
    assert spark.table("t_dst").count() == 2
    assert text.table_schema(spark, "t_dst", ["msr_prd_id"]).names == ["id", "v"]


def test_chunks(spark, tmp_path):
    path = str(tmp_path / "chunks")
    files.write_chunks(spark.range(100).coalesce(1), path, rows_per_file=30)
    assert len(list((tmp_path / "chunks").glob("*.parquet"))) == 4
    assert files.read_chunks(spark, path + "/*.parquet").count() == 100


def test_report(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("b", 2)], "ac_id string, v int")
    path = files.export_report(df, str(tmp_path), "20240131", {"Account Id": "ac_id", "Value": "v"})
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["Account Id", "Value"]
    assert sorted(tuple(r) for r in back.collect()) == [("a", None), ("b", "2")]


def test_violation_files(spark, tmp_path):
    rows = [("e", "p", "R1", str(i), "CMS" if i % 2 else "TFS") for i in range(50)]
    rows += [("e", "p", "R2", "x", "CMS")]
    df = spark.createDataFrame(rows, "entity string, msr_prd_id string, rule string, key string, src_stm string")
    path = files.write_violations(df, str(tmp_path), "run1")
    back = spark.read.option("header", True).csv(path)
    assert {(r["rule"], r["src_stm"]): r["count"] for r in back.groupBy("rule", "src_stm").count().collect()} == {
        ("R1", "CMS"): 25, ("R1", "TFS"): 25, ("R2", "CMS"): 1}


def test_jdbc_options():
    plain = jdbc.options("select 1", {"url": "jdbc:x"})
    assert plain == {"url": "jdbc:x", "fetchsize": "10000", "query": "select 1"}
    split = jdbc.options("select 1", {"url": "jdbc:x"}, jdbc.Ranges("id", "0", "100", 8))
    assert split["dbtable"] == "(select 1) src" and split["numPartitions"] == "8"
    assert "query" not in split


def test_control_counts(spark):
    rows = spark.createDataFrame([("CMS",), ("CMS",), ("TFS",)], "src string")
    totals = spark.createDataFrame([("CMS", 2), ("TRS", 1)], "src string, expected long")
    got = {r["src"]: (r["n"], r["expected"], r["ok"]) for r in control.check_counts(rows, totals, "src").collect()}
    assert got == {"CMS": (2, 2, True), "TFS": (1, 0, False), "TRS": (0, 1, False)}


def test_skip_stored_casts_keys(spark):
    new = spark.createDataFrame([("1",), ("02",), (None,)], "id string")
    stored = spark.createDataFrame([(1,)], "id int")
    assert sorted(str(r["id"]) for r in keys.skip_stored(new, stored, ["id"]).collect()) == ["02", "None"]
    assert [r["id"] for r in keys.cast_keys(new, {"id": "int"}).filter("id = 2").collect()] == [2]


def test_set_from(spark):
    rows = spark.createDataFrame([("a", "old"), ("b", "old")], "ac_id string, ent_id string")
    mapping = spark.createDataFrame([("a", "e1"), ("a", "e2")], "ac string, e string")
    got = reshape.set_from(rows, mapping, [("ac_id", "ac")], {"ent_id": "e"})
    assert sorted(tuple(r) for r in got.collect()) == [("a", "e2"), ("b", "old")]


def test_prevalidation(spark):
    df = spark.createDataFrame([("1", -1, "CMS"), ("2", None, "TFS"), ("3", -2, "TFS")],
                               "id string, v int, src_stm string")
    rules = [f.within("R1", "v", c.at_least("v", 0)), f.required_if("R2", c.always(), "v")]
    flagged = prevalidate.add_flags(df, rules)
    assert prevalidate.base_columns(flagged, rules).columns == df.columns
    shares = {r["rule"]: (r["bad"], r["n"]) for r in prevalidate.shares(flagged, ["R1", "R2"]).collect()}
    assert shares == {"R1": (2, 3), "R2": (1, 3)}
    failed = prevalidate.failures(flagged, ["R1", "R2"], ["id"]).collect()
    assert sorted(tuple(r) for r in failed) == [("R1", "1", "CMS"), ("R1", "3", "TFS"), ("R2", "2", "TFS")]


def test_periods():
    assert advance("20231231", "daily") == "20240101"
    assert [advance(p, "monthly") for p in ("20240131", "20240229", "20231231", "20240630", "20240115")] == [
        "20240229", "20240331", "20240131", "20240731", "20240229"]
    assert data_date("20240215", "monthly") == datetime.date(2024, 2, 29)
    assert data_date("20240215", "daily") == datetime.date(2024, 2, 15)
    assert load_time(MOMENT) == "2024-02-01 01:00:00.000000"


def test_shared_folder(spark):
    from types import SimpleNamespace

    assert shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: d))
    with pytest.raises(ValueError):
        shared_folder(unset, "x")


def test_entities_round_trip(spark):
    from veriledger.specs.entities import ENTITIES, report_names

    assert len({json.dumps(sorted(e.schema.names)) for e in ENTITIES.values()}) > 50
    assert list(report_names(ENTITIES["DER_CC"]))[:3] == ["Organization Id", "Data Date", "Account Id"]


# records over several lines

def whole_file(data, separator="|"):
    """Records of a file read from its first line to its last."""
    from veriledger.sources.records import ends_inside

    lines = data.split("\n")
    lines = lines[:-1] if lines[-1] == "" else lines
    found, held, inside = [], [], False
    for line in lines:
        held.append(line)
        inside = ends_inside(line, inside, separator)
        if not inside:
            found.append(("\n".join(held), False))
            held = []
    return found + [(line, True) for line in held]


@pytest.fixture
def small_splits(spark):
    conf = {"spark.sql.files.maxPartitionBytes": "16", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_quotes_by_line():
    from veriledger.sources.records import ends_inside

    for line, outside, inside in [("a|b", False, True), ('a|"b', True, False), ('"a', True, False), ('a"b', False, False),
                                  ('a""b', False, True), ('"a""', True, False), ('"a"', False, True), ('"a"|"b', True, False),
                                  ('x"|"y', True, True), ('"|"z', False, True), ('""', False, True), ('|""|"', True, False), ('a"|"b""', True, True), ('a""|b', False, True)]:
        assert (ends_inside(line, False, "|"), ends_inside(line, True, "|")) == (outside, inside), line


def test_records_across_split_borders(spark, tmp_path, small_splits):
    """Random quotes, separators and line breaks in files of many splits, against a read of whole files."""
    import random
    from collections import Counter

    from veriledger.sources.records import _lines, read_records

    rng = random.Random(5)
    expected = Counter()
    for n in range(12):
        size = rng.choice([0, 1, 5, 40, 90])
        data = "\n".join("".join(rng.choices(['"', '""', "|", "a", "bc", "é", " ", '|"', '"|'], weights=[2, 1, 3, 6, 6, 2, 2, 2, 2],
                                             k=rng.randint(0, 9))) for _ in range(size))
        data += rng.choice(["", "\n"])
        (tmp_path / f"f{n}.TXT").write_text(data)
        expected.update((f"f{n}.TXT", *r) for r in whole_file(data))
    path = f"{tmp_path}/*.TXT"
    starts = _lines(spark, path).select("file", "start").distinct().count()
    assert starts > 40
    found = Counter((r["file"].rsplit("/", 1)[1], r["record"], r["endless"]) for r in read_records(spark, path).collect())
    assert found == expected
    assert any(e for _, _, e in expected) and any("\n" in r for _, r, _ in expected)


def test_a_record_over_many_splits(spark, tmp_path, small_splits):
    from veriledger.sources import text

    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("note", T.StringType()),
                           T.StructField("n", T.IntegerType())])
    long = "\n".join(f"line {i}" for i in range(200))
    (tmp_path / "x_20240131.TXT").write_text(f'1|"{long}"|5\n2|plain|6\n3|"a ""b""\n|c"|7\n4|x|bad\n')
    landed = text.read_pipe_text(spark, text.landed_pattern(str(tmp_path), "x", "20240131"), schema)
    assert sorted(map(tuple, landed.rows.collect())) == [("1", long, 5), ("2", "plain", 6), ("3", 'a "b"\n|c', 7)]
    assert [(r["record"], r["reasons"]) for r in landed.rejects.collect()] == [("4|x|bad", "n")]
