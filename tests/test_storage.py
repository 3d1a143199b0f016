"""Reports in order with a manifest, the index of stored keys, and tables published together."""

import csv
import json
import uuid
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriledger.sources import keyindex, ordered, publish, tables

KEYED = T.StructType([T.StructField("k", T.StringType()), T.StructField("j", T.IntegerType()),
                      T.StructField("v", T.IntegerType()), T.StructField("msr_prd_id", T.StringType())])
P1, P2, P3 = "20240131", "20240229", "20240331"


@pytest.fixture
def named(spark, tmp_path):
    """Makes empty period tables, which go with the test."""
    made = []

    def make(schema=KEYED):
        name = f"t_{uuid.uuid4().hex}"
        tables.create_table(spark, name, schema, f"{tmp_path}/{name}")
        made.append(name)
        return name

    yield make
    for name in made:
        spark.sql(f"drop table {name}")
        spark.sql(f"drop table if exists {keyindex.index_table(name)}")


# reports

def files_of(path):
    return {int(p.name.split("=")[1]): list(p.glob("*.csv")) for p in Path(path).glob("part=*")}


def lines_of(path):
    parts = files_of(path)
    assert all(len(own) == 1 for own in parts.values())
    rows = {}
    for part, (file,) in parts.items():
        with file.open(newline="") as f:
            header, *rows[part] = list(csv.reader(f))
            assert header == ["Key", "Text"]
    return rows


def test_parts_are_numbered_ordered_and_equal(spark, tmp_path):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 37 % 1000).alias("k"), F.concat(F.lit("a,|\"b "), "id").alias("t"))
    path = ordered.export_ordered(df, str(tmp_path), P1, {"Key": "k", "Text": "t"}, ["k"], 300)
    rows = lines_of(path)
    assert {p: len(r) for p, r in rows.items()} == {0: 300, 1: 300, 2: 300, 3: 100}
    assert [int(r[0]) for p in sorted(rows) for r in rows[p]] == list(range(1000))
    manifest = {r["part"]: (r["rows"], r["first_place"]) for r in ordered.read_manifest(spark, path).collect()}
    assert manifest == {0: (300, 0), 1: (300, 300), 2: (300, 600), 3: (100, 900)}
    back = ordered.read_report(spark, path, ["Key", "Text"])
    assert Counter(map(tuple, back.select("Key", "Text").collect())) == Counter(
        (str(r["k"]), r["t"]) for r in df.collect())


def test_hot_and_missing_keys(spark, tmp_path):
    """Rows of one key go over several parts; NULL comes first; equal keys follow each other by the other columns."""
    df = spark.range(0, 900, 1, 5).select(
        F.when(F.col("id") % 9 == 0, None).when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"),
        F.lpad(F.col("id").cast("string"), 4, "0").alias("t"))
    path = ordered.export_ordered(df, str(tmp_path), P1, {"Key": "k", "Text": "t"}, ["k"], 128)
    rows = lines_of(path)
    whole = [(r[0], r[1]) for p in sorted(rows) for r in rows[p]]
    assert whole == [("" if k is None else str(k), t) for k, t in sorted(
        map(tuple, df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))]
    assert ordered.read_report(spark, path, ["Key", "Text"]).count() == 900


def test_changed_and_missing_parts_are_found(spark, tmp_path):
    df = spark.range(0, 100).select(F.col("id").alias("k"), F.lit("x").alias("t"))
    names = {"Key": "k", "Text": "t"}

    def exported():
        return ordered.export_ordered(df, f"{tmp_path}/{uuid.uuid4().hex}", P1, names, ["k"], 40)

    path = exported()
    (file,) = files_of(path)[1]
    file.write_text(file.read_text().replace("41,x", "41,y"))
    (file.parent / f".{file.name}.crc").unlink()
    with pytest.raises(ordered.ReportIncomplete, match=r"\[1\]"):
        ordered.read_report(spark, path, list(names))
    path = exported()
    (file,) = files_of(path)[2]
    file.rename(tmp_path / "aside.csv")
    with pytest.raises(ordered.ReportIncomplete, match=r"\[2\]"):
        ordered.read_report(spark, path, list(names))
    path = exported()
    (file,) = files_of(path)[0]
    surplus = Path(path) / "part=9"
    surplus.mkdir()
    (surplus / "more.csv").write_text(file.read_text())
    with pytest.raises(ordered.ReportIncomplete, match=r"\[9\]"):
        ordered.read_report(spark, path, list(names))


def test_report_without_rows(spark, tmp_path):
    df = spark.range(0).select(F.col("id").alias("k"), F.lit("x").alias("t"))
    path = ordered.export_ordered(df, str(tmp_path), P1, {"Key": "k", "Text": "t"}, ["k"])
    assert lines_of(path) == {0: []}
    assert ordered.read_report(spark, path, ["Key", "Text"]).count() == 0


# the index of stored keys

def keyed(spark, start, end, period, v=0):
    return spark.range(start, end).select(
        F.concat(F.lit("K"), F.col("id")).alias("k"), (F.col("id") % 3).cast("int").alias("j"),
        F.lit(v).alias("v"), F.lit(period).alias("msr_prd_id"))


def stored(spark, name):
    return Counter((r["k"], r["v"], r["msr_prd_id"]) for r in spark.table(name).collect())


def plain_append(spark, name, new, period):
    """What a load leaves, by an anti join with all other periods."""
    others = spark.table(name).filter(F.col("msr_prd_id") != period)
    kept = new.join(others.select("k", "j").distinct(), ["k", "j"], "left_anti").select("k", "v", F.lit(period))
    rest = others.select("k", "v", "msr_prd_id")
    return Counter(map(tuple, rest.union(kept).collect()))


@pytest.mark.parametrize("bits", [32, 1])
def test_no_key_is_lost_or_stored_twice(spark, named, monkeypatch, bits):
    """Also with filters that say yes to almost anything."""
    monkeypatch.setattr(keyindex, "BITS_PER_KEY", bits)
    if bits == 1:
        monkeypatch.setattr(keyindex, "BLOCK_BITS", 64)
    name = named()
    for period, start in ((P1, 0), (P2, 3000)):
        keyindex.append_new(keyed(spark, start, start + 3000, period), name, ["k", "j"], period)
    # known, unknown, repeated and half-known keys, and keys with a NULL
    new = (keyed(spark, 2500, 3500, P3, 1).union(keyed(spark, 9000, 9400, P3, 2)).union(keyed(spark, 9000, 9001, P3, 2))
           .union(keyed(spark, 10, 20, P3, 3).withColumn("j", F.lit(7)))
           .union(keyed(spark, 30, 32, P3, 4).withColumn("j", F.lit(None).cast("int"))))
    expected = plain_append(spark, name, new, P3)
    keyindex.append_new(new, name, ["k", "j"], P3)
    assert stored(spark, name) == expected
    keyindex.append_new(new, name, ["k", "j"], P3)  # the period itself is replaced
    assert stored(spark, name) == expected


def test_fewer_periods_are_read(spark, named):
    name = named()
    for i, period in enumerate((P1, P2, P3)):
        keyindex.append_new(keyed(spark, 5000 * i, 5000 * (i + 1), period), name, ["k"], period)
    assert keyindex.periods_to_read(keyed(spark, 6000, 6100, ""), name, ["k"]) == [P2]
    assert keyindex.periods_to_read(keyed(spark, 90_000, 90_500, ""), name, ["k"]) == []
    assert keyindex.periods_to_read(keyed(spark, 4990, 5010, ""), name, ["k"]) == [P1, P2]
    left = keyindex.skip_stored_keys(keyed(spark, 6000, 6100, "").union(keyed(spark, 90_000, 90_005, "")), name, ["k"])
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert P2 in plan and P1 not in plan and P3 not in plan
    assert left.count() == 5
    files = left.join(spark.table(name).limit(0), "k", "left_anti").inputFiles()
    assert {f.rsplit("msr_prd_id=", 1)[1][:8] for f in files if "msr_prd_id=" in f} <= {P2}


def test_periods_without_a_filter_are_read(spark, named):
    name = named()
    tables.replace_period(keyed(spark, 0, 50, P1), name, P1)
    assert keyindex.periods_to_read(keyed(spark, 900, 910, ""), name, ["k"]) == [P1]
    keyindex.append_new(keyed(spark, 40, 60, P2), name, ["k"], P2)
    assert spark.table(name).filter(F.col("msr_prd_id") == P2).count() == 10
    assert keyindex.periods_to_read(keyed(spark, 900, 910, ""), name, ["k"]) == [P1]  # the second has one now
    keyindex.replace_index(spark, name, P1, ["k"])
    assert keyindex.periods_to_read(keyed(spark, 900, 910, ""), name, ["k"]) == []


def test_wrong_answers_are_rare(spark):
    held = spark.range(0, 60_000).select(F.sha1(F.col("id").cast("string")).alias("k"))
    others = spark.range(60_000, 260_000).select(F.sha1(F.col("id").cast("string")).alias("k"))
    index = keyindex.built(held, ["k"]).withColumn("msr_prd_id", F.lit(P1)).cache()
    assert keyindex.may_hold(held, index, ["k"]).count() == 60_000
    assert keyindex.may_hold(others, index, ["k"]).count() <= 4
    assert keyindex.built(held.limit(0), ["k"]).collect() == []
    index.unpersist()


def test_keys_of_other_types_are_refused(spark, named):
    name = named()
    tables.replace_period(keyed(spark, 0, 5, P1), name, P1)
    with pytest.raises(ValueError, match="other types"):
        keyindex.skip_stored_keys(spark.range(3).select(F.col("id").alias("k")), name, ["k"])


# publication

def values(spark, *names):
    return [sorted({(r["v"], r["msr_prd_id"]) for r in spark.table(n).collect()}) for n in names]


def staged(spark, folder, a, b, v, period=P1):
    release = publish.Release(spark, folder)
    rows = release.stage(a, period, keyed(spark, 0, 20, period, v))
    release.stage(b, period, rows.filter("j = 0"))
    return release


def test_readers_see_all_or_nothing(spark, named, tmp_path):
    a, b = named(), named()
    first = staged(spark, f"{tmp_path}/r", a, b, 1)
    assert values(spark, a, b) == [[], []]
    first.publish()
    assert values(spark, a, b) == [[(1, P1)], [(1, P1)]] and spark.table(b).count() == 7
    second, other = staged(spark, f"{tmp_path}/r", a, b, 2), staged(spark, f"{tmp_path}/r", a, b, 5, P2)
    assert values(spark, a, b) == [[(1, P1)], [(1, P1)]]
    second.publish()
    other.publish()
    assert values(spark, a, b) == [[(2, P1), (5, P2)]] * 2
    second.remove_before()
    assert values(spark, a, b) == [[(2, P1), (5, P2)]] * 2
    # a plain load goes to where the period lies now
    tables.replace_period(keyed(spark, 0, 3, P1, 9), a, P1)
    assert values(spark, a) == [[(9, P1), (5, P2)][::-1]]


def test_a_move_that_fails_is_taken_back(spark, named, tmp_path, monkeypatch):
    a, b = named(), named()
    staged(spark, f"{tmp_path}/r", a, b, 1).publish()
    release = staged(spark, f"{tmp_path}/r", a, b, 2)
    plain = publish._move

    def fails(spark_, table, period, folder):
        if table == b and f"/{release.name}/" in (folder or ""):
            raise RuntimeError("catalog is gone")
        plain(spark_, table, period, folder)

    monkeypatch.setattr(publish, "_move", fails)
    with pytest.raises(RuntimeError):
        release.publish()
    assert values(spark, a, b) == [[(1, P1)], [(1, P1)]]
    monkeypatch.undo()
    # the list is stored, so anyone can finish the release
    publish.unfinished(spark, release.folder, release.name).publish()
    assert values(spark, a, b) == [[(2, P1)], [(2, P1)]]


def test_first_periods_are_taken_back_too(spark, named, tmp_path, monkeypatch):
    a, b = named(), named()
    release = staged(spark, f"{tmp_path}/r", a, b, 2)
    plain = publish._move
    monkeypatch.setattr(publish, "_move", lambda s, t, p, f: plain(s, t, p, f) if t == a else 1 / 0)
    with pytest.raises(ZeroDivisionError):
        release.publish()
    monkeypatch.undo()
    assert values(spark, a, b) == [[], []]
    assert publish.location(spark, a, P1) is None


def test_a_dropped_release_leaves_nothing(spark, named, tmp_path):
    a, b = named(), named()
    release = staged(spark, f"{tmp_path}/r", a, b, 2)
    release.drop()
    assert values(spark, a, b) == [[], []] and not (tmp_path / "r" / release.name).exists()
    with pytest.raises(ValueError, match="not a period"):
        release.stage(a, "2024", keyed(spark, 0, 1, P1))


def test_moves_are_listed_as_they_are(spark, named, tmp_path):
    a, b = named(), named()
    release = staged(spark, f"{tmp_path}/r", a, b, 1)
    release.publish()
    lines = [json.loads(r["value"]) for r in spark.read.text(f"{release.folder}/{release.name}/_moves").collect()]
    assert [m["table"] for m in lines] == [a, b] and all(m["before"] is None for m in lines)
