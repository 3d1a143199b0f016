"""Sources and sinks as queries: rows of the benchmark tables are written, replaced and read back.

Everything is written under the shared folder the session names, in a fresh folder per call.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriledger.functions import period_date
from veriledger.operators import keys, report, reshape
from veriledger.plans.acceptance import table, violation_list
from veriledger.sources import files, tables, text
from veriledger.sources.shared import shared_folder

PERIOD = "20240131"

ACCOUNT = T.StructType([
    T.StructField("ac_id", T.StringType()),
    T.StructField("data_dt", T.DateType()),
    T.StructField("amt", T.DecimalType(18, 2)),
    T.StructField("priority", T.StringType()),
])
STORED = T.StructType([
    T.StructField("ac_id", T.LongType()),
    T.StructField("amt", T.DecimalType(18, 2)),
    T.StructField("msr_prd_id", T.StringType()),
])


def _landed(spark, sf) -> text.Landed:
    """Orders as headerless pipe text of two files; some records have a cell too many or too few, or an
    amount that is none."""
    folder = shared_folder(spark, "landing")
    # one file name with two parts, as a source delivers large files
    parts = {f"{folder}/orders_{PERIOD}.TXT": "o_orderstatus = 'F'",
             f"{folder}/orders_{PERIOD}.TXT2": "o_orderstatus <> 'F'"}
    key = F.col("o_orderkey")
    priority = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", " ").otherwise(F.col("o_orderpriority"))
    amount = F.when(key % 50 == 2, "bad").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    start = F.concat_ws(text.SEPARATOR, F.lpad(key.cast("string"), 12, "0"),
                        F.col("o_orderdate").cast("date").cast("string"), amount)
    line = (F.when(key % 50 == 0, F.concat_ws(text.SEPARATOR, start, priority, F.lit("EXTRA")))
            .when(key % 50 == 1, start).otherwise(F.concat_ws(text.SEPARATOR, start, priority)))
    orders = table(spark, sf, "orders")
    for path, test in parts.items():
        orders.filter(test).select(line).write.text(path)
    return text.read_pipe_text(spark, text.landed_pattern(folder, "orders", PERIOD), ACCOUNT)


def land_pipe_text(spark, sf):
    """Headerless pipe text by name and period, typed by a schema, then spaces cleared: the records taken."""
    return reshape.clear_spaces(_landed(spark, sf).rows, ["priority"])


def land_pipe_text_rejects(spark, sf):
    """The records that were not taken, whole, with the reasons and the file."""
    rejects = _landed(spark, sf).rejects
    return rejects.select("record", "reasons", F.regexp_extract("file", "orders_[0-9]+[.](TXT2?)", 1).alias("part"))


def _quoted(spark, sf) -> text.Landed:
    """Orders whose note has separators, doubled quotes and line breaks, some of them many; one file ends in a
    quoted cell that is never closed. Files are written whole, so records and lines are where they were put."""
    folder = shared_folder(spark, "quoted")
    key = F.col("o_orderkey")
    note = (F.when(key % 7 == 0, F.lit("a|b\nc"))
            .when(key % 7 == 1, F.concat(F.lit('say "" twice\n'), F.repeat(F.lit("line\n"), (key % 11).cast("int")), F.lit("end")))
            .when(key % 7 == 2, F.lit("\n\n")))
    cells = F.when(note.isNull(), F.col("o_orderpriority")).otherwise(F.concat(F.lit('"'), note, F.lit('"')))
    line = F.concat_ws(text.SEPARATOR, key.cast("string"), cells, F.when(key % 50 == 3, "bad").otherwise(
        F.col("o_totalprice").cast("decimal(18,2)").cast("string")))
    orders = table(spark, sf, "orders")
    for status in ("F", "O", "P"):
        own = orders.filter(F.col("o_orderstatus") == status).select(line)
        if status == "P":
            own = own.union(spark.sql("""select '900|"open|1' union all select '901|x|2'""")).coalesce(1)
        own.write.text(f"{folder}/notes_{status}.TXT")
    schema = T.StructType([T.StructField("ac_id", T.LongType()), T.StructField("note", T.StringType()),
                           T.StructField("amt", T.DecimalType(18, 2))])
    return text.read_pipe_text(spark, f"{folder}/notes_*.TXT", schema)


def land_quoted_text(spark, sf):
    """Records whose quoted cells hold line breaks, read in splits."""
    return _quoted(spark, sf).rows


def land_quoted_text_rejects(spark, sf):
    """The records of the same files that cannot be taken, and the lines after a quote that is never closed."""
    return _quoted(spark, sf).rejects.select("record", "reasons")


def land_loose_pattern(spark, sf):
    """A fixed column list and files named loosely, without a period."""
    folder = shared_folder(spark, "landing")
    rows = table(spark, sf, "orders")
    columns = ["o_orderkey", "o_orderstatus"]
    for name, test in {"OT_a.TXT1": "o_orderstatus = 'F'", "OT_b.TXT": "o_orderstatus <> 'F'"}.items():
        rows.filter(test).select(F.concat_ws(text.SEPARATOR, *columns)).write.text(f"{folder}/{name}")
    schema = T.StructType([T.StructField("ac_id", T.LongType()), T.StructField("status", T.StringType())])
    return text.read_pipe_text(spark, text.landed_pattern(folder, "OT"), schema).rows


def _accounts(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("ac_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amt"),
        F.date_format("o_orderdate", "yyyy1231").alias("msr_prd_id"),
        "o_orderstatus",
    )


class _Stored:
    """A period table in a fresh folder; its catalog entry goes when the block ends."""

    def __init__(self, spark):
        self.spark = spark
        self.name = f"accounts_{uuid.uuid4().hex}"
        self.folder = shared_folder(spark, "table")

    def __enter__(self) -> str:
        tables.create_table(self.spark, self.name, STORED, self.folder)
        return self.name

    def __exit__(self, *_):
        self.spark.sql(f"drop table {self.name}")

    def rows(self) -> DataFrame:
        return self.spark.read.schema(STORED).parquet(self.folder)


def replace_periods(spark, sf):
    """All periods stored twice, then one replaced by fewer rows: the others stay."""
    accounts = _accounts(spark, sf)
    stored = _Stored(spark)
    with stored as name:
        tables.write_period(accounts, name)
        tables.write_period(accounts, name)
        kept = accounts.filter("msr_prd_id = '19981231' and o_orderstatus = 'F'")
        tables.replace_period(kept, name, "19981231")
    return stored.rows()


def one_period(spark, sf):
    """A period read back: the filter prunes to its partition."""
    stored = _Stored(spark)
    with stored as name:
        tables.write_period(_accounts(spark, sf), name)
    return stored.rows().filter(F.col("msr_prd_id") == "19991231")


def append_new_keys(spark, sf):
    """Stored accounts of one source, then only the accounts not stored yet are added."""
    accounts = _accounts(spark, sf)
    stored = _Stored(spark)
    with stored as name:
        tables.write_period(accounts.filter("o_orderstatus = 'F'"), name)
        text_keys = accounts.withColumn("ac_id", F.col("ac_id").cast("string"))
        new = keys.skip_stored(keys.cast_keys(text_keys, {"ac_id": "bigint"}),
                               stored.rows(), ["ac_id"])
        chunks = shared_folder(spark, "new")
        files.write_chunks(new.withColumn("amt", -F.col("amt")), chunks)
        tables.append_rows(files.read_chunks(spark, chunks), name)
    return stored.rows()


def staging_insert_select(spark, sf):
    """A staging table filled from a query inside the catalog, with bound parameters."""
    source, target = _Stored(spark), _Stored(spark)
    with source as a, target as b:
        tables.write_period(_accounts(spark, sf), a)
        tables.insert_select(spark, b, f"select * from {a} where msr_prd_id = :p and amt > :low",
                             {"p": "20001231", "low": 100000})
    return target.rows()


def query_parameters(spark, sf):
    """Named parameters and a nested query."""
    accounts = _accounts(spark, sf)
    return tables.query(
        spark, "select ac_id, amt from {code} where msr_prd_id = :p and o_orderstatus = :s",
        {"p": "19971231", "s": "O"}, {"code": accounts})


def parquet_chunks(spark, sf):
    """Files of a limited number of rows, read back by glob."""
    folder = shared_folder(spark, "chunks")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    files.write_chunks(lines, folder, rows_per_file=50_000)
    return files.read_chunks(spark, f"{folder}/*.parquet")


def export_report(spark, sf):
    """A period's report as CSV with report column names, read back as text."""
    accounts = _accounts(spark, sf).filter("msr_prd_id = '20001231'")
    path = files.export_report(accounts, shared_folder(spark, "reports"), "20001231",
                               {"account_id": "ac_id", "amount": "amt"})
    return spark.read.csv(path, header=True, schema="account_id string, amount string")


def violation_files(spark, sf):
    """Violation files by rule and source, counted from the files."""
    violations = violation_list(spark, sf).withColumn(
        "src_stm", F.when(F.col("rule") == "CN1", "CMS").otherwise("TFS"))
    path = files.write_violations(violations, shared_folder(spark, "violations"), "run1")
    return report.by_source(spark.read.csv(path, header=True))


def rule_counts(spark, sf):
    """The number of violations of every rule, zero where none, in one row."""
    return report.rule_counts(violation_list(spark, sf), ["CN1", "RI1", "RI2"])


def period_dates(spark, sf):
    """The date of a period, the end of its month, and text that is no period."""
    period = F.when(F.col("o_orderkey") % 7 == 0, "none").otherwise(
        F.date_format("o_orderdate", "yyyyMMdd"))
    orders = table(spark, sf, "orders").select("o_orderkey", period.alias("msr_prd_id"))
    day = period_date(F.col("msr_prd_id"))
    return orders.select("o_orderkey", day.alias("data_dt"), F.last_day(day).alias("month_end"))


QUERIES = {q.__name__: q for q in [
    land_pipe_text, land_pipe_text_rejects, land_quoted_text, land_quoted_text_rejects, land_loose_pattern, replace_periods, one_period, append_new_keys, staging_insert_select,
    query_parameters, parquet_chunks, export_report, violation_files, rule_counts, period_dates,
]}

_ACCOUNTS = ("(select o_orderkey as ac_id, cast(o_totalprice as decimal(18,2)) as amt, "
             "strftime(o_orderdate, '%Y') || '1231' as msr_prd_id, o_orderstatus from orders)")

_NOTES = ("(select *, case o_orderkey % 7 when 0 then 'a|b' || chr(10) || 'c' when 1 then 'say \" twice' || chr(10) || "
          "repeat('line' || chr(10), cast(o_orderkey % 11 as int)) || 'end' when 2 then chr(10) || chr(10) "
          "else o_orderpriority end as note from orders)")

ROUNDTRIP_SQL = {
    "land_pipe_text": "select lpad(cast(o_orderkey as varchar), 12, '0') as ac_id, "
                      "cast(o_orderdate as date) as data_dt, cast(o_totalprice as decimal(18,2)) as amt, "
                      "nullif(o_orderpriority, '4-NOT SPECIFIED') as priority from orders "
                      "where o_orderkey % 50 > 2",
    "land_pipe_text_rejects": "select lpad(cast(o_orderkey as varchar), 12, '0') || '|' || "
                              "cast(cast(o_orderdate as date) as varchar) || '|' || case when o_orderkey % 50 = 2 "
                              "then 'bad' else cast(cast(o_totalprice as decimal(18,2)) as varchar) end || case when "
                              "o_orderkey % 50 = 1 then '' else '|' || case o_orderpriority when '4-NOT SPECIFIED' "
                              "then ' ' else o_orderpriority end end || case when o_orderkey % 50 = 0 then "
                              "'|EXTRA' else '' end as record, case when o_orderkey % 50 = 2 then 'amt' else "
                              "'number of cells' end as reasons, case o_orderstatus when 'F' then 'TXT' else 'TXT2' "
                              "end as part from orders where o_orderkey % 50 <= 2",
    "land_quoted_text": f"select o_orderkey as ac_id, note, cast(o_totalprice as decimal(18,2)) as amt from {_NOTES} "
                        "where o_orderkey % 50 <> 3",
    "land_quoted_text_rejects": "select cast(o_orderkey as varchar) || '|' || case when o_orderkey % 7 < 3 then "
                                "'\"' || replace(note, '\"', '\"\"') || '\"' else note end || '|bad' as record, 'amt' as reasons "
                                f"from {_NOTES} where o_orderkey % 50 = 3 union all select '900|\"open|1', "
                                "'quote without end' union all select '901|x|2', 'quote without end'",
    "land_loose_pattern": "select o_orderkey as ac_id, o_orderstatus as status from orders",
    "replace_periods": f"select ac_id, amt, msr_prd_id from {_ACCOUNTS} where msr_prd_id <> '19981231' "
                       "or o_orderstatus = 'F'",
    "one_period": f"select ac_id, amt, msr_prd_id from {_ACCOUNTS} where msr_prd_id = '19991231'",
    "append_new_keys": "select ac_id, case when o_orderstatus = 'F' then amt else -amt end as amt, "
                       f"msr_prd_id from {_ACCOUNTS}",
    "staging_insert_select": f"select ac_id, amt, msr_prd_id from {_ACCOUNTS} where msr_prd_id = "
                             "'20001231' and amt > 100000",
    "query_parameters": f"select ac_id, amt from {_ACCOUNTS} where msr_prd_id = '19971231' and "
                        "o_orderstatus = 'O'",
    "parquet_chunks": "select l_orderkey, l_linenumber, l_partkey from lineitem",
    "export_report": "select cast(ac_id as varchar) as account_id, cast(amt as varchar) as amount from "
                     f"{_ACCOUNTS} where msr_prd_id = '20001231'",
    "violation_files": "select 'CMS' as src_stm, 'CN1' as rule, count(*) as n from customer where "
                       "c_acctbal < 0 union all select 'TFS', 'RI1', count(*) from orders o where not "
                       "exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey)",
    "rule_counts": "select (select count(*) from customer where c_acctbal < 0) as CN1, (select count(*) "
                   "from orders o where not exists (select 1 from lineitem l where l.l_orderkey = "
                   "o.o_orderkey)) as RI1, 0 as RI2",
    "period_dates": "select o_orderkey, case when o_orderkey % 7 <> 0 then cast(o_orderdate as date) end "
                    "as data_dt, case when o_orderkey % 7 <> 0 then last_day(cast(o_orderdate as date)) "
                    "end as month_end from orders",
}
