"""Run a query in Spark and its SQL in DuckDB and compare the rows as multisets."""

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, decimal.Decimal, float)):
        v = float(v)
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, datetime.date):
        return datetime.datetime(v.year, v.month, v.day).isoformat()
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, sf_dir):
    df = query(spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    theirs = rows_of(columns, cur.fetchall())
    assert sorted(df.columns) == sorted(columns), (name, df.columns, columns)
    assert mine == theirs, (name, sum(mine.values()), sum(theirs.values()),
                            list((mine - theirs).items())[:3], list((theirs - mine).items())[:3])
    return sum(mine.values())
