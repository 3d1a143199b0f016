"""A period's report in order: numbered parts of equal rows and a manifest that lists them.

Rows are dealt out by ranges of the order and sorted within each, so no task sees more than a range. The ranges' row
counts, one number a range, give every row its place in the whole, and the place gives its part: all parts have
the same number of rows but the last. The manifest has each part's rows, the place of its first row and a checksum of its
content, all taken from what is written, so a reader can tell whether the parts are complete and unchanged.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriledger.operators.reshape import in_order
from veriledger.sources.files import ROWS_PER_FILE
from veriledger.sources.shared import shared_folder

PART, PLACE, RANGE = "part", "__place", "__range"

#: The manifest lies beside the parts, in a folder that Spark's readers pass over.
MANIFEST = "_manifest"
MANIFEST_SCHEMA = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("rows", T.LongType()),
    T.StructField("first_place", T.LongType()), T.StructField("checksum", T.StringType())])


class ReportIncomplete(ValueError):
    """Parts are missing, surplus or changed."""


def checksum(columns: Sequence[str]) -> Column:
    """A sum over rows of a hash of their cells as text; an empty cell and none are the same in a file."""
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns]
    return F.coalesce(F.sum(F.xxhash64(*cells).cast("decimal(38,0)")), F.lit(0)).cast("string")


def placed(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows with their place in the order, from 0. NULL comes first; rows that are equal in the order follow
    each other by all columns.

    The sorted rows are stored once and numbered from there, so the places are those of one sort.
    """
    spark = df.sparkSession
    by = [F.col(f"`{c}`") for c in [*order, *[c for c in df.columns if c not in order]]]
    ranges = df.repartitionByRange(*by).sortWithinPartitions(*by)
    folder = shared_folder(spark, "ordered")
    ids = F.monotonically_increasing_id()
    ranges.withColumns({RANGE: F.shiftright(ids, 33).cast("int"), PLACE: ids.bitwiseAND(F.lit((1 << 33) - 1))}).write.parquet(folder)
    stored = spark.read.parquet(folder)
    # one row a range: few enough for one running sum
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    starts = (stored.groupBy(RANGE).agg(F.count("*").alias("n"))
              .select(RANGE, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start")))
    # as many rows as ranges, which a setting bounds
    return stored.join(F.broadcast(starts), RANGE).withColumn(PLACE, F.col(PLACE) + F.col("__start")).drop(RANGE, "__start")


def export_ordered(df: DataFrame, folder: str, period: str, names: Mapping[str, str], order: Sequence[str],
                   rows_per_part: int = ROWS_PER_FILE) -> str:
    """The report of a period under ``folder/period``: ``part=<n>`` folders of one CSV file each, and a manifest.

    ``names`` maps report columns to the frame's; ``order`` are columns of the frame. A report without rows has
    one part with the header alone.
    """
    path = f"{folder.rstrip('/')}/{period}"
    columns = list(names)
    report = in_order(df, {**names, **{f"__order{i}": c for i, c in enumerate(order)}})
    by = [f"__order{i}" for i in range(len(order))]
    rows = placed(report, by).drop(*by).withColumn(PART, F.floor(F.col(PLACE) / rows_per_part).cast("int"))
    writer = rows.repartition(PART).sortWithinPartitions(PART, PLACE).drop(PLACE).write.mode("overwrite")
    writer.partitionBy(PART).option("header", True).option("emptyValue", "").csv(path)
    manifest = rows.groupBy(PART).agg(F.count("*").alias("rows"), F.min(PLACE).alias("first_place"),
                                      checksum(columns).alias("checksum"))
    if manifest.isEmpty():
        rows.drop(PLACE, PART).limit(0).coalesce(1).write.mode("overwrite").option("header", True).csv(f"{path}/{PART}=0")
        manifest = df.sparkSession.createDataFrame([(0, 0, 0, "0")], MANIFEST_SCHEMA)
    # as many rows as parts
    manifest.select(*MANIFEST_SCHEMA.names).coalesce(1).write.mode("overwrite").json(f"{path}/{MANIFEST}")
    return path


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).json(f"{path}/{MANIFEST}")


def read_report(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The parts that the manifest lists, as text with their ``part``.

    Raises :class:`ReportIncomplete` if a part's rows or content are not those of the manifest, or a part is missing
    or surplus. Parts are compared by their totals, so a large report is read in parallel.
    """
    schema = T.StructType([*[T.StructField(c, T.StringType()) for c in columns], T.StructField(PART, T.IntegerType())])
    parts = spark.read.schema(schema).option("header", True).csv(path)
    counted = parts.groupBy(PART).agg(F.count("*").alias("found"), checksum(columns).alias("sum"))
    listed = read_manifest(spark, path)
    both = listed.join(counted, PART, "full_outer")
    wrong = both.filter(~(F.col("rows").eqNullSafe(F.coalesce("found", F.lit(0)))
                          & F.col("checksum").eqNullSafe(F.coalesce("sum", F.lit("0"))))).select(PART).limit(5).collect()
    if wrong:
        raise ReportIncomplete(f"{path}: parts {sorted(r[PART] for r in wrong)} are not those of the manifest")
    return parts
