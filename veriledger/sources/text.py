"""Landed text files: pipe separated, no header, one or more files per name and period."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriledger.functions.blanks import null_words_to_null
from veriledger.sources.records import read_records

SEPARATOR = "|"

# Columns beside the schema's: what is wrong with a record, the record as it was, and its file.
REASONS, RECORD, FILE = "__reasons", "__record", "__file"
WRONG = "__wrong"
WRONG_NUMBER = "number of cells"
ENDLESS = "__endless"
NEVER_CLOSED = "quote without end"


@dataclass(frozen=True)
class Landed:
    """All records of some files: typed, with the reasons why one cannot be taken."""

    records: DataFrame

    @property
    def rows(self) -> DataFrame:
        """The records that were read in full."""
        return self.records.filter(F.size(REASONS) == 0).drop(REASONS, RECORD, FILE)

    @property
    def rejects(self) -> DataFrame:
        """File, record and reasons of the others."""
        return self.records.filter(F.size(REASONS) > 0).select(
            F.col(FILE).alias("file"), F.col(RECORD).alias("record"),
            F.array_join(REASONS, ", ").alias("reasons"))


def landed_pattern(folder: str, name: str, period: str | None = None) -> str:
    """`<name>_<yyyymmdd>.TXT*`, or any file of the name when no period is given."""
    suffix = f"_{period}.TXT*" if period else "*.TXT*"
    return f"{folder.rstrip('/')}/{name}{suffix}"


def read_pipe_text(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> Landed:
    """Read files by glob with the types of ``schema``.

    Cells are read as text first: missing-value words and empty cells become NULL and text keys keep
    leading zeros. A record with too many or too few cells, or with a cell that does not cast, is kept
    whole with its file and reasons, and is not among the rows: nothing is cut, padded or set to NULL. Quoted cells may hold
    line breaks; where a quote is never closed, the lines from there on are rejected one by one.
    """
    as_text = T.StructType([*[T.StructField(f.name, T.StringType()) for f in schema.fields],
                            T.StructField(WRONG, T.StringType())])
    lines = read_records(spark, paths, SEPARATOR).withColumnsRenamed({"record": RECORD, "file": FILE})
    # Spark fills the last column for a line with another number of cells.
    cells = F.from_csv(RECORD, as_text.simpleString()[len("struct<"):-1].replace(":", " "), {
        "sep": SEPARATOR, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": WRONG})
    raw = (lines.filter(F.trim(RECORD) != "").select(RECORD, FILE, F.col("endless").alias(ENDLESS), cells.alias("c"))
           .select(RECORD, FILE, ENDLESS, "c.*"))
    cells = {f.name: null_words_to_null(F.col(f.name)) for f in schema.fields}
    typed = {f.name: cells[f.name].try_cast(f.dataType) for f in schema.fields}
    wrong = F.col(WRONG).isNotNull()
    reasons = [F.when(F.col(ENDLESS), F.lit(NEVER_CLOSED)), F.when(~F.col(ENDLESS) & wrong, F.lit(WRONG_NUMBER))]
    reasons += [F.when(~F.col(ENDLESS) & ~wrong & cells[f.name].isNotNull() & typed[f.name].isNull(), F.lit(f.name))
                for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    return Landed(raw.select(*[typed[f.name].alias(f.name) for f in schema.fields],
                             F.array_compact(F.array(*reasons)).alias(REASONS), RECORD, FILE))


def table_schema(spark: SparkSession, table: str, without: Sequence[str] = ()) -> T.StructType:
    """Names and types of a target table, minus the columns the load adds itself."""
    fields = [f for f in spark.table(table).schema.fields if f.name not in set(without)]
    return T.StructType(fields)
