"""Several tables published at once.

A load writes the rows of each table and period to a folder of its own that no reader knows. Only when all are written
do the periods' locations move to them, one after the other, which writes no data: a reader sees the old rows until
then and the new ones after, also when some of the tables depend on each other. The list of moves is stored before
the first, so a release that was broken off half way is finished by publishing it again, and moves that fail are taken
back. A load that fails before leaves everything as it was.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriledger.sources import tables
from veriledger.sources.shared import remove_folder
from veriledger.sources.tables import PERIOD


@dataclass(frozen=True)
class Move:
    """A period of a table and the folder it goes to; ``before`` is where it was, None if there was none."""

    table: str
    period: str
    folder: str
    before: str | None


@dataclass
class Release:
    """Rows that are written and not yet seen. ``folder`` is shared by all who may have to finish the release."""

    spark: SparkSession
    folder: str
    name: str = field(default_factory=lambda: uuid.uuid4().hex)
    moves: list[Move] = field(default_factory=list)

    def stage(self, table: str, period: str, rows: DataFrame) -> DataFrame:
        """Writes the rows of a period to be published; gives them back as stored, for tables that depend on them."""
        if not re.fullmatch(r"[0-9]{8}", period):
            raise ValueError(f"not a period: {period!r}")
        schema = self.spark.table(table).schema
        columns = [f for f in schema.fields if f.name != PERIOD]
        aligned = tables.align(rows.withColumn(PERIOD, F.lit(period)), schema).select(*[f.name for f in columns])
        folder = f"{self.folder}/{self.name}/{table}/{PERIOD}={period}"
        aligned.hint("rebalance").write.mode("overwrite").parquet(folder)
        before = location(self.spark, table, period)
        self.moves = [m for m in self.moves if (m.table, m.period) != (table, period)]
        self.moves.append(Move(table, period, folder, before))
        return self.spark.read.schema(aligned.schema).parquet(folder).withColumn(PERIOD, F.lit(period))

    def publish(self) -> None:
        """Moves all periods. If a move fails, those made are taken back and the fault is raised."""
        self._write_list()
        done: list[Move] = []
        try:
            for move in self.moves:
                _move(self.spark, move.table, move.period, move.folder)
                done.append(move)
        except Exception:
            for move in reversed(done):
                _move(self.spark, move.table, move.period, move.before)
            raise

    def drop(self) -> None:
        """Removes what was staged; for releases that are not published."""
        remove_folder(self.spark, f"{self.folder}/{self.name}")

    def remove_before(self) -> None:
        """Removes the rows that a published release took the place of, where they were a release's too; to be
        called when no reader of theirs is left."""
        for move in self.moves:
            if move.before and self.folder.removeprefix("file:") in move.before:
                remove_folder(self.spark, move.before)

    def _write_list(self) -> None:
        lines = [(json.dumps(vars(m)),) for m in self.moves]  # one line a table and period
        self.spark.createDataFrame(lines, "move string").coalesce(1).write.mode("overwrite").text(
            f"{self.folder}/{self.name}/_moves")


def unfinished(spark: SparkSession, folder: str, name: str) -> Release:
    """A release whose list was stored, to be published again."""
    lines = spark.read.text(f"{folder}/{name}/_moves").collect()
    return Release(spark, folder, name, [Move(**json.loads(r["value"])) for r in lines])


def location(spark: SparkSession, table: str, period: str) -> str | None:
    """Where a period of a table lies."""
    stored = {r["partition"] for r in spark.sql(f"show partitions {table}").collect()}
    if f"{PERIOD}={period}" not in stored:
        return None
    facts = spark.sql(f"describe formatted {table} partition ({PERIOD} = '{period}')").collect()
    return next(r["data_type"] for r in facts if r["col_name"] == "Location")


def _move(spark: SparkSession, table: str, period: str, folder: str | None) -> None:
    partition = f"partition ({PERIOD} = '{period}')"
    if folder is None:
        spark.sql(f"alter table {table} drop if exists {partition}")
        return
    spark.sql(f"alter table {table} add if not exists {partition} location '{folder}'")
    spark.sql(f"alter table {table} {partition} set location '{folder}'")
    spark.catalog.refreshTable(table)
