"""Records of separated text whose quoted cells hold line breaks, read in splits.

A file is read in splits, and whether a line begins a record depends on the quotes of all lines before it. Each split
is therefore read for both cases, beginning outside and inside of a quoted cell, and tells how it would end: one row a
split. These rows, put one after the other by file, tell how every split begins, and a second read cuts the records.
A record that crosses into other splits leaves a piece in each, and only such pieces are shuffled and put together, so
no file and no split goes to one task for the sake of its quotes. A task holds a split's record at a time.

A quote opens a cell at the beginning of a record or after a separator and is closed by the next one that is not doubled;
other quotes are plain characters. Where a quote is never closed, the lines from its record on are taken singly and
marked. Lines are read as Spark's text source reads them.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUOTE = '"'


def ends_inside(line: str, inside: bool, separator: str) -> bool:
    """Whether a quoted cell is open after a line."""
    opens = True  # a quote that follows at once: at the beginning of a record, or doubled after one that closes
    for before in line.split(QUOTE)[:-1]:
        if inside:
            inside, opens = False, True
        else:
            inside, opens = before.endswith(separator) or opens and not before, False
    return inside


def _lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _runs(batches):
    """The lines of a task, split by split."""
    for batch in batches:
        files, starts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        quoted = pc.match_substring(batch.column(0), QUOTE).to_pylist()
        yield from zip(batch.column(0).to_pylist(), files, starts, quoted)


def _ways(separator: str):
    """Per split how it ends, by how it begins, and whether a record ends in it if it begins inside."""

    def run(batches):
        ends: dict[tuple, list[bool]] = {}
        for line, file, start, quoted in _runs(batches):
            own = ends.setdefault((file, start), [False, True, False])
            if quoted:
                own[:2] = [ends_inside(line, inside, separator) for inside in own[:2]]
                own[2] = own[2] or not own[1]
        rows = [(file, start, *own) for (file, start), own in ends.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), *[pa.bool_()] * 3))],
            names=["file", "start", "from_outside", "from_inside", "parted"])

    return run


def _begun(ways: DataFrame) -> tuple[dict[tuple, int], set[tuple]]:
    """The splits that begin inside of a cell, with the split in which its record begins, and of these records
    the ones that never end. What comes to the driver is a row for each split that begins so."""
    order = F.array_sort(F.collect_list(F.struct("start", "from_outside", "from_inside", "parted")))
    empty = F.expr("cast(array() as array<struct<start:bigint,origin:bigint>>)")
    start = F.struct(F.lit(False).alias("inside"), F.lit(None).cast("long").alias("origin"), empty.alias("found"))

    def step(acc, split):
        ends = F.when(acc["inside"], split["from_inside"]).otherwise(split["from_outside"])
        # a record that is open at the end began here, unless it is the one that the split began in
        origin = F.when(~ends, None).when(acc["inside"] & ~split["parted"], acc["origin"]).otherwise(split["start"])
        found = F.when(acc["inside"], F.concat(acc["found"], F.array(F.struct(split["start"], acc["origin"].alias("origin")))))
        return F.struct(ends.alias("inside"), origin.cast("long").alias("origin"),
                        F.coalesce(found, acc["found"]).alias("found"))

    files = ways.groupBy("file").agg(order.alias("splits")).select("file", F.aggregate("splits", start, step).alias("s"))
    rows = files.filter("s.inside or size(s.found) > 0").select("file", "s.inside", "s.origin", "s.found").collect()
    begun = {(r["file"], f["start"]): f["origin"] for r in rows for f in r["found"]}
    return begun, {(r["file"], r["origin"]) for r in rows if r["inside"]}


def _cut(separator: str, begun: dict[tuple, int], endless: set[tuple]):
    """Records, and pieces of those that cross splits: text, file, the split a piece's record begins in (null for
    whole records), the split it lies in, and whether the record never ends."""
    kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_())

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                          names=["record", "file", "origin", "start", "endless"])

    def run(batches):
        out, at, held, origin, inside = [], None, [], None, False

        def flush():
            # what is open at the end of a split goes on in the next
            if not held:
                return
            came = origin if origin is not None else at[1]
            if (at[0], came) in endless:
                out.extend((line, at[0], None, at[1], True) for line in held)
            else:
                out.append(("\n".join(held), at[0], came, at[1], False))

        for line, file, start, quoted in _runs(batches):
            if (file, start) != at:
                flush()
                at, held = (file, start), []
                origin = begun.get(at)
                inside = origin is not None
            if not held and not quoted and not inside:
                out.append((line, file, None, start, False))
            else:
                held.append(line)
                inside = ends_inside(line, inside, separator) if quoted else inside
                if not inside:
                    out.append(("\n".join(held), file, origin, start, False))
                    held, origin = [], None
            if len(out) >= 5000:
                yield table(out)
                out.clear()
        if at is not None:
            flush()
        yield table(out)

    return run


def read_records(spark: SparkSession, paths: str | Sequence[str], separator: str = "|") -> DataFrame:
    """`record`, `file` and `endless` of all records of some files. An empty line outside of quotes is a record of no
    cells; null never occurs."""
    lines = _lines(spark, paths)
    ways = lines.mapInArrow(_ways(separator), "file string, start long, from_outside boolean, from_inside boolean, parted boolean")
    begun, endless = _begun(ways)
    cut = lines.mapInArrow(_cut(separator, begun, endless),
                           "record string, file string, origin long, start long, endless boolean")
    if not begun:
        return cut.select("record", "file", "endless")
    pieces = cut.filter("origin is not null").groupBy("file", "origin").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "record"))), lambda p: p["record"]), "\n")
        .alias("record")).select("record", "file", F.lit(False).alias("endless"))
    return cut.filter("origin is null").select("record", "file", "endless").union(pieces)
