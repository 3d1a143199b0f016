"""Reading tables, scratch tables and row-wise Arrow work that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriledger.sources.shared import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder and read from there: lineage ends here."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def without(df: DataFrame, names) -> list[str]:
    """The columns of a frame but those whose name, in any case, is among `names`."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


#: Bytes of text that a task works on at once; a longer text is worked on by itself.
SLICE_BYTES = 8 << 20


def quoted(name: str):
    return F.col(f"`{name.replace('`', '``')}`")


def slices(batch: pa.RecordBatch, texts: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in parts whose texts, column `texts`, are of a bounded size together."""
    sizes = pc.fill_null(pc.binary_length(batch.column(texts)), 0).to_pylist()
    for start, end in pieces(sizes, most):
        yield batch.slice(start, end - start)


def in_batches(spark: SparkSession, most: int) -> None:
    """Rows go to Python in Arrow batches of `most` bytes, or of one longer row, from now on: a frame is run when its rows
    are asked for, so the setting stays the session's. Without it a batch has up to 64 MB, which the JVM and a worker hold
    some times over."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))


def extended(df: DataFrame, column: str, fields: list[T.StructField], work: Callable[[pa.Array], dict],
             keep: list[str] | None = None, most: int = SLICE_BYTES, after: Callable[[], None] | None = None) -> DataFrame:
    """The rows with columns made from one text column, in the same tasks.

    `work` gets some texts, of `most` bytes or a single one, and gives an Arrow array per field. `keep` names the columns that
    stay (all, unless given); one that has the name of a new column gives way to it. `after` is called at a task's end.
    """
    names = [f.name for f in fields]
    kept = [c for c in without(df, names) if keep is None or c in keep]
    schema = T.StructType([df.schema[c] for c in kept] + fields)
    source = df.select(*[quoted(c) for c in kept])
    at = kept.index(column) if column in kept and df.schema[column].dataType == T.StringType() else len(kept)
    if at == len(kept):
        source = df.select(*[quoted(c) for c in kept], quoted(column).cast("string").alias("_text"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for whole in parts:
                for batch in slices(whole, at, most):
                    made = work(batch.column(at))
                    arrays = [*batch.columns[:len(kept)], *[made[n] for n in names]]
                    yield pa.RecordBatch.from_arrays(arrays, names=kept + names)
        finally:
            if after is not None:
                after()

    return source.mapInArrow(run, schema)


def pieces(sizes, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows whose sizes add up to `most` at most; a larger row is alone."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += int(size)
    if start < len(sizes):
        yield start, len(sizes)
