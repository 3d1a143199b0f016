"""Rows that may have one of some keys, told apart where they are read.

A filter of bounded size holds a bit for the hash of every key. A row whose bit is not set has none of the keys and
need not be shuffled to be compared with them; one whose bit is set may have one, so it is compared by a join. The filter
says what is moved, never what is found.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a filter at most (8 MB); beyond a tenth of that in keys it lets more and more rows through.
MOST_BITS = 1 << 26
#: Bits for each key while there are few.
BITS_EACH = 16
#: Bits of one of Spark's bitmaps.
BITMAP = 1 << 15

MAYBE = "__maybe"


def _at(columns: Sequence[Column], bits: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(bits))


@dataclass(frozen=True)
class Sieve:
    """A filter of keys, for the row columns ``columns``: a bitmap a row in ``maps``, of ``bits`` bits together."""

    columns: tuple[str, ...]
    bits: int
    maps: DataFrame

    @staticmethod
    def of(keys: DataFrame, rows: DataFrame, on: Sequence[tuple[str, str]], folder: str) -> Sieve:
        """The filter of a stored frame of keys, written to a folder. ``on`` has pairs of (column of the rows, column of the
        keys), as a join does; keys are cast to the types of ``rows``, so both hash alike."""
        types = {f.name: f.dataType for f in rows.schema.fields}
        bits = max(BITMAP, min(MOST_BITS, 1 << max(BITS_EACH * keys.count() - 1, 1).bit_length()))
        at = _at([F.col(k).try_cast(types[c]) for c, k in on], bits) + 1
        maps = (keys.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("__bucket"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("__bits")))
        maps.write.mode("overwrite").parquet(folder)
        return Sieve(tuple(c for c, _ in on), bits, keys.sparkSession.read.schema(maps.schema).parquet(folder))

    def parted(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The rows that may have one of the keys, and those that have none."""
        at = _at([F.col(c) for c in self.columns], self.bits)
        # Spark puts the first bit of a byte last
        byte = "cast(conv(hex(substring(__bits, cast(__at % {0} div 8 + 1 as int), 1)), 16, 10) as int)".format(BITMAP)
        is_set = F.expr(f"(shiftright({byte}, cast(__at % 8 as int)) & 1) = 1")
        # at most MOST_BITS / BITMAP rows
        asked = rows.withColumn("__at", at).withColumn("__bucket", F.floor(F.col("__at") / BITMAP) + 1).join(
            F.broadcast(self.maps), "__bucket", "left").withColumn(MAYBE, F.coalesce(is_set, F.lit(False)))
        kept = [F.col(f"`{c}`") for c in rows.columns]
        return asked.filter(MAYBE).select(*kept), asked.filter(~F.col(MAYBE)).select(*kept)
