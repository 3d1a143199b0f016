"""A filter of bounded size that tells tasks which numbers they may leave out."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a filter at most (8 MB), whatever the number of its entries; beyond a tenth of that it lets more and more through.
MOST_BITS = 1 << 26

#: Bits for each entry while there are few.
BITS_EACH = 16

#: Bits of one of Spark's bitmaps.
_BITMAP = 1 << 15


class Wanted:
    """Says no only to numbers that a column does not hold; to others it may say yes. It can spare work and never
    decides a result."""

    def __init__(self, df: DataFrame, column: str):
        count = df.count()
        self.bits = max(_BITMAP, min(MOST_BITS, 1 << max(BITS_EACH * count - 1, 1).bit_length()))
        at = F.pmod(F.col(column), F.lit(self.bits)) + 1
        maps = (df.filter(F.col(column).isNotNull()).select(at.alias("at"))
                .groupBy(F.bitmap_bucket_number("at").alias("bucket"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("map")))
        self.bytes = np.zeros(self.bits // 8, np.uint8)
        for r in maps.collect():
            start = (r["bucket"] - 1) * _BITMAP // 8
            self.bytes[start:start + _BITMAP // 8] = np.frombuffer(r["map"], np.uint8)

    def may_hold(self, values: np.ndarray) -> np.ndarray:
        at = values % self.bits
        return (self.bytes[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
