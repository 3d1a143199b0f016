"""Check digit of 13-digit Thai identifiers (public mod-11 formula)."""

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

ID_LENGTH = 13


def thai_id_check(col: Column) -> Column:
    """True when digit 13 equals (11 - sum(d_i * (14 - i)) mod 11) mod 10, else false.

    Text that is not exactly 13 digits fails; NULL stays NULL. Twelve substrings in one
    expression stay inside code generation, unlike a lambda over an array of digits.
    """
    weighted = reduce(
        add,
        [F.substring(col, i, 1).try_cast("int") * (ID_LENGTH + 1 - i) for i in range(1, ID_LENGTH)],
    )
    expected = (F.lit(11) - weighted % 11) % 10
    holds = expected == F.substring(col, ID_LENGTH, 1).try_cast("int")
    return F.when(col.isNull(), None).when(col.rlike(f"^[0-9]{{{ID_LENGTH}}}$"), holds).otherwise(False)
