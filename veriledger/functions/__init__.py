"""Column functions shared by the operators."""

from veriledger.functions.blanks import (
    NULL_WORDS,
    blank,
    clear_space,
    filled,
    null_words_to_null,
)
from veriledger.functions.checkdigit import thai_id_check
from veriledger.functions.periods import (
    FILLER_DATE,
    data_date,
    load_time,
    next_period_daily,
    next_period_month_end,
    period_date,
)
from veriledger.functions.values import amount, cast_to, is_number

__all__ = [
    "FILLER_DATE",
    "NULL_WORDS",
    "amount",
    "blank",
    "cast_to",
    "clear_space",
    "data_date",
    "filled",
    "is_number",
    "load_time",
    "next_period_daily",
    "next_period_month_end",
    "null_words_to_null",
    "period_date",
    "thai_id_check",
]
