"""Column-level helpers shared by all operators (pure Spark expressions)."""

from salesmart.functions.numeric import (
    money, money_sum, money_mean, round_even, round4, trunc_bigint, currency_label,
)
from salesmart.functions.dates import parse_text_date, shift_years

__all__ = [
    "money", "money_sum", "money_mean", "round_even", "round4", "trunc_bigint",
    "currency_label", "parse_text_date", "shift_years",
]
