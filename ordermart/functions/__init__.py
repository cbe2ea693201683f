"""Column-expression helpers; every helper returns a built-in (JVM, codegen'd) Column."""

from ordermart.functions.money import in_cents, money, money_sum, money_avg, round_half_up, ratio
from ordermart.functions.status import normalize_status
from ordermart.functions.buckets import category_bucket, padded, product_bucket, product_name
from ordermart.functions.timecols import (
    epoch_seconds_to_ntz, ntz_to_epoch_seconds, strip_tz_suffix, parse_wall_clock,
    year_month, year_of, month_of, year_from_ym, month_from_ym,
)

__all__ = [
    "in_cents", "money", "money_sum", "money_avg", "round_half_up", "ratio", "normalize_status",
    "category_bucket", "padded", "product_bucket", "product_name", "epoch_seconds_to_ntz",
    "ntz_to_epoch_seconds", "strip_tz_suffix", "parse_wall_clock", "year_month",
    "year_of", "month_of", "year_from_ym", "month_from_ym",
]
