"""Column-expression helpers (all built-in Spark functions, codegen friendly)."""

from starmart.functions.arith import money, pct, safe_div
from starmart.functions.dates import (
    date_key,
    day_name_padded,
    day_of_week0,
    days_between,
    month_name_padded,
    month_start,
)

__all__ = [
    "money", "pct", "safe_div",
    "date_key", "day_name_padded", "day_of_week0", "days_between",
    "month_name_padded", "month_start",
]
