"""Column expressions shared by every operator (JVM-side, no UDFs)."""

from ledgerline.functions.money import (
    avg_money,
    half_up_ratio,
    money_out,
    revenue,
    safe_growth,
)
from ledgerline.functions.timecols import (
    calendar_date,
    month_label,
    month_start,
    parse_timestamp,
)

__all__ = [
    "avg_money",
    "half_up_ratio",
    "money_out",
    "revenue",
    "safe_growth",
    "calendar_date",
    "month_label",
    "month_start",
    "parse_timestamp",
]
