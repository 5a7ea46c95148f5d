"""Column-level helpers. Every function returns a ``Column`` built from JVM-side Spark
expressions, so callers stay inside whole-stage codegen (no Python UDFs)."""

from hearth.functions.text import (
    blank_to_null,
    clean_count_int,
    clean_money_int,
    is_blank,
    month_start,
    norm,
    period_end_year,
    strict_int,
    upper_trim,
)
from hearth.functions.measures import (
    exact_avg,
    exact_mean,
    guarded_ratio,
    nullif_ratio,
    round_half_up_cents,
)

__all__ = [
    "blank_to_null",
    "clean_count_int",
    "clean_money_int",
    "exact_avg",
    "exact_mean",
    "guarded_ratio",
    "is_blank",
    "month_start",
    "norm",
    "nullif_ratio",
    "period_end_year",
    "round_half_up_cents",
    "strict_int",
    "upper_trim",
]
