"""Column-level helpers: all return built-in Column expressions (codegen'd)."""

from martflow.functions.columns import (
    clamp_non_negative,
    composite_key,
    day_start,
    latest_first_order,
    money,
    agg_money,
)

__all__ = [
    "clamp_non_negative",
    "composite_key",
    "day_start",
    "latest_first_order",
    "money",
    "agg_money",
]
