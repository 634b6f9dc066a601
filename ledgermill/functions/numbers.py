"""Numeric predicates and formatting."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: how a ratio is shown ----------------------------------------------------------------------
PERCENT_RATIOS = ["gross_margin", "operating_margin", "net_margin", "roa", "roe", "yoy_revenue_growth"]
CURRENCY_RATIOS = ["free_cash_flow", "working_capital"]


def relative_difference(a: Column, b: Column) -> Column:
    """|a - b| over the larger magnitude; NULL when both are zero."""
    return F.try_divide(F.abs(a - b), F.greatest(F.abs(a), F.abs(b)))


def show_ratio(ratio: Column, value: Column) -> Column:
    """A ratio as text: percentages, billions for amounts, two decimals otherwise."""
    return (F.when(value.isNull(), F.lit("n/a"))
            .when(ratio.isin(PERCENT_RATIOS), F.format_string("%.1f%%", value * 100))
            .when(ratio.isin(CURRENCY_RATIOS), F.concat(F.format_number(value / 1e9, 2), F.lit(" B")))
            .otherwise(F.format_string("%.2f", value)))
