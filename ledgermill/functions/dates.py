"""Date helpers, all built-in expressions so they stay inside code generation."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def compact_date(text: Column) -> Column:
    """``YYYYMMDD`` text as a date; anything else, an impossible day included, is NULL.

    A cast of ``YYYY-MM-DD`` is several times cheaper than parsing with a pattern.
    """
    dashed = F.concat(F.substring(text, 1, 4), F.lit("-"), F.substring(text, 5, 2), F.lit("-"),
                      F.substring(text, 7, 2))
    return F.when(F.length(text) == 8, dashed.try_cast("date"))


def period_key(period_end: Column, qtrs: Column) -> Column:
    """``YYYYMMDD-quarters``. A date cast to text is several times cheaper than one formatted by a pattern."""
    return F.concat(F.replace(period_end.cast("string"), F.lit("-"), F.lit("")), F.lit("-"), qtrs.cast("string"))


def month_end_before(day: Column, months: Column | int) -> Column:
    """The month end ``months`` months before the month of ``day``."""
    back = -months if isinstance(months, Column) else F.lit(-months)
    return F.last_day(F.add_months(day, back))


def period_start(period_end: Column, qtrs: Column) -> Column:
    """First day of a duration of ``qtrs`` quarters; NULL for an instant."""
    return F.when(qtrs != 0, F.date_add(month_end_before(period_end, (qtrs * 3).cast("int")), 1))


def period_type(qtrs: Column) -> Column:
    names = {0: "instant", 1: "quarter", 2: "half_year_ytd", 3: "nine_month_ytd", 4: "annual"}
    out = F.lit("other")
    for n, name in names.items():
        out = F.when(qtrs == n, name).otherwise(out)
    return out


def month_index(day: Column) -> Column:
    """Months since year 0, an integer key for month arithmetic."""
    return F.year(day) * 12 + F.month(day)


def fiscal_year(period_end: Column, year_end_month: Column) -> Column:
    """Calendar year in which the fiscal year containing ``period_end`` ends."""
    return F.year(period_end) + (F.month(period_end) > year_end_month).cast("int")


def fiscal_quarter(period_end: Column, year_end_month: Column) -> Column:
    """1 to 4, or NULL when the period does not end on a quarter of the company's fiscal year."""
    months_left = (year_end_month - F.month(period_end) + 12) % 12
    return F.when(months_left % 3 == 0, (4 - months_left / 3).cast("int"))


def quarter_window(latest: str, n: int) -> list[str]:
    """The ``n`` dataset quarters ending at ``latest`` (``2026q2``), oldest first."""
    year, quarter = (int(part) for part in latest.strip().lower().split("q"))
    last = year * 4 + quarter - 1
    return [f"{i // 4}q{i % 4 + 1}" for i in range(last - n + 1, last + 1)]
