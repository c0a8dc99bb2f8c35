"""Fiscal-year expressions.

The fiscal year starts in ``start_month`` (April by default): a date in
month >= start_month belongs to its calendar year, earlier months to the
year before.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def fiscal_year(date_col: str | Column, start_month: int = 4) -> Column:
    """``year(add_months(d, 1 - start_month))``: 2025-03-31 -> 2024, 2025-04-01 -> 2025."""
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    return F.year(F.add_months(F.to_date(c), 1 - start_month))


def fiscal_bounds(first_fy: int, last_fy: int, start_month: int = 4) -> tuple[_dt.datetime, _dt.datetime]:
    """Half-open [start, end) timestamps covering fiscal years first_fy..last_fy."""
    return (_dt.datetime(first_fy, start_month, 1), _dt.datetime(last_fy + 1, start_month, 1))


def fiscal_range(date_col: str | Column, first_fy: int, last_fy: int | None = None, start_month: int = 4) -> Column:
    """Predicate ``first_fy <= fiscal_year(d) <= last_fy`` written on the raw
    column, so the parquet scan receives it as a pushed range filter (a filter
    on ``year(add_months(..))`` cannot be pushed)."""
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    lo, hi = fiscal_bounds(first_fy, first_fy if last_fy is None else last_fy, start_month)
    return (c >= F.lit(lo).cast("timestamp_ntz")) & (c < F.lit(hi).cast("timestamp_ntz"))


def years_desc(start_year: int, end_year: int) -> list[int]:
    """Inclusive year list, newest first."""
    return list(range(end_year, start_year - 1, -1))
