"""Calendar helpers: month starts, previous-month bounds, month labels.

All dates are month starts, so ``add_months`` never clamps a month end. ``as_of`` is always an
argument; nothing reads the wall clock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The label formats the reference writes for a forecast month.
LABEL_FORMATS = {
    "space": "MMMM yyyy",      # April 2025
    "joined": "MMMMyyyy",      # April2025
    "underscore": "MMMM_yyyy",  # April_2025
    "iso": "yyyy-MM-dd",       # 2025-04-01
    "period": "yyyy_MM",       # 2025_04
}


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def month_start(year: Column | str, month: Column | str) -> Column:
    return F.make_date(_c(year), _c(month), F.lit(1))


def previous_month_bounds(as_of: dt.date | str) -> tuple[dt.date, dt.date]:
    """First and last day of the calendar month before ``as_of`` (both inclusive)."""
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    first_this = as_of.replace(day=1)
    last_prev = first_this - dt.timedelta(days=1)
    return last_prev.replace(day=1), last_prev


def period_name(first_day: dt.date) -> str:
    """``YYYY_MM`` stamp for a month."""
    return f"{first_day.year:04d}_{first_day.month:02d}"
