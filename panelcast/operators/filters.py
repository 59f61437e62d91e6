"""Row filters: previous-calendar-month period and entity exclusion."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.periods import period_name, previous_month_bounds


def period_filter(df: DataFrame, date: str, as_of: dt.date | str, stamp: str | None = "period") -> DataFrame:
    """Rows of the calendar month before ``as_of`` (inclusive bounds), stamped ``YYYY_MM``.

    The bounds are literals, so on a date cast of a timestamp column Catalyst unwraps the cast and
    the range reaches the Parquet scan as pushed filters.
    """
    first, last = previous_month_bounds(as_of)
    out = df.filter(F.col(date).between(F.lit(first), F.lit(last)))
    if stamp:
        out = out.withColumn(stamp, F.lit(period_name(first)))
    return out


def entity_exclude(df: DataFrame, entity: str, excluded: list) -> DataFrame:
    """Drop the listed entities (a literal IN list; NULL entities are kept out as well)."""
    return df.filter(~F.col(entity).isin(list(excluded)) & F.col(entity).isNotNull())
