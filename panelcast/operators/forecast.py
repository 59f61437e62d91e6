"""Forecast months, long-format outputs and accuracy by horizon.

The (model x entity x horizon) expansion is always an ``inline``/``explode`` of a bounded,
literal-sized array per row, never a join; month labels are computed from the horizon and a
scalar latest month, so no month table is joined either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.numeric import clamp_zero
from panelcast.functions.periods import LABEL_FORMATS
from panelcast.functions.rounding import round_half_even

HORIZON = 3


def forecast_months(df: DataFrame, date: str = "date", horizon: int = HORIZON,
                    entity: str | None = None) -> DataFrame:
    """The ``horizon`` months after the last month (per entity, or of the whole frame), with
    every label format: rows ``([entity], horizon, year, month, date, label_*)``."""
    keys = [entity] if entity else []
    last = df.groupBy(*keys).agg(F.max(date).alias("_last"))
    steps = last.select(*keys, "_last", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("horizon"))
    d = F.add_months(F.trunc("_last", "MM"), F.col("horizon"))
    out = steps.select(*keys, "horizon", d.alias("date"))
    labels = {f"label_{k}": F.date_format("date", fmt) for k, fmt in LABEL_FORMATS.items()}
    return out.select(*keys, "horizon", F.year("date").alias("year"), F.month("date").alias("month"),
                      "date", *[v.alias(k) for k, v in labels.items()])


def target_month(latest: Column, horizon: Column | str = "horizon") -> Column:
    h = F.col(horizon) if isinstance(horizon, str) else horizon
    return F.add_months(F.trunc(latest, "MM"), h)


def long_forecast(scores: DataFrame, latest: Column, entity: str = "district",
                  value: str = "y", out: str = "predicted_mal_cases", label: str = "underscore",
                  clamp: bool = True, digits: int | None = 2) -> DataFrame:
    """``(entity, model, month label, value)``: clamp at zero (Python ``max(0, y)`` semantics,
    NaN and NULL give 0) and round NumPy-style for the fixed-decimal sink."""
    v = F.col(value)
    if clamp:
        v = clamp_zero(v)
    if digits is not None:
        v = round_half_even(v, digits)
    month = F.date_format(target_month(latest), LABEL_FORMATS[label])
    return scores.select(entity, "model", month.alias("month"), v.alias(out))


def series_forecast(scores: DataFrame, latest: Column, value: str = "y",
                    out: str = "predicted_demand", digits: int = 4) -> DataFrame:
    """``(model_name, date, value)`` for a single series; dates are month starts."""
    return scores.select(F.col("model").alias("model_name"), target_month(latest).alias("date"),
                         round_half_even(value, digits).alias(out))


def mae_by_horizon(pred: DataFrame, actual: DataFrame, keys: list[str], value: str = "y",
                   target: str = "actual", horizon: int = HORIZON) -> DataFrame:
    """Per model: ``t{h}_mae`` (mean absolute error at horizon h), ``mae_sum`` and ``mae``.

    ``pred`` has ``keys + [model, horizon, value]``; ``actual`` has ``keys + [target]``. Only
    forecasts with an actual value count. The pivot values are listed, so no extra job runs to
    discover them.
    """
    err = (pred.join(actual, keys, "inner")
               .select("model", "horizon", F.abs(F.col(value) - F.col(target)).alias("_err")))
    wide = err.groupBy("model").pivot("horizon", list(range(1, horizon + 1))).agg(F.avg("_err"))
    cols = [F.col(str(h)).alias(f"t{h}_mae") for h in range(1, horizon + 1)]
    total = F.col("1")
    for h in range(2, horizon + 1):
        total = total + F.col(str(h))             # NULL when a horizon has no actual value
    return wide.select(F.col("model").alias("model_name"), *cols, total.alias("mae_sum"),
                       (total / F.lit(float(horizon))).alias("mae"))
