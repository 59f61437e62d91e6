"""Canonical column names and schemas of the panel data model, and schema alignment.

Fixed values below are the reference's column names; the panel data model is spoken in them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Daily measures of a payload / daily observation row.
DAILY_MEASURES = ["temp_max", "temp_min", "precipitation", "humidity", "sunshine"]

# Monthly measure names, in the reference's feature order.
MONTHLY_FEATURES = ["avg_temp_max", "avg_temp_min", "avg_humidity",
                    "total_precipitation", "total_sunshine_hours"]

# Roll-up rule of each daily measure -> (monthly name, aggregate).
ROLLUP_RULES = {
    "temp_max": ("avg_temp_max", "mean"),
    "temp_min": ("avg_temp_min", "mean"),
    "humidity": ("avg_humidity", "mean"),
    "precipitation": ("total_precipitation", "sum"),
    "sunshine": ("total_sunshine_hours", "sum"),
}

# Legacy history names mapped to the canonical ones.
LEGACY_RENAMES = {
    "sum_precipitation": "total_precipitation",
    "sum_sunshine_hours": "total_sunshine_hours",
}

# Payload member names (struct of parallel arrays) -> daily measure.
PAYLOAD_MEMBERS = {
    "temperature_2m_max": "temp_max",
    "temperature_2m_min": "temp_min",
    "precipitation_sum": "precipitation",
    "relative_humidity_2m_mean": "humidity",
    "sunshine_duration": "sunshine",
}

ENTITY = "district"
DISTRICT_TARGET = "mal_cases"
SERIES_TARGET = "ddd_demand"

# Column order of the district history table and of the national feature history.
DISTRICT_HISTORY_COLUMNS = ["year", "month", ENTITY, DISTRICT_TARGET] + MONTHLY_FEATURES
NATIONAL_HISTORY_COLUMNS = MONTHLY_FEATURES + [SERIES_TARGET]

_MEASURE = T.DoubleType()

DAILY_SCHEMA = T.StructType(
    [T.StructField(ENTITY, T.StringType()), T.StructField("date", T.DateType())]
    + [T.StructField(m, _MEASURE) for m in DAILY_MEASURES]
    + [T.StructField("month", T.StringType())])

NATIONAL_SERIES_SCHEMA = T.StructType(
    [T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())]
    + [T.StructField(m, _MEASURE) for m in MONTHLY_FEATURES]
    + [T.StructField(SERIES_TARGET, _MEASURE)])

PAYLOAD_SCHEMA = T.StructType([
    T.StructField(ENTITY, T.StringType()),
    T.StructField("daily", T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()))]
        + [T.StructField(m, T.ArrayType(_MEASURE)) for m in PAYLOAD_MEMBERS])),
])


def schema_align(df: DataFrame, columns: list[str], renames: dict[str, str] | None = None,
                 add_missing: dict[str, T.DataType] | None = None,
                 types: dict[str, T.DataType] | None = None) -> DataFrame:
    """Rename legacy names, add absent nullable columns, and select ``columns`` in order.

    * ``renames``: old -> new; names that are absent are ignored.
    * ``add_missing``: column -> type, added as NULL only when the column is absent.
    * ``types``: casts applied after renaming (e.g. year/month stored as doubles in CSV).
    Extra columns (such as an old ``index``) are dropped by the final selection.
    """
    renames = {k: v for k, v in (renames or {}).items() if k in df.columns}
    if renames:
        df = df.withColumnsRenamed(renames)
    missing = {c: F.lit(None).cast(t) for c, t in (add_missing or {}).items() if c not in df.columns}
    if missing:
        df = df.withColumns(missing)
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"missing required columns: {absent}")
    casts = {c: F.col(c).cast(t) for c, t in (types or {}).items() if c in columns}
    if casts:
        df = df.withColumns(casts)
    return df.select(*columns)
