"""The three jobs, composed from the operators as single lazy plans.

* ``monthly_etl``: landed payloads -> daily rows of last month -> entity-month and national-month
  roll-ups (one shuffle) -> guarded appends to the two history tables.
* ``series_forecast``: national series -> latest 12 months -> z-scores -> models -> de-normalised
  long output ``(model_name, date, predicted_demand)``.
* ``panel_forecast``: entity-month history -> per-entity stats and complete 6-month windows ->
  tensors -> model set -> de-normalised long output ``(district, model, month, value)``.

``run_*`` functions add the reads and writes. History tables are written to a new versioned
path, because Spark cannot overwrite a path the same plan is reading.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast import schemas
from panelcast.functions.periods import LABEL_FORMATS, period_name, previous_month_bounds
from panelcast.operators import (filters, forecast, history, normalize, partials, rollup, scoring, validate,
                                 windows)
from panelcast.sources import payload as payloads_mod
from panelcast.session import checkpoint_dir
from panelcast.sources import publish, sinks
from panelcast.sources.readers import existing_table

KEYS = [schemas.ENTITY, "year", "month"]


# ---- monthly ETL --------------------------------------------------------------------------

def monthly_etl(payloads: DataFrame, dim: DataFrame, as_of: dt.date | str,
                district_history: DataFrame | None = None,
                national_history: DataFrame | None = None,
                exact_scale: int | None = None, month_rows: DataFrame | None = None) -> dict[str, DataFrame]:
    """All outputs of one monthly run as lazy DataFrames. ``month_rows`` are partial sums of the month
    (:mod:`panelcast.operators.partials`) to roll up instead of the payloads' daily rows."""
    first, _ = previous_month_bounds(as_of)
    period = period_name(first)
    daily = filters.period_filter(payloads_mod.payload_flatten(payloads, period=period),
                                  "date", as_of, stamp=None)
    if month_rows is None:
        grains = rollup.both_grains(daily, exact_scale=exact_scale)
        district = grains.filter(F.col("national") == 0).drop("national")
        national = grains.filter(F.col("national") == 1).drop("national", schemas.ENTITY)
    else:
        district = partials.merged_rollup(month_rows, exact_scale=exact_scale)
        national = partials.merged_rollup(month_rows, national=True, exact_scale=exact_scale)

    target = {schemas.DISTRICT_TARGET: T.DoubleType()}
    district_batch = schemas.schema_align(district, schemas.DISTRICT_HISTORY_COLUMNS, add_missing=target)
    national_cols = ["year", "month"] + schemas.NATIONAL_HISTORY_COLUMNS
    national_batch = schemas.schema_align(national, national_cols,
                                          add_missing={schemas.SERIES_TARGET: T.DoubleType()})
    if district_history is not None:
        stored = schemas.schema_align(district_history, schemas.DISTRICT_HISTORY_COLUMNS,
                                      renames=schemas.LEGACY_RENAMES, add_missing=target)
        district_new = history.rows_all_or_nothing(stored, district_batch, KEYS)
    else:
        district_new = district_batch
    if national_history is not None:
        stored_n = schemas.schema_align(national_history, national_cols,
                                        add_missing={schemas.SERIES_TARGET: T.DoubleType()})
        national_new = history.rows_if_absent(stored_n, national_batch, schemas.MONTHLY_FEATURES, ["year", "month"])
    else:
        national_new = national_batch
    return {
        "daily": daily,
        "coverage_missing": payloads_mod.coverage_missing(dim, payloads),
        "district_month": district,
        "national_month": national,
        # Rows to append to each history table (empty when the guard finds the month stored).
        "district_append": district_new,
        "national_append": national_new,
        "duplicates": (history.duplicate_keys(district_batch, district_history, KEYS)
                       if district_history is not None else None),
    }


def run_monthly_etl(spark: SparkSession, landing: str, dim: DataFrame, as_of: str, warehouse: str,
                    batch: str | None = None, exact_scale: int | None = None) -> dict:
    """Read landed payloads, write the month's outputs, and append to the two history tables.

    The landed JSON is read once, into a copy in the shared checkpoint folder; everything else reads that. Its daily rows
    become partial sums of batch ``batch`` (default: the landing path) in ``{warehouse}/month_partials``, from which both grains
    are merged: a part of the month that lands later, under another path, gives the month its full sum, and the same
    batch run twice changes nothing. (History keeps the month's first state, as its guards demand.)

    History tables live at ``{warehouse}/district_history`` and ``{warehouse}/national_history``,
    partitioned by year and month. Only the guarded new rows are appended, so a month never
    rewrites the whole history, and the guards read only the month's partitions.
    """
    first, _ = previous_month_bounds(as_of)
    period = period_name(first)
    base = warehouse.rstrip("/")
    paths = {"district_history": f"{base}/district_history", "national_history": f"{base}/national_history",
             "month_partials": f"{base}/month_partials"}
    checkpoint_dir(spark)
    pl = payloads_mod.read_payloads(spark, landing).checkpoint(eager=True)
    daily = filters.period_filter(payloads_mod.payload_flatten(pl, period=period), "date", as_of, stamp=None)
    name = batch or hashlib.sha256(landing.rstrip("/").encode()).hexdigest()[:16]
    partials.write_partials(partials.month_partials(daily, name, exact_scale=exact_scale), paths["month_partials"])
    month_rows = partials.read_partials(spark, paths["month_partials"])
    if month_rows is None:                        # no row of the month has landed yet
        month_rows = partials.month_partials(daily, name, exact_scale=exact_scale)
    month_rows = month_rows.where((F.col("year") == first.year) & (F.col("month") == first.month))
    out = monthly_etl(pl, dim, as_of, existing_table(spark, paths["district_history"]),
                      existing_table(spark, paths["national_history"]), exact_scale, month_rows)
    for name in ("daily", "district_month", "national_month", "coverage_missing"):
        paths[name] = sinks.period_path(warehouse, name, period)
        sinks.write_table(out[name], paths[name])
    if out["duplicates"] is not None:             # before the append, which would add to the keys
        paths["duplicates"] = sinks.period_path(warehouse, "duplicates", period)
        sinks.write_table(out["duplicates"], paths["duplicates"])
    for name in ("district", "national"):
        sinks.write_table(out[f"{name}_append"], paths[f"{name}_history"], mode="append",
                          partition_by=["year", "month"],
                          sort_within=["year", "month"] + ([schemas.ENTITY] if name == "district" else []))
    return paths


def _some_rows(forecast_rows: DataFrame) -> DataFrame:
    """The forecast, written to the shared checkpoint folder first: a run that fails or gives no row
    raises here and leaves the last good output as it was (M5)."""
    checkpoint_dir(forecast_rows.sparkSession)
    rows = forecast_rows.checkpoint(eager=True)
    if rows.isEmpty():
        raise RuntimeError("the forecast has no rows")
    return rows


# ---- single-series forecast ------------------------------------------------------------------

def series_forecast(series: DataFrame, models: dict, stats: DataFrame | None = None,
                    window: int = 12, horizon: int = forecast.HORIZON,
                    scorer: str = "auto") -> DataFrame:
    """``series`` has year, month, the five features and the target. ``stats`` defaults to the
    first-60 % fit of the series itself (the published parameters are that fit).

    ``scorer``: ``"columns"`` scores fixed-weight linear models as JVM expressions, ``"workers"``
    runs any model set in ``mapInPandas``; ``"auto"`` picks columns when every model is linear.
    """
    # Input validation raises before any work, as the job requires (bounded report: one row per
    # check).
    validate.assert_valid(series, ["year", "month", schemas.SERIES_TARGET] + schemas.MONTHLY_FEATURES,
                          ["year", "month"])
    dated = windows.with_month_date(series)
    cols = schemas.MONTHLY_FEATURES + [schemas.SERIES_TARGET]
    stats = stats if stats is not None else normalize.fit_stats(dated, cols, ["year", "month"])
    stats = normalize.stats_row(stats)            # the global vector: one row, fetched once
    win = windows.latest_window(dated, ["year", "month"], window)
    z = normalize.normalize(win, stats, schemas.MONTHLY_FEATURES)
    tensor = windows.window_tensor(z, None, "date", schemas.MONTHLY_FEATURES)
    linear = all(isinstance(m, scoring.LinearModel) for m in models.values())
    if scorer == "columns" or (scorer == "auto" and linear):
        scored = scoring.linear_scores(tensor, models, F.flatten("tensor"), [])
    else:
        keyed = tensor.withColumn("_k", F.lit(0))      # the single series as one keyed row
        scored = scoring.good_rows(scoring.score(keyed, scoring.ModelSet.load(models), horizon, "_k"),
                                   on_error="drop_model").drop("_k")
    y = normalize.denormalize(scored, stats, "y", schemas.SERIES_TARGET)
    latest = F.lit(windows.latest_month(dated))
    return forecast.series_forecast(y, latest)


# The merged series CSV stores year and month as doubles ("2017.0").
SERIES_CSV_SCHEMA = T.StructType(
    [T.StructField("year", T.DoubleType()), T.StructField("month", T.DoubleType()),
     T.StructField(schemas.SERIES_TARGET, T.DoubleType())]
    + [T.StructField(c, T.DoubleType()) for c in schemas.MONTHLY_FEATURES])


def run_series_forecast(spark: SparkSession, data_path: str, models: dict, out_dir: str,
                        params_path: str | None = None) -> str:
    """Read the merged series CSV (and optionally a parameter file), forecast, and write
    ``{out_dir}/ddd_predictions_<Month><Year>_...`` with ``model_name, date, predicted_demand``."""
    from panelcast.sources import readers
    raw = readers.read_table(spark, data_path, SERIES_CSV_SCHEMA)
    series = schemas.schema_align(raw, ["year", "month"] + schemas.NATIONAL_HISTORY_COLUMNS,
                                  types={"year": T.IntegerType(), "month": T.IntegerType()})
    stats = (readers.read_params(spark, params_path, schemas.NATIONAL_HISTORY_COLUMNS)
             if params_path else None)
    out = _some_rows(series_forecast(series, models, stats))
    path = sinks.forecast_path(out_dir, "ddd_predictions", forecast_labels(series, style="joined"))
    sinks.write_csv(out.withColumn("date", F.date_format("date", "yyyy-MM-dd")), path)
    return path


# ---- panel forecast ----------------------------------------------------------------------

def panel_forecast(history_df: DataFrame, models: dict | scoring.ModelSet,
                   entity: str = schemas.ENTITY, target: str = schemas.DISTRICT_TARGET,
                   features: list[str] | None = None, k: int = 6, horizon: int = forecast.HORIZON,
                   exclude: list | None = None, checkpoint_input: bool = False) -> DataFrame:
    """Long-format panel forecast ``(entity, model, month, predicted_<target>)``.

    Plan: one-row facts (latest month before the exclusion, number of kept entities) in one job
    -> first-60 % statistics (the one pass over the whole history: a window and a codegen hash
    aggregate on the same entity partitioning) -> complete 6-month windows (only the window
    months are read further) -> z-scores -> dense ids -> ``k x f`` tensors with the target's
    statistics joined at entity grain -> model set in ``mapInPandas`` carrying those statistics
    -> de-normalise, clamp, round, label. ``checkpoint_input`` writes the dated panel to the
    shared checkpoint folder first; use it when ``history_df`` is derived from raw facts rather
    than read from a stored history table.
    """
    features = features or schemas.MONTHLY_FEATURES
    panel = windows.with_month_date(history_df)
    if checkpoint_input:
        checkpoint_dir(panel.sparkSession)
        panel = panel.checkpoint(eager=True)
    kept = filters.entity_exclude(panel, entity, exclude) if exclude else panel
    latest = panel.agg(F.max("date")).first()[0]
    if latest is None:
        raise ValueError("the history is empty")

    stats = normalize.fit_stats(kept, features + [target], ["year", "month"], entity=entity)
    complete = windows.panel_window(kept, entity, "date", k, latest=latest)
    z = normalize.normalize(complete, stats, features, entity=entity)
    # No entity with a complete input window: fail before scoring, as a one-row fact (a lazy
    # guard could be skipped, since AQE drops joins with an empty side without running the other).
    if complete.isEmpty():
        raise ValueError("no entity has a complete input window")
    ids = windows.entity_ids(kept, entity)
    tensor = windows.window_tensor(z.join(ids, entity), entity, "date", features, "entity_id")
    target_stats = stats.select(entity, F.col(f"{target}_mean").alias("target_mean"),
                                F.col(f"{target}_std").alias("target_std"))
    tensor = tensor.join(target_stats, entity)
    model_set = models if isinstance(models, scoring.ModelSet) else scoring.ModelSet.load(models)
    scores = scoring.good_rows(scoring.score(tensor, model_set, horizon, entity,
                                             carry=["target_mean", "target_std"]), on_error="raise")
    y = scores.withColumn("y", F.col("y") * F.col("target_std") + F.col("target_mean"))
    return forecast.long_forecast(y, F.lit(latest), entity, out=f"predicted_{target}")


def forecast_labels(panel_history: DataFrame, horizon: int = forecast.HORIZON,
                    style: str = "underscore") -> list[str]:
    """Labels of the forecast months (one-row fact: the latest month) for output names."""
    latest = panel_history.select(F.max(F.make_date("year", "month", F.lit(1)))).first()[0]
    months = [F.date_format(F.add_months(F.lit(latest), h), LABEL_FORMATS[style]) for h in
              range(1, horizon + 1)]
    return list(panel_history.sparkSession.range(1).select(*months).first())


def panel_skips(history_df: DataFrame, exclude: list | None = None, entity: str = schemas.ENTITY,
                k: int = 6) -> DataFrame:
    """The entities that the panel job leaves out, with the rows found in their window (P14)."""
    panel = windows.with_month_date(history_df)
    kept = filters.entity_exclude(panel, entity, exclude) if exclude else panel
    return windows.panel_skipped(kept, entity, "date", k, latest=windows.latest_month(panel))


def publish_panel_forecast(spark: SparkSession, history_path: str, models: dict | scoring.ModelSet, base: str,
                           exclude: list | None = None) -> str:
    """The panel forecast as a staged publication: it can be read as ``panel_forecast`` of the returned period only after it
    was written whole and verified; until then, or if the run is killed, the period's last one is read."""
    hist = spark.read.parquet(history_path)
    period = "_".join(forecast_labels(hist))
    staged = publish.stage(panel_forecast(hist, models, exclude=exclude), base, "panel_forecast")
    publish.publish(spark, staged, base, "panel_forecast", period)
    return period


def run_panel_forecast(spark: SparkSession, history_path: str, models: dict, out_dir: str,
                       exclude: list | None = None) -> str:
    hist = spark.read.parquet(history_path)
    labels = forecast_labels(hist)
    out = _some_rows(panel_forecast(hist, models, exclude=exclude))
    path = sinks.forecast_path(out_dir, "predictions", labels)
    sinks.write_csv(out, path, float_digits=2)
    sinks.write_csv(panel_skips(hist, exclude), sinks.forecast_path(out_dir, "skipped", labels))
    return path


# ---- test-data frames (bench and smoke) -----------------------------------------------------

def panel_forecast_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel job on the test tables (supplier-month panel, one supplier excluded)."""
    from panelcast.plans import models as stand_ins
    from panelcast.plans.queries import EXCLUDED
    from panelcast.sources import testviews as tv
    return panel_forecast(tv.entity_panel(spark, sf_dir), stand_ins.panel_models(),
                          exclude=EXCLUDED, checkpoint_input=True)
