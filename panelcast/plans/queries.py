"""Registered queries: one per operator of the inventory, over the whole test tables.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame whose column names match the
oracle statement of the same key in :mod:`panelcast.plans.oracle`.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast import schemas
from panelcast.functions.rounding import fixed_text, round_half_even
from panelcast.functions.numeric import clip_cast as clip_cast_fn
from panelcast.operators import (filters, forecast, history, normalize, ordering, rollup, scoring, trees,
                                 validate, windows)
from panelcast.plans import models
from panelcast.session import checkpoint_dir
from panelcast.sources import payload
from panelcast.sources import testviews as tv

Query = Callable[[SparkSession, str], DataFrame]

KEYS = [schemas.ENTITY, "year", "month"]
AS_OF = "2001-09-15"
# History holds the months before 2001-06 and the disjoint batch all others; the overlapping batch
# begins with 2001-05, so its 2001-05 keys collide. History and either batch are the whole panel.
CUT = (2001, 6)
OPEN = (9999, 12)
OVERLAP = ((2001, 5), OPEN)


def as_text_dates(df: DataFrame) -> DataFrame:
    """Registered outputs carry dates as ISO ``yyyy-MM-dd`` text, the form the jobs write to CSV;
    it also keeps the cross-engine comparison independent of how each engine's client types a
    DATE (``datetime.date`` vs a timestamp)."""
    return df.withColumns({f.name: F.date_format(f.name, "yyyy-MM-dd") for f in df.schema.fields
                           if f.dataType.typeName() == "date"})


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# ---- roll-ups ---------------------------------------------------------------------------

def monthly_entity_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.monthly_rollup(tv.daily_obs(spark, sf_dir), exact_scale=tv.EXACT_SCALE)


def monthly_national_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.monthly_rollup(tv.daily_obs(spark, sf_dir), entity=None,
                                 exact_scale=tv.EXACT_SCALE)


def monthly_both_grains(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rollup.both_grains(tv.daily_obs(spark, sf_dir), exact_scale=tv.EXACT_SCALE)
    # The entity key is NULL on national rows; as text it compares the same in both engines.
    return out.withColumn(schemas.ENTITY, F.col(schemas.ENTITY).cast("string"))


def round_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = tv.table(spark, sf_dir, "lineitem")
    x = F.col("l_extendedprice") * F.col("l_discount")
    return (li.select("l_orderkey", "l_linenumber", x.alias("x"))
              .withColumn("r2", round_half_even("x", 2))
              .withColumn("r4", round_half_even("x", 4))
              .withColumn("txt", fixed_text("r2", 2)))


def period_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text_dates(filters.period_filter(tv.daily_obs(spark, sf_dir), "date", AS_OF))


# ---- payloads ---------------------------------------------------------------------------

def payload_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = tv.event_payload_text(spark, sf_dir)
    parsed = payload.parse_payloads(landed, "body", tv.EVENT_PAYLOAD_SCHEMA)
    return payload.payload_flatten(parsed, keys=[schemas.ENTITY, "request"],
                                   members=tv.EVENT_MEMBERS, time_as="time", parse_date=False)


def coverage_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = tv.order_payloads(spark, sf_dir)
    return payload.coverage_missing(tv.customer_dim(spark, sf_dir), payloads)


# ---- history ----------------------------------------------------------------------------

def _district_history(spark: SparkSession, sf_dir: str, reuse: bool = True) -> DataFrame:
    h = schemas.schema_align(tv.entity_panel(spark, sf_dir), schemas.DISTRICT_HISTORY_COLUMNS)
    return materialize(h) if reuse else h


def schema_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    legacy = (tv.entity_panel(spark, sf_dir)
                .drop(schemas.DISTRICT_TARGET)
                .withColumnsRenamed({v: k for k, v in schemas.LEGACY_RENAMES.items()})
                .withColumn("index", F.lit(None).cast("long")))
    return schemas.schema_align(legacy, schemas.DISTRICT_HISTORY_COLUMNS,
                                renames=schemas.LEGACY_RENAMES,
                                add_missing={schemas.DISTRICT_TARGET: T.DoubleType()})


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = _district_history(spark, sf_dir)
    return history.duplicate_keys(h.filter(tv.within(*OVERLAP)), h.filter(tv.before(*CUT)), KEYS)


def _cases(spark: SparkSession, sf_dir: str, op) -> DataFrame:
    h = _district_history(spark, sf_dir)
    base = h.filter(tv.before(*CUT))
    disjoint = h.filter(tv.within(CUT, OPEN))
    overlap = h.filter(tv.within(*OVERLAP))
    return (op(base, disjoint).withColumn("scenario", F.lit("disjoint"))
            .unionByName(op(base, overlap).withColumn("scenario", F.lit("overlap"))))


def append_all_or_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cases(spark, sf_dir, lambda h, b: history.append_all_or_nothing(h, b, KEYS))


def append_new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cases(spark, sf_dir, lambda h, b: history.append_new_keys(h, b, KEYS))


def append_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _series(spark, sf_dir)
    base = s.filter(tv.before(*CUT))
    # A new monthly batch arrives without its target (the target is filled later).
    batch = s.withColumn(schemas.SERIES_TARGET, F.lit(None).cast("double"))
    fresh = batch.filter(tv.within(CUT, OPEN))
    stored = batch.filter(tv.within(*OVERLAP))
    feats = schemas.MONTHLY_FEATURES
    return (history.append_if_absent(base, fresh, feats, ["year", "month"]).withColumn("scenario", F.lit("new"))
            .unionByName(history.append_if_absent(base, stored, feats, ["year", "month"])
                         .withColumn("scenario", F.lit("present"))))


def merge_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tv.national_series(spark, sf_dir)


def history_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = _district_history(spark, sf_dir, reuse=False)
    order = [F.col(k).asc_nulls_last() for k in KEYS]
    return ordering.global_index(h, order, "pos")


def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = tv.entity_panel(spark, sf_dir)
    seeded = panel.withColumn("year", F.when(F.col("month") == 12, F.lit(None)).otherwise(F.col("year")))
    required = ["year", "month", schemas.SERIES_TARGET] + schemas.MONTHLY_FEATURES
    return validate.validation_report(seeded, required, ["year", "month"])


# ---- normalisation and windows -----------------------------------------------------------

SERIES_ORDER = ["year", "month"]
SERIES_COLS = schemas.MONTHLY_FEATURES + [schemas.SERIES_TARGET]
PANEL_COLS = schemas.MONTHLY_FEATURES + [schemas.DISTRICT_TARGET]
# The excluded entity of the panel job (the reference drops one district by name).
EXCLUDED = [5]
WINDOW = 6


def _r6(c):
    return round_half_even(c, 6)


def _series_stats(series: DataFrame) -> DataFrame:
    return normalize.fit_stats(series, SERIES_COLS, SERIES_ORDER)


def global_norm_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = _series_stats(tv.national_series(spark, sf_dir))
    return st.select(*[_r6(c).alias(c) for c in st.columns])


def latest_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.latest_window(tv.national_series(spark, sf_dir), SERIES_ORDER, 12)


def series_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = _series(spark, sf_dir)
    win = windows.latest_window(series, SERIES_ORDER, 12)
    z = normalize.normalize(win, _series_stats(series), schemas.MONTHLY_FEATURES)
    return z.select("year", "month", "pos", *[_r6(f).alias(f) for f in schemas.MONTHLY_FEATURES])


def _panel(spark: SparkSession, sf_dir: str, reuse: bool = True) -> DataFrame:
    """The dated supplier-month panel. With ``reuse`` (several consumers) it is checkpointed once:
    stats, windows, ids and the latest month then read this small table instead of each
    re-aggregating lineitem (the forecast job reads a stored history table the same way)."""
    panel = windows.with_month_date(tv.entity_panel(spark, sf_dir))
    return materialize(panel) if reuse else panel


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(tv.national_series(spark, sf_dir))


def _kept(panel: DataFrame) -> DataFrame:
    return filters.entity_exclude(panel, schemas.ENTITY, EXCLUDED)


@dataclass
class PanelCtx:
    """The checkpointed panel and its one-row facts, fetched together in one job: the latest
    month of the whole panel (before the exclusion) and the number of kept entities."""
    panel: DataFrame
    latest: dt.date
    n_kept: int


def _ctx(spark: SparkSession, sf_dir: str) -> PanelCtx:
    panel = _panel(spark, sf_dir)
    kept_key = F.when(~F.col(schemas.ENTITY).isin(EXCLUDED), F.col(schemas.ENTITY))
    facts = panel.agg(F.max("date").alias("latest"), F.count_distinct(kept_key).alias("n")).first()
    return PanelCtx(panel, facts["latest"], facts["n"])


def _ids(ctx: PanelCtx) -> DataFrame:
    return windows.entity_ids(_kept(ctx.panel), schemas.ENTITY)


def _entity_stats(panel: DataFrame) -> DataFrame:
    return normalize.fit_stats(_kept(panel), PANEL_COLS, SERIES_ORDER, entity=schemas.ENTITY)


def _complete(ctx: PanelCtx) -> DataFrame:
    # The latest month comes from the whole panel, before the exclusion.
    return windows.panel_window(_kept(ctx.panel), schemas.ENTITY, "date", WINDOW, latest=ctx.latest)


def _normalized_window(ctx: PanelCtx) -> DataFrame:
    return normalize.normalize(_complete(ctx), _entity_stats(ctx.panel), schemas.MONTHLY_FEATURES,
                               entity=schemas.ENTITY)


def entity_norm_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = _entity_stats(_panel(spark, sf_dir, reuse=False))
    return st.select(schemas.ENTITY, *[_r6(c).alias(c) for c in st.columns if c != schemas.ENTITY])


def panel_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text_dates(windows.panel_window(_panel(spark, sf_dir), schemas.ENTITY, "date", WINDOW))


def panel_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = _ctx(spark, sf_dir)
    return windows.panel_skipped(_kept(ctx.panel), schemas.ENTITY, "date", WINDOW, latest=ctx.latest)


def entity_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text_dates(_complete(_ctx(spark, sf_dir)))


def entity_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ids(_ctx(spark, sf_dir))


def panel_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = _normalized_window(_ctx(spark, sf_dir))
    return z.select(schemas.ENTITY, "year", "month",
                    *[_r6(f).alias(f) for f in schemas.MONTHLY_FEATURES])


def _tensor(ctx: PanelCtx) -> DataFrame:
    z = _normalized_window(ctx).join(_ids(ctx), schemas.ENTITY)
    return windows.window_tensor(z, schemas.ENTITY, "date", schemas.MONTHLY_FEATURES, "entity_id")


def window_tensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tensor(_ctx(spark, sf_dir))
    rows = t.select(schemas.ENTITY, F.posexplode("tensor").alias("t", "row"))
    return rows.select(schemas.ENTITY, "t", F.posexplode("row").alias("f", "value")).withColumn(
        "value", _r6("value"))


def flat_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tensor(_ctx(spark, sf_dir))
    width = WINDOW * len(schemas.MONTHLY_FEATURES)
    entries = windows.sparse_flat_entries(windows.flat_window("tensor"), "entity_id", width)
    return (t.select(schemas.ENTITY, F.inline(entries))
             .withColumn("value", _r6("value")))


def clip_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = tv.entity_panel(spark, sf_dir)
    n = panel.select(F.count_distinct(schemas.ENTITY)).scalar()
    x = F.col("total_precipitation") / F.lit(10000.0) - F.lit(5.0)
    return (panel.select(schemas.ENTITY, "year", "month", x.alias("x"))
                 .withColumn("clipped", clip_cast_fn("x", n)))


# ---- scoring and forecast output -----------------------------------------------------------

def _latest(df: DataFrame):
    return F.lit(windows.latest_month(df))


def _panel_scores(ctx: PanelCtx) -> DataFrame:
    t = _tensor(ctx)
    return scoring.linear_scores(t, models.panel_models(), F.flatten("tensor"), [schemas.ENTITY])


def _panel_forecast(ctx: PanelCtx) -> DataFrame:
    return normalize.denormalize(_panel_scores(ctx), _entity_stats(ctx.panel), "y",
                                 schemas.DISTRICT_TARGET, entity=schemas.ENTITY)


def forecast_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text_dates(forecast.forecast_months(_panel(spark, sf_dir, reuse=False), "date",
                                                  forecast.HORIZON,
                                                  entity=schemas.ENTITY))


def score_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _panel_scores(_ctx(spark, sf_dir)).withColumn("y", _r6("y"))


def score_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tensor(_ctx(spark, sf_dir))
    model_set = scoring.ModelSet.load(models.panel_models())
    out = scoring.good_rows(scoring.score(t, model_set, forecast.HORIZON, schemas.ENTITY))
    return out.withColumn("y", _r6("y"))


def score_tabular(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = _ctx(spark, sf_dir)
    t = _tensor(ctx).withColumn("flat", windows.flat_window("tensor", len(schemas.MONTHLY_FEATURES)))
    effects = models.tabular_effects(_ids(ctx))
    out = scoring.good_rows(scoring.score_tabular(t, models.tabular_model(), effects,
                                                  forecast.HORIZON, schemas.ENTITY))
    return out.withColumn("y", _r6("y"))


def score_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tree ensembles on the flat window and the one-hot entity, walked in the JVM; the model makes the round trip
    through its columnar form."""
    path = f"{checkpoint_dir(spark)}/trees-{uuid.uuid4().hex}"
    trees.save_ensemble(spark.createDataFrame(models.tree_nodes(), trees.NODE_SCHEMA), path)
    t = _tensor(_ctx(spark, sf_dir)).withColumn("flat", windows.flat_window("tensor", len(schemas.MONTHLY_FEATURES)))
    out = trees.tree_scores(t, trees.load_ensemble(spark, path), WINDOW * len(schemas.MONTHLY_FEATURES), [schemas.ENTITY])
    return out.withColumn("y", _r6("y"))


def denormalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _panel_forecast(_ctx(spark, sf_dir)).withColumn("y", _r6("y"))


def long_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = _ctx(spark, sf_dir)
    return forecast.long_forecast(_panel_forecast(ctx), F.lit(ctx.latest), schemas.ENTITY)


def series_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = windows.with_month_date(_series(spark, sf_dir))
    stats = normalize.stats_row(_series_stats(series))
    win = windows.latest_window(series, SERIES_ORDER, models.SERIES_MONTHS)
    z = normalize.normalize(win, stats, schemas.MONTHLY_FEATURES)
    t = windows.window_tensor(z, None, "date", schemas.MONTHLY_FEATURES)
    scores = scoring.linear_scores(t, models.series_models(), F.flatten("tensor"), [])
    y = normalize.denormalize(scores, stats, "y", schemas.SERIES_TARGET)
    return as_text_dates(forecast.series_forecast(y, _latest(series)))


def series_score_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The single-series job with its model set scored in Python workers (``mapInPandas``)."""
    from panelcast.plans import jobs
    out = jobs.series_forecast(_series(spark, sf_dir), models.series_models(), scorer="workers")
    return as_text_dates(out)


def mae_by_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backtest from the month three months before the latest: persistence and 3-month mean."""
    ctx = _ctx(spark, sf_dir)
    panel = ctx.panel
    origin = F.add_months(F.lit(ctx.latest), -forecast.HORIZON)
    target = schemas.DISTRICT_TARGET
    persistence = panel.filter(F.col("date") == origin).select(
        schemas.ENTITY, F.lit("persistence").alias("model"), F.col(target).alias("y"))
    recent = panel.filter(F.col("date").between(F.add_months(origin, -2), origin))
    mean3 = recent.groupBy(schemas.ENTITY).agg(F.avg(target).alias("y")).select(
        schemas.ENTITY, F.lit("mean3").alias("model"), "y")
    steps = F.explode(F.sequence(F.lit(1), F.lit(forecast.HORIZON))).alias("horizon")
    pred = (persistence.unionByName(mean3).select("*", steps)
            .withColumn("date", F.add_months(origin, F.col("horizon"))))
    actual = panel.select(schemas.ENTITY, "date", F.col(target).alias("actual"))
    m = forecast.mae_by_horizon(pred, actual, [schemas.ENTITY, "date"])
    return m.select("model_name", *[_r6(c).alias(c) for c in m.columns if c != "model_name"])


# ---- option paths --------------------------------------------------------------------------

def nation_monthly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roll-up to a dimension attribute (supplier -> nation), through supplier-month partials."""
    return rollup.monthly_rollup_by(tv.daily_obs(spark, sf_dir), tv.supplier_nation(spark, sf_dir),
                                    schemas.ENTITY, "n_name", exact_scale=tv.EXACT_SCALE)


def latest_window_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 12 months of every supplier (per-entity top-k, ``pos`` 0 = oldest)."""
    return as_text_dates(windows.latest_window(_panel(spark, sf_dir, reuse=False), SERIES_ORDER, 12,
                                               entity=schemas.ENTITY, min_rows=False))


def _seeded_target_nulls(panel: DataFrame) -> DataFrame:
    # Every March target is missing: inside the 60 % prefix for most suppliers.
    return panel.withColumn(schemas.DISTRICT_TARGET, F.when(F.col("month") == 3, F.lit(None))
                            .otherwise(F.col(schemas.DISTRICT_TARGET)))


def _norm_fit_nulls(spark: SparkSession, sf_dir: str, nulls: str) -> DataFrame:
    panel = _seeded_target_nulls(tv.entity_panel(spark, sf_dir))
    st = normalize.fit_stats(panel, [schemas.DISTRICT_TARGET], SERIES_ORDER, entity=schemas.ENTITY,
                             nulls=nulls)
    return st.select(schemas.ENTITY, *[_r6(c).alias(c) for c in st.columns if c != schemas.ENTITY])


def norm_fit_nulls_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _norm_fit_nulls(spark, sf_dir, "skip")


def norm_fit_nulls_propagate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _norm_fit_nulls(spark, sf_dir, "propagate")


def panel_window_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completeness by distinct months on a panel whose latest month is stored twice."""
    ctx = _ctx(spark, sf_dir)
    panel, latest = ctx.panel, ctx.latest
    doubled = panel.unionByName(panel.filter(F.col("date") == F.lit(latest)))
    return as_text_dates(windows.panel_window(doubled, schemas.ENTITY, "date", WINDOW,
                                              distinct_months=True, latest=latest))


def queries() -> dict[str, Query]:
    return {
        "monthly_entity_rollup": monthly_entity_rollup,
        "monthly_national_rollup": monthly_national_rollup,
        "monthly_both_grains": monthly_both_grains,
        "round_policy": round_policy,
        "period_filter": period_filter,
        "payload_flatten": payload_flatten,
        "coverage_missing": coverage_missing,
        "schema_align": schema_align,
        "duplicate_keys": duplicate_keys,
        "append_if_absent": append_if_absent,
        "append_all_or_nothing": append_all_or_nothing,
        "append_new_keys": append_new_keys,
        "merge_target": merge_target,
        "history_sorted": history_sorted,
        "validation_report": validation_report,
        "global_norm_fit": global_norm_fit,
        "entity_norm_fit": entity_norm_fit,
        "latest_window": latest_window,
        "series_normalize": series_normalize,
        "panel_window": panel_window,
        "panel_skipped": panel_skipped,
        "entity_exclude": entity_exclude,
        "entity_ids": entity_ids,
        "panel_normalize": panel_normalize,
        "window_tensor": window_tensor,
        "flat_features": flat_features,
        "clip_cast": clip_cast,
        "forecast_months": forecast_months,
        "score_linear": score_linear,
        "score_models": score_models,
        "score_tabular": score_tabular,
        "score_trees": score_trees,
        "denormalize": denormalize,
        "long_forecast": long_forecast,
        "series_forecast": series_forecast,
        "series_score_models": series_score_models,
        "mae_by_horizon": mae_by_horizon,
        "nation_monthly_rollup": nation_monthly_rollup,
        "latest_window_entity": latest_window_entity,
        "norm_fit_nulls_skip": norm_fit_nulls_skip,
        "norm_fit_nulls_propagate": norm_fit_nulls_propagate,
        "panel_window_distinct": panel_window_distinct,
    }


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel forecast job end to end (model set scored in ``mapInPandas``)."""
    from panelcast.plans import jobs
    return jobs.panel_forecast_frame(spark, sf_dir)
