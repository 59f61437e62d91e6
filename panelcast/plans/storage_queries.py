"""Registered queries of sources, sinks, guards and registries, over the whole test tables.

Each writes what it reads into a fresh folder of the shared checkpoint folder and reads it back.
"""

from __future__ import annotations

import dataclasses
import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast import schemas
from panelcast.operators import forecast, normalize, partials, registry, scoring, windows
from panelcast.plans import models
from panelcast.plans import queries as q
from panelcast.session import checkpoint_dir
from panelcast.sources import csv_folder, publish, readers, sinks
from panelcast.sources import testviews as tv

RUN_MONTHS = 6


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


# ---- roll-ups from stored partial sums ------------------------------------------------------

def month_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every month lands in two parts, the first of them twice: the merged roll-up has the full sums once."""
    path = _folder(spark, "month-partials")
    daily = tv.daily_obs(spark, sf_dir)
    early = daily.where(F.dayofmonth("date") <= 15)
    for batch, rows in (("a", early), ("b", daily.where(F.dayofmonth("date") > 15)), ("a", early)):
        partials.write_partials(partials.month_partials(rows, batch, exact_scale=tv.EXACT_SCALE), path)
    return partials.merged_rollup(partials.read_partials(spark, path), exact_scale=tv.EXACT_SCALE)


# ---- gaps -----------------------------------------------------------------------------------

def seeded_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel with months left out, months stored twice and entities with little history."""
    panel = windows.with_month_date(tv.entity_panel(spark, sf_dir))
    kept = panel.where(((F.col("district") + F.col("month")) % 7 != 0) | (F.col("district") % 4 == 0))
    kept = kept.where((F.col("district") % 10 != 7) | (F.col("year") * 12 + F.col("month") >= 2001 * 12 + 9))
    return kept.unionByName(kept.where((F.col("district") % 10 == 4) & (F.col("month") == 9)))


def entity_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.entity_runs(seeded_gaps(spark, sf_dir), schemas.ENTITY, RUN_MONTHS)


def latest_window_contiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last six months of the entities whose last six rows are consecutive months."""
    out = windows.latest_window(seeded_gaps(spark, sf_dir), q.SERIES_ORDER, RUN_MONTHS, entity=schemas.ENTITY,
                                require_contiguous=True)
    return q.as_text_dates(out)


def panel_readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = q._ctx(spark, sf_dir)
    return windows.panel_readiness(q._kept(ctx.panel), schemas.ENTITY, "date", q.WINDOW, ctx.latest)


# ---- numeric modes and parameters ------------------------------------------------------------

def norm_fit_float32(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = normalize.fit_stats(tv.entity_panel(spark, sf_dir), q.PANEL_COLS, q.SERIES_ORDER, entity=schemas.ENTITY,
                             numeric="float32")
    return st.select(schemas.ENTITY, *[q._r6(c).alias(c) for c in st.columns if c != schemas.ENTITY])


def params_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The global fit written as a parameter file and read back."""
    st = q._series_stats(tv.national_series(spark, sf_dir))
    path = _folder(spark, "params")
    mean, std = (F.array(*[F.col(f"{c}_{k}") for c in q.SERIES_COLS]).alias(k) for k in ("mean", "std"))
    st.select(mean, std).write.json(path)
    back = readers.read_params(spark, path, q.SERIES_COLS)
    return back.select(*[q._r6(c).alias(c) for c in back.columns])


# ---- CSV folders -----------------------------------------------------------------------------

CSV_SCHEMA = T.StructType([T.StructField("district", T.LongType()), T.StructField("year", T.IntegerType()),
                           T.StructField("month", T.IntegerType())]
                          + [T.StructField(c, T.DoubleType()) for c in schemas.MONTHLY_FEATURES])


def _csv_landing(spark: SparkSession, sf_dir: str) -> str:
    """The panel as CSV files of three layouts: as declared, in another order with a further column, and without one of
    the columns. Some lines of the first are cut short."""
    base = _folder(spark, "csv-landing")
    panel = tv.entity_panel(spark, sf_dir).select(*CSV_SCHEMA.names)
    kind = F.col("year") % 3
    text = [F.col(c).cast("string") for c in CSV_SCHEMA.names]
    cut = (F.col("district") % 10 == 1) & (F.col("month") == 2)
    line = F.when(cut, F.concat_ws(",", *text[:4])).otherwise(F.concat_ws(",", *text))
    one = panel.where(kind == 0).select(line.alias(",".join(CSV_SCHEMA.names)))
    two = panel.where(kind == 1).select(*reversed(CSV_SCHEMA.names[3:]), F.lit("x,y").alias("note"), *CSV_SCHEMA.names[:3])
    three = panel.where(kind == 2).drop("total_precipitation")
    one.write.option("header", True).option("sep", "\t").mode("append").csv(base)     # whole lines: one column
    for rows in (two, three):
        rows.write.option("header", True).mode("append").csv(base)
    return base


def csv_folder_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_folder.read_csv_folder(spark, _csv_landing(spark, sf_dir), CSV_SCHEMA)[0]


def csv_folder_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = csv_folder.read_csv_folder(spark, _csv_landing(spark, sf_dir), CSV_SCHEMA)[1]
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n_lines"))


# ---- publication and stored order ------------------------------------------------------------

def published_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dated output published as CSV, a later version of it, and one that was staged and never published: the
    second is read back."""
    base = _folder(spark, "published")
    panel = q.materialize(tv.entity_panel(spark, sf_dir))
    for rows in (panel.where("year < 2000"), panel):
        publish.publish(spark, publish.stage(rows, base, "panel", "csv"), base, "panel", "2001_11")
    publish.stage(panel.where("year = 2000"), base, "panel", "csv")
    back = publish.read_published(spark, base, "panel", "2001_11")
    return back.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in panel.schema.fields])


def history_stored_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history table as its sink stores it: rows and rows out of order by month."""
    path = _folder(spark, "history")
    h = schemas.schema_align(tv.entity_panel(spark, sf_dir), schemas.DISTRICT_HISTORY_COLUMNS)
    sinks.write_table(h, path, partition_by=["year", "month"], sort_within=["year", "month", schemas.ENTITY])
    rows = spark.read.parquet(path).select("year", "month", schemas.ENTITY, F.col("_metadata.file_path").alias("file"),
                                           F.col("_metadata.row_index").alias("at"))
    # A file holds at most what one task wrote of one month.
    by_file = Window.partitionBy("file").orderBy("at")
    rows = rows.withColumn("before", F.lag(schemas.ENTITY).over(by_file))
    return rows.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_rows"),
                                             F.count_if(F.col("before") > F.col(schemas.ENTITY)).alias("n_out_of_order"))


# ---- models ----------------------------------------------------------------------------------

@dataclasses.dataclass(frozen=True)
class BrokenModel:
    """Fails whenever it is asked."""

    def predict(self, x):
        raise ValueError("no such weights")


def score_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What failed while the panel was scored with a model set of which one model breaks."""
    model_set = scoring.ModelSet.load(models.panel_models() | {"broken": BrokenModel()})
    scores = scoring.score(q._tensor(q._ctx(spark, sf_dir)), model_set, forecast.HORIZON, schemas.ENTITY)
    return scoring.split_scores(scores)[1]


def score_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel scored with the models that load from a registry table: an earlier version and a damaged artefact are
    in it, too."""
    path = _folder(spark, "registry")
    current = models.panel_models()
    older = {n: dataclasses.replace(m, bias=(9.0, 9.0, 9.0)) for n, m in current.items()}
    damaged = registry.artefacts(spark, {"damaged": current["recency"]}).withColumn("digest", F.sha2(F.lit("x"), 256))
    for rows in (registry.artefacts(spark, older, 1), registry.artefacts(spark, current, 2), damaged):
        registry.register(rows, path)
    model_set = registry.model_set(spark.read.schema(registry.SCHEMA).parquet(path))
    scores = scoring.score(q._tensor(q._ctx(spark, sf_dir)), model_set, forecast.HORIZON, schemas.ENTITY)
    return scoring.good_rows(scores, on_error="raise").withColumn("y", q._r6("y"))


def queries() -> dict[str, q.Query]:
    return {f.__name__: f for f in (
        month_partials, entity_runs, latest_window_contiguous, panel_readiness, norm_fit_float32, params_file, csv_folder_rows,
        csv_folder_quarantine, published_panel, history_stored_order, score_errors, score_registry)}


cloudpickle.register_pickle_by_value(sys.modules[__name__])      # BrokenModel travels to the workers
