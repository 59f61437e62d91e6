"""Input windows of the forecast jobs.

* ``latest_window``: the last ``k`` rows of a series (or of each entity). Per entity it is
  ``row_number() <= k``, which Spark plans as a partial group limit before the shuffle, so a hot
  entity ships only ``k`` rows per mapper. Without an entity it is a top-k (``orderBy().limit``),
  merged from per-partition top-k lists.
* ``panel_window``: rows in ``[max - (k-1) months, max]`` where ``max`` is the latest month of the
  whole panel (a one-row fact used as a literal), for entities with exactly ``k`` rows there.
* ``window_tensor``: the ``k x f`` array per entity; each group holds at most ``k`` rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.periods import month_start
from panelcast.operators.ordering import dense_ids
from panelcast.operators.validate import min_rows_guard


def with_month_date(df: DataFrame, name: str = "date") -> DataFrame:
    return df.withColumn(name, month_start("year", "month"))


def latest_window(df: DataFrame, order: list[str], k: int = 12, entity: str | None = None,
                  min_rows: bool = True, pos: str = "pos",
                  require_contiguous: bool = False) -> DataFrame:
    """The last ``k`` rows by ``order`` with ``pos`` 0..k-1 in ascending time.

    A single series with fewer than ``k`` rows fails at run time with ``min_rows``, as the single-series job requires;
    per entity, the entities with fewer rows are left out, and :func:`entity_runs` says why. The window is positional
    (no gap check) unless ``require_contiguous``: then a single series whose ``k`` rows (ordered by year and month) do
    not span exactly ``k`` consecutive months fails, and per entity only windows of ``k`` consecutive months stay.
    """
    desc = [F.col(c).desc() for c in order]
    if entity is None:
        src = df.filter(min_rows_guard(df, k, "rows for the input window").isNull()) if min_rows else df
        top = src.orderBy(*desc).limit(k)
        w = Window.orderBy(*[F.col(c).asc() for c in order])   # at most k rows
        out = top.withColumn(pos, F.row_number().over(w) - 1)
        if require_contiguous:
            ym = F.col("year") * 12 + F.col("month")
            span = Window.partitionBy()                          # the k window rows only
            out = (out.withColumn("_span", F.max(ym).over(span) - F.min(ym).over(span))
                      .withColumn("_months", F.size(F.collect_set(ym).over(span)))
                      .filter(F.assert_true((F.col("_span") == F.lit(k - 1)) & (F.col("_months") == F.lit(k)),
                                            F.lit("input window is not contiguous")).isNull())
                      .drop("_span", "_months"))
        return out
    w = Window.partitionBy(entity).orderBy(*desc)
    ranked = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k)
    whole = Window.partitionBy(entity)                          # at most k rows of each entity by now
    ranked = ranked.withColumn("_size", F.count(F.lit(1)).over(whole))
    if min_rows:
        ranked = ranked.where(F.col("_size") == k)
    if require_contiguous:
        ym = F.col("year") * 12 + F.col("month")
        ranked = (ranked.withColumn("_span", F.max(ym).over(whole) - F.min(ym).over(whole))
                        .withColumn("_months", F.size(F.collect_set(ym).over(whole)))
                        .where((F.col("_span") == F.col("_size") - 1) & (F.col("_months") == F.col("_size")))
                        .drop("_span", "_months"))
    return ranked.withColumn(pos, F.col("_size") - F.col("_rn")).drop("_rn", "_size")


def entity_runs(df: DataFrame, entity: str, k: int = 12) -> DataFrame:
    """Gaps and islands: every run of consecutive months of every entity, with what stands against an input window of
    ``k`` months that ends with it.

    ``entity, run`` (0 is the latest), ``first, last`` (months as year * 12 + month - 1), ``n_months, n_rows, gap`` (months
    missing before the next run; NULL for the latest) and ``state`` of the entity: ``short`` (fewer than ``k`` rows), ``repeated``
    (a month twice among its last ``k`` rows), ``gap`` (its latest run has fewer than ``k`` months) or ``ready``. Rows without
    entity, year or month belong to no run. One shuffle by entity: months are combined before it, so a hot
    entity carries one row per month.
    """
    ym = (F.col("year") * 12 + F.col("month") - 1).cast("int")
    months = (df.where(F.col(entity).isNotNull() & F.col("year").isNotNull() & F.col("month").isNotNull())
              .groupBy(entity, ym.alias("ym")).agg(F.count(F.lit(1)).alias("n")))
    by_time, whole = Window.partitionBy(entity).orderBy("ym"), Window.partitionBy(entity)
    from_end = Window.partitionBy(entity).orderBy(F.desc("ym"))
    rows = (months.withColumn("island", F.col("ym") - F.row_number().over(by_time))
            .withColumn("later", F.sum("n").over(from_end) - F.col("n"))      # rows in later months
            .withColumn("total", F.sum("n").over(whole))
            .withColumn("doubled", F.max(F.when((F.col("later") < k) & (F.col("n") > 1), 1).otherwise(0)).over(whole)))
    runs = rows.groupBy(entity, "island").agg(
        F.min("ym").alias("first"), F.max("ym").alias("last"), F.count(F.lit(1)).alias("n_months"), F.sum("n").alias("n_rows"),
        F.max("total").alias("total"), F.max("doubled").alias("doubled"))
    ordered = Window.partitionBy(entity).orderBy(F.desc("last"))
    latest_months = F.first("n_months").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    state = (F.when(F.col("total") < k, "short").when(F.col("doubled") == 1, "repeated")
             .when(F.col("latest_months") < k, "gap").otherwise("ready"))
    return (runs.withColumn("run", F.row_number().over(ordered) - 1)
            .withColumn("gap", F.lag("first").over(ordered) - F.col("last") - 1)
            .withColumn("latest_months", latest_months)
            .select(entity, "run", "first", "last", "n_months", "n_rows", "gap", state.alias("state")))


def latest_month(df: DataFrame, date: str = "date") -> dt.date | None:
    """The latest month of ``df``: a one-row fact fetched once, then used as a literal so window
    bounds reach the scan as pushed filters (and prune year/month partitions)."""
    return df.select(F.max(date)).first()[0]


def _window_bounds(latest: dt.date, k: int) -> tuple[Column, Column]:
    return F.add_months(F.lit(latest), -(k - 1)), F.lit(latest)


def in_panel_window(df: DataFrame, date: str = "date", k: int = 6,
                    max_from: DataFrame | None = None, latest: dt.date | None = None) -> DataFrame:
    """Rows whose month lies in the ``k`` months ending at the panel's latest month.

    ``max_from`` is the frame the latest month is taken from; pass the panel *before* entity
    exclusion so the exclusion cannot move the window. ``latest`` skips that lookup.
    """
    if latest is None:
        latest = latest_month(max_from if max_from is not None else df, date)
    first, last = _window_bounds(latest, k)
    return df.filter(F.col(date).between(first, last))


def panel_window(df: DataFrame, entity: str, date: str = "date", k: int = 6,
                 max_from: DataFrame | None = None, distinct_months: bool = False,
                 latest: dt.date | None = None) -> DataFrame:
    """Window rows of entities that are complete: exactly ``k`` rows (or ``k`` distinct months).
    Rows without an entity belong to none."""
    rows = in_panel_window(df, date, k, max_from, latest).where(F.col(entity).isNotNull())
    w = Window.partitionBy(entity)
    n = F.size(F.collect_set(date).over(w)) if distinct_months else F.count(F.lit(1)).over(w)
    return rows.withColumn("_n", n).filter(F.col("_n") == k).drop("_n")


def panel_skipped(df: DataFrame, entity: str, date: str = "date", k: int = 6,
                  max_from: DataFrame | None = None, latest: dt.date | None = None) -> DataFrame:
    """Entities of ``df`` whose window does not hold exactly ``k`` rows, with the count found
    (0 for entities without a row in the window)."""
    counts = in_panel_window(df, date, k, max_from, latest).groupBy(entity).agg(
        F.count(F.lit(1)).alias("n_rows"))
    entities = df.select(entity).where(F.col(entity).isNotNull()).distinct()
    return (entities.join(counts, entity, "left")
                    .select(entity, F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"))
                    .filter(F.col("n_rows") != k))


def panel_readiness(df: DataFrame, entity: str, date: str = "date", k: int = 6, latest: dt.date | None = None) -> DataFrame:
    """One row: ``entities``, ``complete`` (those with exactly ``k`` rows in the window) and ``ready``, whether any is: the
    precondition of the panel job as a table."""
    counts = in_panel_window(df, date, k, None, latest).groupBy(entity).agg(F.count(F.lit(1)).alias("n"))
    counts = df.select(entity).where(F.col(entity).isNotNull()).distinct().join(counts, entity, "left")
    return counts.agg(F.count(F.lit(1)).alias("entities"), F.count_if(F.col("n") == k).alias("complete"),
                      F.coalesce(F.max(F.col("n") == k), F.lit(False)).alias("ready"))


def entity_ids(df: DataFrame, entity: str, name: str = "entity_id") -> DataFrame:
    """Dense 0-based ids over the sorted distinct entities (see ``ordering.dense_ids``)."""
    return dense_ids(df, entity, name)


def window_tensor(df: DataFrame, entity: str | None, date: str, features: list[str],
                  id_col: str | None = None, name: str = "tensor") -> DataFrame:
    """Per entity (or for the one series when ``entity`` is None): ``k x (f [+ 1])`` rows sorted
    by date; the id is appended to every row."""
    cols = [F.col(f).cast("double") for f in features]
    if id_col:
        cols.append(F.col(id_col).cast("double"))
    rows = F.sort_array(F.collect_list(F.struct(F.col(date).alias("d"), F.array(*cols).alias("v"))))
    # Group by the entity alone (the id is a function of it, carried with any_value), so an input
    # already hash-partitioned by entity is not shuffled again.
    carried = [F.any_value(id_col).alias(id_col)] if id_col else []
    keys = [entity] if entity else []
    out = df.groupBy(*keys).agg(*carried, F.transform(rows, lambda r: r["v"]).alias(name))
    return out.select(*keys, *([id_col] if id_col else []), name)


def flat_window(tensor: str = "tensor", n_features: int = 5) -> Column:
    """Flatten ``k x f`` to ``k*f`` values, dropping the trailing id column of each row."""
    return F.flatten(F.transform(F.col(tensor), lambda r: F.slice(r, 1, n_features)))


def sparse_flat_entries(flat: Column, id_col: str, width: int) -> Column:
    """(pos, value) entries of ``flat ++ one_hot(id)``: every dense value, plus the single 1.0
    of the one-hot block at ``width + id``. The one-hot block stays sparse, so the output grows
    with entities, not with entities squared."""
    dense = F.transform(flat, lambda v, i: F.struct(i.alias("pos"), v.alias("value")))
    hot = F.array(F.struct((F.lit(width) + F.col(id_col)).alias("pos"), F.lit(1.0).alias("value")))
    return F.concat(dense, hot)
