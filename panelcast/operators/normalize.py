"""Normalisation: fit mean/std on each entity's first 60 % of rows, apply and invert z-scores.

Plan shape: one window partitioned by entity (row number and entity size over the same spec, so
one sort) feeding a group-by on the same key, so no second shuffle. An entity-month panel has at
most one row per month per entity, so no window partition grows with the number of rows. The
global fit (``entity=None``) finds the cut-off by position: rows are range-sorted, the partitions' row
counts give every row its place, and what lies before the cut-off is aggregated with map-side
combining. No task sees more rows than its range.

``numeric="float32"`` rounds the values to single precision before the fit and the statistics after it, as
the panel job keeps them (features stay double: a z-score then mixes both). Sums are double, so a
value is off by at most 2^-24 of itself before and once more after the fit: a mean of n values v by at most
2^-23 * mean(|v|), a std s by at most 2^-23 * s + 2^-24 * max|v|.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.numeric import STD_FLOOR, std_floor, unzscore, zscore
from panelcast.operators.ordering import global_index

TRAIN_FRAC = 0.6


def fit_stats(df: DataFrame, features: list[str], order: list[str], entity: str | None = None,
              train_frac: float = TRAIN_FRAC, nulls: str = "propagate",
              floor: float = STD_FLOOR, numeric: str = "double") -> DataFrame:
    """Per-entity ``{f}_mean`` and population ``{f}_std`` over the first ``floor(frac * n)`` rows.

    ``nulls="propagate"`` (NumPy behaviour) makes both NULL when a value in the prefix is NULL;
    ``"skip"`` ignores NULLs. ``numeric`` is ``"double"`` or ``"float32"`` (see above). A std below ``floor`` becomes 1.0. Entities whose prefix is empty
    get NULL statistics; rows without an entity belong to none.
    """
    if nulls not in ("propagate", "skip"):
        raise ValueError("nulls must be 'propagate' or 'skip'")
    if numeric not in ("double", "float32"):
        raise ValueError("numeric must be 'double' or 'float32'")
    kept = "float" if numeric == "float32" else "double"
    part = [entity] if entity else []
    values = [F.col(f).cast(kept).cast("double").alias(f) for f in features]
    if entity:
        df = df.where(F.col(entity).isNotNull())
        w = Window.partitionBy(*part).orderBy(*order)
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        ranked = df.select(*part, *values,
                           F.row_number().over(w).alias("_rn"),
                           F.count(F.lit(1)).over(whole).alias("_n"))
        train = F.col("_rn") <= F.floor(F.lit(float(train_frac)) * F.col("_n"))
    else:
        placed = global_index(df.select(*order, *values), order, "_pos")
        n = placed.count()                               # a one-row fact, from the stored rows
        ranked, train = placed, F.col("_pos") < math.floor(train_frac * n)
    aggs = [F.count_if(train).alias("_t")]
    for f in features:
        v = F.when(train, F.col(f))
        aggs += [F.avg(v).alias(f"_m_{f}"), F.stddev_pop(v).alias(f"_s_{f}"),
                 F.count(v).alias(f"_c_{f}")]
    stats = ranked.groupBy(*part).agg(*aggs)
    out = [F.col(p) for p in part]
    for f in features:
        mean, std = F.col(f"_m_{f}"), std_floor(F.col(f"_s_{f}"), floor)
        if nulls == "propagate":
            complete = F.col(f"_c_{f}") == F.col("_t")
            mean, std = F.when(complete, mean), F.when(complete, std)
        out += [mean.cast(kept).cast("double").alias(f"{f}_mean"), std.cast(kept).cast("double").alias(f"{f}_std")]
    return stats.select(*out)


def stats_row(stats: DataFrame) -> dict:
    """The single statistics row of a global fit, fetched once (a one-row fact)."""
    row = stats.first()
    if row is None:
        raise ValueError("no statistics row")
    return row.asDict()


def _stat_lookup(df: DataFrame, stats: DataFrame | dict, entity: str | None):
    """Return (frame, getter) where getter(name) is the stat column for each row.

    With an entity the stats are joined on it (the planner picks broadcast or a shuffle join from
    the size). Without one the stats are a single row of ``2 x features`` numbers (the global
    parameter vector), applied as literals; pass the row from :func:`stats_row` to fetch it once
    for several steps.
    """
    if entity:
        return df.join(stats, entity, "inner"), F.col
    values = stats if isinstance(stats, dict) else stats_row(stats)
    return df, lambda name: F.lit(values[name]).cast("double")


def normalize(df: DataFrame, stats: DataFrame | dict, features: list[str], entity: str | None = None,
              prefix: str = "") -> DataFrame:
    """Replace each feature by its z-score (``prefix`` renames the outputs)."""
    joined, stat = _stat_lookup(df, stats, entity)
    z = {f"{prefix}{f}": zscore(F.col(f), stat(f"{f}_mean"), stat(f"{f}_std")) for f in features}
    keep = [c for c in df.columns if c not in features or prefix]
    return joined.select(*keep, *[v.alias(k) for k, v in z.items()])


def denormalize(df: DataFrame, stats: DataFrame | dict, value: str, target: str,
                entity: str | None = None) -> DataFrame:
    """``value * std + mean`` of the target's statistics."""
    joined, stat = _stat_lookup(df, stats, entity)
    out: Column = unzscore(F.col(value), stat(f"{target}_mean"), stat(f"{target}_std"))
    return joined.select(*[c for c in df.columns if c != value], out.alias(value))
