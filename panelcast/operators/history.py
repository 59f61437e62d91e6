"""Idempotent appends to history tables, duplicate-key reports, target merge, history order.

Guards are lazy: a collision is an uncorrelated ``EXISTS`` subquery inside the plan, evaluated
once at run time, so building the result needs no driver action and no cross join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _match(left: DataFrame, right: DataFrame, keys: list[str], null_safe: bool) -> Column:
    conds = [left[k].eqNullSafe(right[k]) if null_safe else left[k] == right[k] for k in keys]
    return reduce(lambda a, b: a & b, conds)


PERIOD_KEYS = ("year", "month")


def same_periods(history: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """History rows in the periods the batch touches, so a guard join never reads all history.

    The batch's distinct (year, month) pairs are bounded by the calendar (one for a monthly
    batch), so they are broadcast; on a history table partitioned by year and month the semi join
    also drives dynamic partition pruning of the scan. Keys without both period columns return
    ``history`` unchanged.
    """
    period = [k for k in PERIOD_KEYS if k in keys]
    if len(period) != len(PERIOD_KEYS):
        return history
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in period])
    months = batch.select(*period).where(known).distinct()
    # Plain equality on the period columns keeps them prunable; rows with a NULL period (which
    # only a NULL-safe key match can reach) come from a static filter instead.
    return (history.join(F.broadcast(months), list(period), "left_semi")
                   .unionByName(history.filter(~known)))


def duplicate_keys(batch: DataFrame, history: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of the two key sets. NULL matches NULL, as a pandas merge does."""
    b = batch.select(*keys)
    h = same_periods(history, batch, keys).select(*[F.col(k).alias(f"_h_{k}") for k in keys])
    cond = reduce(lambda a, c: a & c, [b[k].eqNullSafe(h[f"_h_{k}"]) for k in keys])
    return b.join(h, cond, "inner").select(*keys)


def rows_all_or_nothing(history: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The batch if none of its keys is stored, else no rows (what an append job writes)."""
    touched = same_periods(history, batch, keys)
    colliding = batch.join(touched, _match(batch, touched, keys, null_safe=True), "left_semi")
    return batch.filter(~colliding.exists())


def rows_new_keys(history: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The batch rows whose key is not stored (NULL-safe)."""
    touched = same_periods(history, batch, keys)
    return batch.join(touched, _match(batch, touched, keys, null_safe=True), "left_anti")


def rows_if_absent(history: DataFrame, batch: DataFrame, match_cols: list[str],
                   order: list[str]) -> DataFrame:
    """The batch unless its first row (by ``order``, its time columns) equals a stored row on ``match_cols``.

    Plain equality: a NULL never matches. The batch is one row per month in practice.
    """
    first = batch.orderBy(*order).limit(1).select(*match_cols)
    hit = history.join(first, _match(history, first, match_cols, null_safe=False), "left_semi")
    return batch.filter(~hit.exists())


def append_all_or_nothing(history: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Append the whole batch only if none of its keys is already stored; else keep history."""
    return history.unionByName(rows_all_or_nothing(history, batch, keys))


def append_new_keys(history: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Row-level variant: append only the batch rows whose key is new (NULL-safe)."""
    return history.unionByName(rows_new_keys(history, batch, keys))


def append_if_absent(history: DataFrame, batch: DataFrame, match_cols: list[str],
                     order: list[str]) -> DataFrame:
    """Append the batch unless its first row equals a stored row on ``match_cols``."""
    return history.unionByName(rows_if_absent(history, batch, match_cols, order))


def merge_target(series: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of a feature series and a target on ``keys``; unmatched targets stay NULL."""
    return series.join(target, keys, "left")
