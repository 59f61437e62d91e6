"""Monthly roll-ups of daily observations (entity-month and national-month grains).

Plan shape: one hash aggregate at the (entity, year, month) grain with map-side partial
aggregation, so a hot entity is combined on every mapper before the shuffle. Both grains come
from one expansion of the daily rows (``GROUPING SETS``); means are ``sum / count``, so the national
mean is the mean over *daily rows*, not over rounded entity rows. With ``exact_scale`` the sums are
exact ``bigint`` sums of fixed-point units, so no order of summation changes a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.numeric import exact_cents
from panelcast.functions.rounding import round_half_even
from panelcast.schemas import ENTITY, ROLLUP_RULES

SECONDS_PER_HOUR = 3600.0


def _prepare(df: DataFrame, entity: str | None, date: str) -> DataFrame:
    # pandas/Dask group-by drops NULL keys; Spark keeps them as a group, so drop them first.
    keep = F.col(date).isNotNull()
    if entity:
        keep = keep & F.col(entity).isNotNull()
    return (df.filter(keep)
              .withColumn("year", F.year(date))
              .withColumn("month", F.month(date)))


def _partial_aggs(rules: dict, exact_scale: int | None, row_count: str | None) -> list[Column]:
    aggs = []
    for src, (_, how) in rules.items():
        value = exact_cents(src, exact_scale) if exact_scale is not None else F.col(src)
        aggs.append(F.sum(value).alias(f"_s_{src}"))
        if how == "mean":
            aggs.append(F.count(src).alias(f"_n_{src}"))
    if row_count:
        aggs.append(F.count(F.lit(1)).alias("_rows"))
    return aggs


def _reaggregate(rules: dict, row_count: str | None) -> list[Column]:
    aggs = []
    for src, (_, how) in rules.items():
        aggs.append(F.sum(f"_s_{src}").alias(f"_s_{src}"))
        if how == "mean":
            aggs.append(F.sum(f"_n_{src}").alias(f"_n_{src}"))
    if row_count:
        aggs.append(F.sum("_rows").alias("_rows"))
    return aggs


def _finalize(partials: DataFrame, keys: list[str], rules: dict, exact_scale: int | None,
              hours: tuple[str, ...], digits: int | None, row_count: str | None) -> DataFrame:
    out = [F.col(k) for k in keys]
    for src, (name, how) in rules.items():
        s = F.col(f"_s_{src}").cast("double")
        if exact_scale is not None:
            s = s / F.lit(float(10 ** exact_scale))
        if how == "mean":
            value = s / F.col(f"_n_{src}")          # NULL when every value was NULL
        else:
            value = F.coalesce(s, F.lit(0.0))      # pandas: the sum of an all-NULL group is 0
        if src in hours:
            value = value / F.lit(SECONDS_PER_HOUR)
        if digits is not None:
            value = round_half_even(value, digits)
        out.append(value.alias(name))
    if row_count:
        out.append(F.col("_rows").cast("double").alias(row_count))
    return partials.select(*out)


def monthly_rollup(df: DataFrame, entity: str | None = ENTITY, date: str = "date",
                   rules: dict | None = None, hours: tuple[str, ...] = ("sunshine",),
                   digits: int | None = 2, exact_scale: int | None = None,
                   row_count: str | None = None) -> DataFrame:
    """Roll daily rows up to (entity, year, month), or to (year, month) with ``entity=None``.

    ``rules`` maps a daily measure to ``(output name, "mean" | "sum")``; sums listed in ``hours``
    are seconds converted to hours. Every measure is rounded NumPy-style to ``digits``.
    ``row_count`` adds the number of daily rows per group as a double column.
    """
    rules = rules or ROLLUP_RULES
    keys = ([entity] if entity else []) + ["year", "month"]
    partials = _prepare(df, entity, date).groupBy(*keys).agg(
        *_partial_aggs(rules, exact_scale, row_count))
    return _finalize(partials, keys, rules, exact_scale, hours, digits, row_count)


def both_grains(df: DataFrame, entity: str = ENTITY, date: str = "date", rules: dict | None = None,
                hours: tuple[str, ...] = ("sunshine",), digits: int | None = 2,
                exact_scale: int | None = None, row_count: str | None = None) -> DataFrame:
    """Entity-month and national-month rows in one plan, flagged by ``national`` (0 or 1).

    One scan and one shuffle: ``GROUPING SETS`` expands each daily row to both grains, and the map side
    combines them, so the shuffle carries one row per key and mapper. ``grouping`` tells the national
    total apart from a row without an entity, which counts for the nation only.
    """
    rules = rules or ROLLUP_RULES
    keys = [entity, "year", "month"]
    rows = _prepare(df, None, date)
    grains = rows.groupingSets([[rows[k] for k in keys], [rows["year"], rows["month"]]], *[rows[k] for k in keys]).agg(
        *_partial_aggs(rules, exact_scale, row_count), F.grouping(entity).cast("int").alias("national"))
    grains = grains.where((F.col("national") == 1) | F.col(entity).isNotNull())
    return _finalize(grains, [*keys, "national"], rules, exact_scale, hours, digits, row_count)


def monthly_rollup_by(df: DataFrame, mapping: DataFrame, key: str, group: str,
                      date: str = "date", rules: dict | None = None,
                      hours: tuple[str, ...] = ("sunshine",), digits: int | None = 2,
                      exact_scale: int | None = None, row_count: str | None = None) -> DataFrame:
    """Roll daily rows keyed by ``key`` up to (``group``, year, month) through a dimension
    ``mapping(key, group)`` (e.g. supplier -> nation).

    The facts are first reduced to (key, year, month) partials (map-side combined), so the join
    carries one row per key and month rather than one per fact: a key holding a third of all rows
    is a single row per month there. The mapping is joined by the planner's choice (broadcast
    when small, shuffle otherwise), then the partials are re-aggregated per group; means stay
    means over the daily rows. Keys without a mapping row are dropped (inner join).
    """
    rules = rules or ROLLUP_RULES
    partials = _prepare(df, key, date).groupBy(key, "year", "month").agg(
        *_partial_aggs(rules, exact_scale, row_count))
    grouped = (partials.join(mapping.select(key, group), key, "inner")
                       .filter(F.col(group).isNotNull())
                       .groupBy(group, "year", "month").agg(*_reaggregate(rules, row_count)))
    return _finalize(grouped, [group, "year", "month"], rules, exact_scale, hours, digits, row_count)
