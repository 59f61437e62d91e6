"""A mergeable table of monthly sums and counts.

One row per (entity, year, month, batch) with the sum and the count of every measure. Parts of a month that land later add
rows under another batch; any roll-up is a sum over the batches of its key, so a month that arrives in several parts has
its full sum, whatever their order. A batch is written by replacing its own partitions: written again after a
failure, it leaves the table as it was (idempotence by batch id).

Rows without an entity are kept: they count for the nation only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.operators import rollup
from panelcast.schemas import ENTITY, ROLLUP_RULES
from panelcast.sources.readers import existing_table


def month_partials(daily: DataFrame, batch: str, entity: str = ENTITY, date: str = "date", rules: dict | None = None,
                   exact_scale: int | None = None) -> DataFrame:
    """The partial rows of one batch of daily rows: one scan, one shuffle of map-side combined rows."""
    rules = rules or ROLLUP_RULES
    aggs = rollup._partial_aggs(rules, exact_scale, "rows")
    # Counts of every measure, so that a sum over no values can be told from 0.
    aggs += [F.count(src).alias(f"_n_{src}") for src, (_, how) in rules.items() if how != "mean"]
    rows = rollup._prepare(daily, None, date).groupBy(entity, "year", "month").agg(*aggs)
    return rows.withColumn("batch", F.lit(batch))


def write_partials(partials: DataFrame, path: str) -> None:
    """Replace the partitions (year, month, batch) that ``partials`` has rows for, and no others."""
    (partials.hint("rebalance", "year", "month", "batch").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("year", "month", "batch").parquet(path))


def read_partials(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None before its first batch; any other error is raised."""
    stored = existing_table(spark, path)
    return stored if stored is None else stored.withColumns(
        {"year": F.col("year").cast("int"), "month": F.col("month").cast("int"), "batch": F.col("batch").cast("string")})


def merged_rollup(partials: DataFrame, national: bool = False, entity: str = ENTITY, rules: dict | None = None,
                  hours: tuple[str, ...] = ("sunshine",), digits: int | None = 2, exact_scale: int | None = None,
                  row_count: str | None = None) -> DataFrame:
    """Entity-month rows, or national-month rows, from the batches of the table."""
    rules = rules or ROLLUP_RULES
    keys = ["year", "month"] if national else [entity, "year", "month"]
    rows = partials if national else partials.where(F.col(entity).isNotNull())
    merged = rows.groupBy(*keys).agg(*rollup._reaggregate(rules, "rows"))
    return rollup._finalize(merged, keys, rules, exact_scale, hours, digits, row_count)
