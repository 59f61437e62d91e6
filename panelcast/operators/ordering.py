"""Global positions over a sorted DataFrame without a single-partition window.

``row_number()`` over an unpartitioned window moves every row to one task. Instead the rows are
range-sorted (many tasks), tagged with ``monotonically_increasing_id`` (partition index in the
upper bits, position within the partition in the lower 33 bits), and checkpointed to the shared
checkpoint folder so the tags can never change on recomputation. One row per partition then
gives the partition sizes, whose running sum is each partition's offset; that table is bounded by
the partition count, so broadcasting it is safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.session import checkpoint_dir

_LOW_BITS = 33


def global_index(df: DataFrame, order: list[Column | str], name: str = "pos") -> DataFrame:
    """Add ``name``: the 0-based position of each row in ``order`` (ties: arbitrary but fixed)."""
    checkpoint_dir(df.sparkSession)
    tagged = (df.orderBy(*order)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mono", F.monotonically_increasing_id())
                .checkpoint(eager=True))
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = F.col("_mono") - F.shiftleft(F.col("_pid").cast("long"), _LOW_BITS)
    return (tagged.join(F.broadcast(offsets), "_pid")
                  .withColumn(name, F.col("_off") + local)
                  .drop("_pid", "_mono", "_off"))


def dense_ids(df: DataFrame, key: str, name: str = "entity_id") -> DataFrame:
    """Dense 0-based ids over the sorted distinct values of ``key`` (NULL excluded), by
    :func:`global_index` whatever their number."""
    distinct = df.select(key).where(F.col(key).isNotNull()).distinct()
    return global_index(distinct, [F.col(key).asc()], name).withColumn(name, F.col(name).cast("int"))
