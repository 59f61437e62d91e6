"""Map the generated TPC-H-style test tables onto the panel data model.

A lineitem row plays a daily observation of a supplier (the entity):
``temp_max = l_quantity``, ``temp_min = l_discount``, ``humidity = l_tax`` (averaged),
``precipitation = l_extendedprice`` and ``sunshine = l_quantity * 60`` seconds (summed),
``date = CAST(l_shipdate AS DATE)``. The monthly target is the number of rows per entity-month.
Source measures carry two decimals, so roll-ups aggregate them exactly (``EXACT_SCALE``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.operators.history import merge_target
from panelcast.operators.rollup import monthly_rollup
from panelcast.schemas import DISTRICT_TARGET, ENTITY, SERIES_TARGET

EXACT_SCALE = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def daily_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").alias(ENTITY),
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_quantity").alias("temp_max"),
        F.col("l_discount").alias("temp_min"),
        F.col("l_extendedprice").alias("precipitation"),
        F.col("l_tax").alias("humidity"),
        (F.col("l_quantity") * F.lit(60.0)).alias("sunshine"),
    )


def entity_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier-month panel: district, year, month, five features, ``mal_cases`` (row count)."""
    return monthly_rollup(daily_obs(spark, sf_dir), exact_scale=EXACT_SCALE,
                          row_count=DISTRICT_TARGET)


def national_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """National monthly series with its target: orders per month (LEFT JOIN, so months without
    orders keep a NULL target, as the merged climate/demand series does)."""
    national = monthly_rollup(daily_obs(spark, sf_dir), entity=None, exact_scale=EXACT_SCALE)
    orders = table(spark, sf_dir, "orders")
    target = (orders.groupBy(F.year("o_orderdate").alias("year"),
                             F.month("o_orderdate").alias("month"))
                    .agg(F.count(F.lit(1)).cast("double").alias(SERIES_TARGET)))
    return merge_target(national, target, ["year", "month"])


# Payload requests from events: one request per (user, block of 1,024 consecutive event ids),
# so no payload array grows with the data even for a user holding most events.
EVENT_BLOCK = 1024

EVENT_MEMBERS = {"value": "value", "error_value": "error_value"}

EVENT_PAYLOAD_SCHEMA = T.StructType([
    T.StructField("daily", T.StructType([
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("value", T.ArrayType(T.DoubleType())),
        T.StructField("error_value", T.ArrayType(T.DoubleType())),
    ])),
])


def event_payload_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed payload text: ``district`` (user), ``request`` and a JSON ``body``.

    ``error_value`` is present only in requests that hold an error event (else the member is
    absent), and is NULL at the positions of other events.
    """
    ev = table(spark, sf_dir, "events")
    items = F.array_sort(F.collect_list(F.struct("ts", "event_id", "value", "event_type")))
    grouped = ev.groupBy(F.col("user_id").alias(ENTITY),
                         F.expr(f"event_id div {EVENT_BLOCK}").alias("request")).agg(items.alias("_it"))
    it = F.col("_it")
    has_error = F.exists(it, lambda x: x["event_type"] == "error")
    daily = F.struct(
        F.transform(it, lambda x: F.date_format(x["ts"], "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("time"),
        F.transform(it, lambda x: x["value"]).alias("value"),
        F.when(has_error, F.transform(
            it, lambda x: F.when(x["event_type"] == "error", x["value"]))).alias("error_value"),
    )
    return grouped.select(ENTITY, "request", F.to_json(F.struct(daily.alias("daily"))).alias("body"))


def order_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload per order; orders with status 'P' carry no ``daily``."""
    o = table(spark, sf_dir, "orders")
    daily = F.when(F.col("o_orderstatus") != "P",
                   F.struct(F.array(F.col("o_totalprice")).alias("value")))
    return o.select(F.col("o_custkey").alias(ENTITY), daily.alias("daily"))


def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias(ENTITY), "c_name", "c_nationkey")


def before(year: int, month: int):
    """Predicate: (year, month) strictly before the given month."""
    return (F.col("year") * 100 + F.col("month")) < F.lit(year * 100 + month)


def within(first: tuple[int, int], last: tuple[int, int]):
    ym = F.col("year") * 100 + F.col("month")
    return ym.between(F.lit(first[0] * 100 + first[1]), F.lit(last[0] * 100 + last[1]))


def supplier_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension mapping supplier key -> nation name. The nation table has a fixed 25 rows
    (TPC-H), so it is broadcast; the supplier table grows with the scale factor and is not."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias(ENTITY), "s_nationkey")
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return s.join(F.broadcast(n), "s_nationkey").select(ENTITY, "n_name")
