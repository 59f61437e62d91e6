"""Monthly file arrival as Structured Streaming.

Landed payload files are a file stream; each micro-batch is flattened, rolled up to
entity-months and appended to the history table with the row-level idempotent append (only keys
not yet stored). ``trigger(availableNow=True)`` processes whatever has landed and stops, which is
the scheduled monthly run; the checkpoint location records which files were consumed, so a rerun
after a failure neither skips nor repeats a file, and a replayed batch finds its keys stored and
appends nothing.

Two forms. :func:`start_monthly_arrival` appends finished entity-months: a landed file must hold whole ones (one
request per entity and month, as the extract produces), and a month that is stored stays as it is.
:func:`start_partial_arrival` keeps a table of partial sums (:mod:`panelcast.operators.partials`): a month may land in any
number of files and runs, :func:`month_history` merges its parts, and a replayed batch replaces its own partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from panelcast import schemas
from panelcast.operators import history, partials, rollup
from panelcast.sources.payload import payload_flatten
from panelcast.sources.readers import existing_table

KEYS = [schemas.ENTITY, "year", "month"]


def append_batch(batch: DataFrame, history_path: str, exact_scale: int | None = None) -> None:
    """Roll one batch of payloads up and append its new entity-month keys to ``history_path``."""
    spark = batch.sparkSession
    daily = payload_flatten(batch)
    month = rollup.monthly_rollup(daily, exact_scale=exact_scale)
    rows = schemas.schema_align(month, schemas.DISTRICT_HISTORY_COLUMNS,
                                add_missing={schemas.DISTRICT_TARGET: T.DoubleType()},
                                types={"year": T.IntegerType(), "month": T.IntegerType()})
    stored = existing_table(spark, history_path)
    if stored is not None:
        rows = history.rows_new_keys(stored, rows, KEYS)     # reads only the batch's months
    rows.write.mode("append").partitionBy("year", "month").parquet(history_path)


def write_batch_partials(batch: DataFrame, path: str, batch_id: int, exact_scale: int | None = None) -> None:
    """Write the partial sums of one batch of payloads to the partial table at ``path``."""
    rows = partials.month_partials(payload_flatten(batch), f"stream-{batch_id}", exact_scale=exact_scale)
    partials.write_partials(rows, path)


def month_history(spark: SparkSession, path: str, exact_scale: int | None = None) -> DataFrame:
    """The history table of a partial table: entity-months merged from all batches so far."""
    stored = partials.read_partials(spark, path)
    if stored is None:
        raise FileNotFoundError(f"no batch has been written to {path}")
    return schemas.schema_align(partials.merged_rollup(stored, exact_scale=exact_scale), schemas.DISTRICT_HISTORY_COLUMNS,
                                add_missing={schemas.DISTRICT_TARGET: T.DoubleType()},
                                types={"year": T.IntegerType(), "month": T.IntegerType()})


def start_partial_arrival(spark: SparkSession, landing: str, path: str, checkpoint: str,
                          schema: T.StructType = schemas.PAYLOAD_SCHEMA,
                          exact_scale: int | None = None) -> StreamingQuery:
    """Stream what has landed into the partial table at ``path`` and stop."""
    return (spark.readStream.schema(schema).json(landing).writeStream
            .foreachBatch(lambda df, epoch: write_batch_partials(df, path, epoch, exact_scale))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def start_monthly_arrival(spark: SparkSession, landing: str, history_path: str, checkpoint: str,
                          schema: T.StructType = schemas.PAYLOAD_SCHEMA,
                          exact_scale: int | None = None,
                          available_now: bool = True) -> StreamingQuery:
    """Start the stream; ``checkpoint`` must be on shared storage."""
    stream = spark.readStream.schema(schema).json(landing)
    writer = (stream.writeStream
              .foreachBatch(lambda df, _epoch: append_batch(df, history_path, exact_scale))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.start()


def history_months(spark: SparkSession, history_path: str) -> DataFrame:
    """Stored (year, month, entities) summary of the history table."""
    return (spark.read.parquet(history_path).groupBy("year", "month")
            .agg(F.count_distinct(schemas.ENTITY).alias("entities")))
