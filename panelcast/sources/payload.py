"""Landed JSON payloads: a ``daily`` struct of parallel arrays per entity request.

Flattening is row-local (no shuffle): one ``inline`` over an array of structs built with a
higher-order ``transform`` over the ``time`` array, reading every measure by position with
``get`` (NULL past the end of a short array and for an absent array). ``arrays_zip`` is not used
because it drops the whole row set when one array is NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.schemas import ENTITY, PAYLOAD_MEMBERS, PAYLOAD_SCHEMA


def read_payloads(spark: SparkSession, path: str, schema: T.StructType = PAYLOAD_SCHEMA) -> DataFrame:
    """Scan landed payload files (one JSON object per line) with a declared schema."""
    return spark.read.schema(schema).json(path)


def parse_payloads(df: DataFrame, text: str, schema: T.StructType) -> DataFrame:
    """Parse a JSON text column into the payload struct columns."""
    parsed = F.from_json(F.col(text), schema)
    return df.select(*[c for c in df.columns if c != text], parsed.alias("_pl")).select(
        *[c for c in df.columns if c != text], "_pl.*")


def payload_flatten(df: DataFrame, keys: list[str] | None = None, payload: str = "daily",
                    time: str = "time", members: dict[str, str] | None = None,
                    time_as: str = "date", parse_date: bool = True,
                    period: str | None = None) -> DataFrame:
    """Struct-of-arrays payloads -> one row per element of ``time``.

    ``members`` maps payload member -> output column. Rows whose payload is NULL (no ``daily``
    member) produce nothing; :func:`coverage_missing` reports them. ``period`` adds the constant
    ``month`` stamp of the extract.
    """
    keys = keys or [ENTITY]
    members = members or PAYLOAD_MEMBERS
    p = F.col(payload)

    def element(t, i):
        fields = [i.alias("pos"), t.alias(time_as)]
        fields += [F.get(p.getField(m), i).alias(out) for m, out in members.items()]
        return F.struct(*fields)

    out = (df.filter(p.isNotNull())
             .select(*keys, F.inline(F.transform(p.getField(time), element))))
    if parse_date:
        out = out.withColumn(time_as, F.to_date(time_as))
    if period is not None:
        out = out.withColumn("month", F.lit(period))
    return out


def coverage_missing(dim: DataFrame, payloads: DataFrame, key: str = ENTITY,
                     payload: str = "daily", dim_key: str | None = None) -> DataFrame:
    """Dimension rows with no usable payload (absent, or present without the ``payload`` member).

    The payload keys are deduplicated first (combined map-side), so an entity with a huge number
    of payloads reaches the anti join as one row instead of one skewed partition.
    """
    usable = payloads.filter(F.col(payload).isNotNull()).select(F.col(key).alias("_k")).distinct()
    dk = dim_key or key
    return dim.join(usable, dim[dk] == usable["_k"], "left_anti")
