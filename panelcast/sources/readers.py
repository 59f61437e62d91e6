"""Readers: CSV tables with a declared schema, and normalisation-parameter files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.functions.numeric import STD_FLOOR, std_floor

CORRUPT = "_corrupt_record"


def existing_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None if nothing is stored there yet. Any other failure is raised: a table
    that cannot be read is not an empty one."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv",
               keep_corrupt: bool = False) -> DataFrame:
    """Read a table with a declared schema (no inference at scale).

    CSV columns are bound by the names of the header, wherever they stand; others are left out and a
    missing one raises. Lines are read in PERMISSIVE mode; with ``keep_corrupt`` a malformed line (such as
    a truncated last row) is kept in ``_corrupt_record`` instead of failing the job.
    """
    if fmt != "csv":
        return spark.read.schema(schema).format(fmt).load(path)
    header = spark.read.option("header", True).csv(path).columns
    wanted = {f.name: f for f in schema.fields}
    if missing := [name for name in wanted if name not in header]:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    in_file = T.StructType([wanted.get(name, T.StructField(name, T.StringType())) for name in header])
    # The header of every file must be this one: it is checked, not skipped.
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
    names = list(wanted)
    if keep_corrupt:
        in_file = in_file.add(CORRUPT, T.StringType())
        names.append(CORRUPT)
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(in_file).csv(path).select(*names)


def read_csv_dated(spark: SparkSession, path: str, schema: T.StructType, date: str = "date",
                   date_format: str = "yyyy-MM-dd") -> DataFrame:
    """CSV whose ``date`` column is text in ``date_format``, returned as DateType."""
    fields = [T.StructField(f.name, T.StringType() if f.name == date else f.dataType)
              for f in schema.fields]
    df = read_table(spark, path, T.StructType(fields))
    return df.withColumn(date, F.to_date(date, date_format))


def read_params(spark: SparkSession, path: str, features: list[str],
                floor: float = STD_FLOOR) -> DataFrame:
    """A ``{"mean": [...], "std": [...]}`` file as one row of ``{f}_mean`` / ``{f}_std``.

    Raises when either vector's length differs from ``len(features)`` (one-row check). The std
    floor is applied as in the fitted statistics.
    """
    raw = spark.read.option("multiLine", True).json(path)
    sizes = raw.select(F.size("mean").alias("m"), F.size("std").alias("s")).first()
    if sizes is None or sizes.m != len(features) or sizes.s != len(features):
        raise ValueError(f"normalisation parameters must have {len(features)} values each")
    cols = []
    for i, f in enumerate(features):
        cols.append(F.col("mean")[i].cast("double").alias(f"{f}_mean"))
        cols.append(std_floor(F.col("std")[i].cast("double"), floor).alias(f"{f}_std"))
    return raw.select(*cols)
