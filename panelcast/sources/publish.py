"""Staged publication of dated outputs: write, verify, then publish by manifest.

A publication has its own folder; nothing that a reader sees is ever overwritten. Only after the data was read back and its
rows, columns and content hash were found equal to what was written does one row of the manifest table name it. A run
that is killed between the steps leaves at most a folder that no manifest names, and the old output as readable as before.

``{base}/{name}/data/{version}``      the publications
``{base}/{name}/manifest``            Parquet table ``version, period, path, format, n_rows, content, published``

The manifest row is written by one task of one job, and Spark's committer shows its file whole or not at all.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MANIFEST = "version string, period string, path string, format string, n_rows long, content string, published timestamp"


def _measures(columns: list[str]) -> list:
    """Row count and content hash: independent of order and partitioning; text of every value, so that formats compare."""
    text = [F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("")) for c in columns]
    return [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*text).cast("decimal(38,0)")).alias("content")]


def _fingerprint(columns: list[str], n: int, content) -> tuple[int, str]:
    return n, f"{'|'.join(columns)}#{content or 0}"


def stage(df: DataFrame, base: str, name: str, fmt: str = "parquet") -> dict:
    """Write ``df`` to a folder of its own and verify it by reading it back. Raises if it is empty or differs."""
    version = uuid.uuid4().hex
    path = f"{base.rstrip('/')}/{name}/data/{version}"
    written = Observation(f"written-{version}")
    if fmt == "csv":
        df = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    writer = df.observe(written, *_measures(df.columns)).write.format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("nullValue", "\\N")
    writer.save(path)
    found = written.get                                      # measured by the tasks that wrote
    n, content = _fingerprint(df.columns, found["n"], found["content"])
    if not n:
        raise RuntimeError(f"{name} has no rows")
    back = _read(df.sparkSession, path, fmt)
    if (n, content) != _fingerprint(back.columns, *back.agg(*_measures(back.columns)).first()):
        raise RuntimeError(f"{path} does not hold what was written")
    return {"version": version, "path": path, "format": fmt, "n_rows": n, "content": content}


def publish(spark: SparkSession, staged: dict, base: str, name: str, period: str) -> None:
    """Append the manifest row that makes a staged output the current one of its period."""
    row = (staged["version"], period, staged["path"], staged["format"], staged["n_rows"], staged["content"], None)
    one = spark.createDataFrame([row], MANIFEST).withColumn("published", F.current_timestamp())
    one.coalesce(1).write.mode("append").parquet(f"{base.rstrip('/')}/{name}/manifest")


def manifest(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Every publication; no rows if there is none yet."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{base.rstrip('/')}/{name}/manifest")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], MANIFEST)
        raise


def read_published(spark: SparkSession, base: str, name: str, period: str) -> DataFrame:
    """The output of ``period`` that was published last."""
    rows = manifest(spark, base, name).where(F.col("period") == period)
    last = rows.orderBy(F.desc("published"), F.desc("version")).limit(1).collect()
    if not last:
        raise FileNotFoundError(f"nothing is published as {name} for {period}")
    return _read(spark, last[0].path, last[0].format)


def _read(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    reader = spark.read.format(fmt)
    return reader.option("header", True).option("nullValue", "\\N").load(path) if fmt == "csv" else reader.load(path)
