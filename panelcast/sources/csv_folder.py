"""A CSV folder whose files differ in their headers, with a quarantine table for lines that cannot be read.

Every file is bound by the names of its own header: columns may stand in any order, further ones are left out. Files with
one header are read together, so the plan grows with the number of layouts (at most :data:`MOST_LAYOUTS`), not of files.
Headers are found by Spark, in one pass that keeps one line per file.

The lines are parsed once, into the shared checkpoint folder, and both tables read that copy.

Quarantined, with file, line and reason: lines that do not fit their header or the declared types (a truncated last line), and
all lines of files that lack a required column. A row is in exactly one
of the two tables.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.session import checkpoint_dir

MOST_LAYOUTS = 200
BAD = "_corrupt_record"


def file_headers(spark: SparkSession, path: str) -> DataFrame:
    """``file, header`` of every file that has a line. Only a file's first block can hold its header; the first line
    there is the least by place."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"),
                                         F.col("_metadata.file_block_start").alias("block"))
    lines = lines.withColumn("at", F.monotonically_increasing_id()).where("block = 0")
    return lines.groupBy("file").agg(F.min_by("value", "at").alias("header"))


def layouts(spark: SparkSession, path: str) -> list[tuple[list[str], list[str]]]:
    """``(column names, files)`` of every layout, in a fixed order."""
    found = (file_headers(spark, path).groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))
             .orderBy("header").limit(MOST_LAYOUTS + 1).collect())
    if len(found) > MOST_LAYOUTS:
        raise ValueError(f"{path} has more than {MOST_LAYOUTS} different headers")
    return [([name.strip().lstrip("\ufeff") for name in next(csv.reader([r.header]), [])], r.files) for r in found]


def read_csv_folder(spark: SparkSession, path: str, schema: T.StructType, optional: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """``(rows, quarantine)``: rows under ``schema``, and ``file, line, reason`` of what could not be read. Columns named in
    ``optional`` may be missing from a file and are NULL there."""
    checkpoint_dir(spark)
    rows = spark.createDataFrame([], schema)
    bad = spark.createDataFrame([], "file string, line string, reason string")
    wanted = {f.name: f for f in schema.fields}
    for names, files in layouts(spark, path):
        missing = [n for n in wanted if n not in names and n not in optional]
        repeated = sorted({n for n in names if names.count(n) > 1 and n in wanted})
        if missing or repeated:
            reason = f"no column {', '.join(missing)}" if missing else f"column {', '.join(repeated)} twice"
            lines = spark.read.text(files).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
            head = F.split("line", ",")                      # the header line itself is no data
            lines = lines.where(F.transform(head, lambda c: F.trim(c)) != F.lit(names))
            bad = bad.unionByName(lines.withColumn("reason", F.lit(reason)))
            continue
        # Columns by place: those wanted have their type, the others are text under names of their own.
        in_file = T.StructType([T.StructField(n, wanted[n].dataType) if n in wanted else T.StructField(f"_other{i}", T.StringType())
                                for i, n in enumerate(names)]).add(BAD, T.StringType())
        # All columns are parsed, wanted or not: a line is judged by the whole of it.
        read = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD)
                .option("columnPruning", False).schema(in_file).csv(files))
        read = read.select("*", F.col("_metadata.file_path").alias("_file")).checkpoint(eager=True)
        good = read.where(F.col(BAD).isNull())
        rows = rows.unionByName(good.select(*[F.col(n) if n in names else F.lit(None).cast(f.dataType).alias(n)
                                              for n, f in wanted.items()]))
        bad = bad.unionByName(read.where(F.col(BAD).isNotNull()).select(
            F.col("_file").alias("file"), F.col(BAD).alias("line"), F.lit("line does not fit").alias("reason")))
    return rows, bad
