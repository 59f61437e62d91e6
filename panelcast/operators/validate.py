"""Dataset validation as one aggregation pass, and lazy guards.

The report is one row per check from a single ``agg`` (one row) that is unpivoted, so a large
table is scanned once. ``assert_valid`` is the only place that brings the (bounded, one row per
check) report to the driver, because it has to raise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def validation_report(df: DataFrame, required: list[str], not_null: list[str]) -> DataFrame:
    """Rows ``(check_name, n_bad, passed)``: required columns, non-empty, NULLs per column."""
    missing = [c for c in required if c not in df.columns]
    present = [c for c in not_null if c in df.columns]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(present)]
    checks = [F.struct(F.lit("required_columns").alias("check_name"),
                       F.lit(len(missing)).cast("long").alias("n_bad")),
              F.struct(F.lit("non_empty").alias("check_name"),
                       F.when(F.col("_rows") == 0, 1).otherwise(0).cast("long").alias("n_bad"))]
    checks += [F.struct(F.lit(f"not_null:{c}").alias("check_name"),
                        F.col(f"_null_{i}").cast("long").alias("n_bad"))
               for i, c in enumerate(present)]
    return (df.agg(*aggs)
              .select(F.inline(F.array(*checks)))
              .withColumn("passed", F.col("n_bad") == 0))


def assert_valid(df: DataFrame, required: list[str], not_null: list[str]) -> None:
    failed = [r for r in validation_report(df, required, not_null).collect() if not r.passed]
    if failed:
        raise ValueError("validation failed: " + ", ".join(f"{r.check_name}={r.n_bad}" for r in failed))


def min_rows_guard(df: DataFrame, n: int, what: str = "rows") -> Column:
    """A column that fails the query at run time when ``df`` has fewer than ``n`` rows.

    Uses a scalar subquery, so the guard lives inside the plan (no driver count).
    """
    count = df.select(F.count(F.lit(1))).scalar()
    return F.assert_true(count >= F.lit(n), F.lit(f"need at least {n} {what}"))
