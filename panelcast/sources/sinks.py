"""Writers: Parquet tables (the default), CSV with fixed-decimal text, period-stamped names.

Outputs are directories of part files written by every task in parallel; nothing is funnelled
through one task to produce a single file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.functions.rounding import fixed_text, round_half_even


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: list[str] | None = None, sort_within: list[str] | None = None) -> None:
    """Parquet sink; ``partition_by`` (e.g. year, month) lets later reads prune whole months.

    A partitioned write is preceded by a ``REBALANCE`` on the partition columns: AQE groups each
    month's rows into few tasks (few files per month instead of one per task per month) and splits
    a month that is larger than the advisory size over several tasks, so no month is one hot task.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def fixed_decimals(df: DataFrame, digits: int = 2) -> DataFrame:
    """Every float column as ``%.{digits}f`` text, rounded NumPy-style first."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(fixed_text(round_half_even(F.col(f.name), digits), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str, float_digits: int | None = None, mode: str = "overwrite") -> None:
    """CSV with a header and no index; ``float_digits`` formats floats as fixed-decimal text."""
    if float_digits is not None:
        df = fixed_decimals(df, float_digits)
    df.write.mode(mode).option("header", True).csv(path)


def period_path(base: str, name: str, period: str) -> str:
    """``{base}/{name}_{YYYY_MM}``: one dataset per monthly period."""
    return f"{base.rstrip('/')}/{name}_{period}"


def forecast_path(base: str, prefix: str, labels: list[str]) -> str:
    """``{base}/{prefix}_{label1}_{label2}_{label3}``: named by the forecast months."""
    return f"{base.rstrip('/')}/{prefix}_{'_'.join(labels)}"
