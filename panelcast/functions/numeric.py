"""Numeric column transforms used by normalisation, scoring and export."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a standard deviation below this floor is replaced by 1.0 before dividing.
STD_FLOOR = 1e-10


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def exact_cents(col: Column | str, scale: int = 2) -> Column:
    """A fixed-point measure as an exact ``bigint`` of ``10^-scale`` units.

    Summing these longs is exact and order-free, so partial sums can be re-aggregated (entity
    month -> national month) and two engines agree to the bit after the final division.
    ``rint`` is a native double op; Spark's ``round`` on a double goes through ``BigDecimal`` per
    row. For fixed-point inputs ``x * 10^scale`` is within 1e-9 of an integer, so both agree.
    """
    return F.rint(_c(col) * F.lit(float(10 ** scale))).cast("long")


def std_floor(col: Column | str, floor: float = STD_FLOOR) -> Column:
    """``std < floor -> 1.0``; NULL (a propagated missing value) stays NULL."""
    c = _c(col)
    return F.when(c < F.lit(floor), F.lit(1.0)).otherwise(c)


def zscore(col: Column | str, mean: Column | str, std: Column | str) -> Column:
    return (_c(col) - _c(mean)) / _c(std)


def unzscore(col: Column | str, mean: Column | str, std: Column | str) -> Column:
    return _c(col) * _c(std) + _c(mean)


def clamp_zero(col: Column | str) -> Column:
    """Python's ``max(0, y)``: NaN, NULL and negatives all give 0.

    ``greatest(0, NaN)`` is NaN in Spark (NaN sorts above every number), so NaN is tested first.
    """
    c = _c(col)
    return F.when(F.isnan(c) | c.isNull() | (c <= F.lit(0.0)), F.lit(0.0)).otherwise(c)


def clip_cast(col: Column | str, n: Column | int) -> Column:
    """Clip to ``[0, n-1]`` then cast to int (truncation), the id layer of the sequence models."""
    upper = (n if isinstance(n, Column) else F.lit(n)) - F.lit(1)
    return F.least(F.greatest(_c(col), F.lit(0)), upper).cast("int")


def one_hot(index: Column | str, n: Column | int) -> Column:
    """Dense one-hot array of width ``n`` (only for narrow widths; use sparse vectors otherwise)."""
    width = n if isinstance(n, Column) else F.lit(n)
    idx = _c(index)
    return F.transform(F.sequence(F.lit(0), width - F.lit(1)),
                       lambda i: F.when(i == idx, F.lit(1.0)).otherwise(F.lit(0.0)))
