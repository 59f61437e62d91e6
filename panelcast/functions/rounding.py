"""Rounding rules.

NumPy/pandas round a double as ``rint(x * 10**d) / 10**d``: half-to-even on the *scaled double*.
Spark's ``round`` is HALF_UP on the decimal string of the double, so ``round(0.125, 2)`` is 0.13
in Spark and 0.12 in NumPy. The roll-ups use the NumPy rule; ``F.rint`` keeps it in codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(col: Column | str, digits: int = 2) -> Column:
    """``rint(x * 10^d) / 10^d``; NULL stays NULL, NaN stays NaN."""
    c = F.col(col) if isinstance(col, str) else col
    scale = float(10 ** digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def fixed_text(col: Column | str, digits: int = 2) -> Column:
    """Fixed-decimal text for CSV sinks (``%.2f``). Round first with :func:`round_half_even` so
    the text never depends on how a tie is broken."""
    c = F.col(col) if isinstance(col, str) else col
    return F.format_string(f"%.{digits}f", c)
