"""Column-level functions: every one returns a ``Column`` built from JVM-side expressions."""

from panelcast.functions.numeric import (clamp_zero, clip_cast, exact_cents, one_hot, std_floor,
                                         unzscore, zscore)
from panelcast.functions.periods import (month_start,
                                         previous_month_bounds)
from panelcast.functions.rounding import fixed_text, round_half_even

__all__ = [
    "clamp_zero", "clip_cast", "exact_cents", "one_hot", "std_floor", "unzscore", "zscore",
    "month_start", "previous_month_bounds",
    "fixed_text", "round_half_even",
]
