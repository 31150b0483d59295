"""Arithmetic with the non-ANSI semantics the workload's metrics rely on.

The metrics being matched divide numpy arrays, so ``x/0`` is ``±inf`` and ``0/0`` is
``NaN``.  Spark 4 runs in ANSI mode and raises on a zero divisor, so every ratio in
tidecast goes through :func:`ratio`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _nan() -> Column:
    return F.lit(float("nan"))


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def ratio(num, den, on_zero: str = "ieee") -> Column:
    """``num / den`` with an explicit zero-divisor branch.

    on_zero='ieee'  x/0 = ±inf, 0/0 = NaN (numpy / IEEE 754; the default)
    on_zero='nan'   NaN for every zero divisor
    on_zero='null'  NULL, so that ``avg`` skips the term
    """
    num, den = _c(num).cast("double"), _c(den).cast("double")
    if on_zero == "ieee":
        zero = (F.when(num > 0, F.lit(float("inf"))).when(num < 0, F.lit(float("-inf")))
                .otherwise(_nan()))
    elif on_zero == "nan":
        zero = _nan()
    elif on_zero == "null":
        zero = F.lit(None).cast("double")
    else:
        raise ValueError(f"on_zero must be ieee, nan or null, not {on_zero!r}")
    return F.when(den == 0, zero).otherwise(num / den)


def exact_sum(col, scale: int) -> Column:
    """Sum of values with ``scale`` decimals (money), exact: DECIMAL inside, DOUBLE once at the
    end, so it does not depend on the order rows are added in.  Values with more decimals are
    rounded; use a plain sum for them.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast(f"decimal(18,{scale})")).cast("double")


def positive_part(x) -> Column:
    c = F.col(x) if isinstance(x, str) else x
    return F.greatest(c, F.lit(0.0))
