"""Model inputs as plain columns: calendar fields, Fourier terms, lags."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.functions.time import to_micros

_US_PER_DAY = 86_400_000_000


@dataclass(frozen=True)
class Seasonality:
    """One Fourier seasonality: ``period`` in days, ``order`` sin/cos pairs.

    ``prior_scale`` is the standard deviation of the coefficients' Gaussian prior; the
    fit turns it into a ridge penalty of ``1 / prior_scale**2``.
    """

    name: str
    period: float
    order: int
    prior_scale: float = 10.0


# The seasonality the workload configures (weekly, period 7 days,
# Fourier order 3, prior scale 0.1) and a daily term for hourly data (period 1 day,
# order 4, prior scale 10).
WEEKLY = Seasonality("weekly", 7.0, 3, 0.1)
DAILY = Seasonality("daily", 1.0, 4, 10.0)
DEFAULT_SEASONALITIES = (DAILY, WEEKLY)


def epoch_days(ts) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return to_micros(c) / F.lit(float(_US_PER_DAY))


def fourier_terms(ts, seasonalities=DEFAULT_SEASONALITIES) -> list[tuple[str, Column, float]]:
    """``(name, column, prior_scale)`` for every sin/cos term, time in days since epoch."""
    t = epoch_days(ts)
    out = []
    for s in seasonalities:
        for k in range(1, s.order + 1):
            arg = F.lit(2.0 * math.pi * k / s.period) * t
            out.append((f"{s.name}_sin{k}", F.sin(arg), s.prior_scale))
            out.append((f"{s.name}_cos{k}", F.cos(arg), s.prior_scale))
    return out


def calendar_features(ts) -> list[tuple[str, Column]]:
    """Hour of day and day of week (0 = Monday) as doubles — the two dynamic channels."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return [
        ("hour_of_day", F.hour(c).cast("double")),
        ("day_of_week", F.weekday(c).cast("double")),
    ]


def add_lags(series: DataFrame, lags=(1, 24, 168), value: str = "target",
             key: str = "item_id", order: str = "ts") -> DataFrame:
    """``lag_k`` = value ``k`` rows earlier in the same series (regularise first).

    The window is per series and ordered by time, so a series is never split and rows
    never cross series.  On a regular grid a series holds at most span/freq rows.
    """
    w = Window.partitionBy(key).orderBy(order)
    return series.withColumns({f"lag_{k}": F.lag(value, k).over(w) for k in lags})
