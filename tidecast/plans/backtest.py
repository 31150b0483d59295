"""Backtests: cut the last H points, forecast them, pair and score."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.operators import metrics as M
from tidecast.operators.series import holdout_part, train_part

Forecaster = Callable[[DataFrame, int], DataFrame]


@dataclass
class Backtest:
    history: DataFrame
    holdout: DataFrame
    forecast: DataFrame
    models: Sequence[str] | None = None

    def paired(self, q: float | None = 0.5) -> DataFrame:
        return M.pair(self.forecast, self.holdout, q, self.models)


def backtest(grid: DataFrame, forecaster: Forecaster, horizon: int) -> Backtest:
    """Split a grid, run ``forecaster(history, horizon)`` and keep the pieces."""
    history = train_part(grid, horizon)
    return Backtest(history, holdout_part(grid, horizon), forecaster(history, horizon))


def backtest_all(grid: DataFrame, forecasters: dict[str, Forecaster], horizon: int) -> Backtest:
    """Every model on the same split, forecasts unioned into one FORECAST frame.

    The models share one history plan; Spark reuses its shuffle output (ReusedExchange)
    instead of recomputing the split per model.
    """
    history = train_part(grid, horizon)
    fcs = [fc(history, horizon).withColumn("model", F.lit(name)) for name, fc in forecasters.items()]
    union = fcs[0]
    for other in fcs[1:]:
        union = union.unionByName(other)
    return Backtest(history, holdout_part(grid, horizon), union, list(forecasters))


def leaderboard(bt: Backtest, q: float = 0.7, zero_pair: str = "nan") -> DataFrame:
    """One row of summed-series metrics per model (A16), scored at quantile ``q``."""
    return M.summed_series_metrics(bt.paired(q), zero_pair)


def choose(forecast: DataFrame, names: Sequence[str] | str) -> DataFrame:
    """Pick model(s) by name from a multi-model FORECAST."""
    names = [names] if isinstance(names, str) else list(names)
    return forecast.filter(F.col("model").isin(names))
