"""Quantile regression by reweighted least squares (the check loss of M5's quantiles).

``Σ ρ_q(r)`` is minimised by repeating least squares with the weights ``|q − 1[r < 0]| / max(|r|, δ)``,
which makes each squared residual the check loss of the round before (smoothed within ``δ``).  A round is
one Spark aggregate over all rows for all quantiles: the weighted sums ``Σ w z z'``, ``Σ w z y`` and the loss.
Only these sums (``k·(k+3)/2`` numbers a quantile) reach the driver, which solves the ``k×k`` systems; the
coefficients go back as an array literal, so every round runs the same compiled code.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.operators.models.linear import dot

MAX_ROUNDS = 40
TOLERANCE = 1e-4        # of the loss, relative
SMOOTH = 1e-3           # δ; the rows' target is on a scale of 1
RIDGE = 1e-6            # of the mean diagonal


@dataclass
class PinballFit:
    quantiles: tuple[float, ...]
    betas: list[list[float]]
    losses: list[float]         # mean check loss of each quantile
    rounds: int


def check_loss(r: Column, q: Column) -> Column:
    return F.when(r < 0, (q - 1) * r).otherwise(q * r)


def fit(rows: DataFrame, terms: Sequence[str], target: str, quantiles: Sequence[float], start: Sequence[Sequence[float]],
        max_rounds: int = MAX_ROUNDS, tolerance: float = TOLERANCE, smooth: float = SMOOTH) -> PinballFit:
    """Coefficients over ``terms`` of each quantile, from the coefficients ``start`` (one list per
    quantile); stops when no quantile's loss falls by ``tolerance`` any more.  Persist ``rows``: every
    round reads them."""
    k, qs = len(terms), [float(q) for q in quantiles]
    z = [F.get("z", i) for i in range(k)]
    base = rows.select(F.array(*[F.col(t).cast("double") for t in terms]).alias("z"), F.col(target).cast("double").alias("y"))
    betas = [np.asarray(b, dtype=float) for b in start]
    best, best_loss = [b.copy() for b in betas], [float("inf")] * len(qs)
    rounds = 0
    for rounds in range(1, max_rounds + 1):
        coded = F.lit([float(v) for b in betas for v in b])
        each = base.select("z", "y", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(q).alias("q")) for i, q in enumerate(qs)])).alias("e"))
        r = each.select("z", "y", "e.i", "e.q", (F.col("y") - dot(F.col("z"), F.slice(coded, F.col("e.i") * k + 1, k))).alias("r"))
        w = r.select("*", (F.abs(F.col("q") - F.when(F.col("r") < 0, 1.0).otherwise(0.0)) / F.greatest(F.abs("r"), F.lit(smooth))).alias("w"))
        sums = [F.sum(F.col("w") * z[i] * z[j]) for i in range(k) for j in range(i, k)] + [F.sum(F.col("w") * z[i] * F.col("y")) for i in range(k)]
        per = w.groupBy("i").agg(F.count(F.lit(1)).alias("n"), F.sum(check_loss(F.col("r"), F.col("q"))).alias("loss"), F.array(*sums).alias("s"))
        got = per.agg(F.collect_list(F.struct("i", "n", "loss", "s")).alias("all")).first()["all"]
        if not got:
            return PinballFit(tuple(qs), [b.tolist() for b in betas], [0.0] * len(qs), 0)
        better = False
        for row in got:
            i, loss = row["i"], row["loss"] / row["n"]
            if loss < best_loss[i] * (1 - tolerance):
                better = True
            if loss < best_loss[i]:
                best[i], best_loss[i] = betas[i].copy(), loss
            a = np.zeros((k, k))
            a[np.triu_indices(k)] = row["s"][:k * (k + 1) // 2]
            a = a + np.triu(a, 1).T
            a[np.diag_indices(k)] += RIDGE * max(np.trace(a) / k, 1e-12)
            betas[i] = np.linalg.solve(a, np.asarray(row["s"][k * (k + 1) // 2:]))
        if not better:
            break
    return PinballFit(tuple(qs), [b.tolist() for b in best], best_loss, rounds)


def predictions(terms: Sequence[str], fitted: PinballFit) -> Column:
    """The quantiles' values in order of quantile; sorted, so that they never cross."""
    z = F.array(*[F.col(t).cast("double") for t in terms])
    order = sorted(range(len(fitted.quantiles)), key=lambda i: fitted.quantiles[i])
    return F.sort_array(F.array(*[dot(z, F.lit([float(v) for v in fitted.betas[i]])) for i in order]))
