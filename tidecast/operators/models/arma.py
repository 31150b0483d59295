"""Moving-average terms and the choice of orders (M4): two regressions per series, no search.

Hannan and Rissanen's method on seasonal differences ``d_t = y_t − y_{t−m}``: a long autoregression
gives each series' innovations ``e_t``; then ``d_t`` is regressed on ``1, d_{t−1..p}, e_{t−1..q}``.
One pass of Gram sums over the largest design serves all orders: an order's system is the same
matrix with the rows and columns of the terms it lacks replaced by those of the identity, and it is
solved in the JVM.  The order with the least Bayesian information criterion wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.operators.models import autoreg, linear

MAX_P, MAX_Q = 2, 2
LONG_ORDER = 6
RIDGE = 1e-8


def innovation_rows(history: DataFrame, max_p: int = MAX_P, max_q: int = MAX_Q, long_order: int = LONG_ORDER,
                    season_length: int = 24) -> DataFrame:
    """``item_id, step, n_steps, d, d_lag1.., e, e_lag1..``; nulls where a term reaches before the
    series' start or into a gap."""
    d = autoreg.lagged_differences(history, max(long_order, max_p), season_length)
    fit = autoreg.fit_ar(history, long_order, season_length, ridge=RIDGE).select("item_id", "beta")
    expected = F.col("beta")[0]
    for i in range(1, long_order + 1):
        expected = expected + F.col("beta")[i] * F.col(f"d_lag{i}")
    rows = d.join(fit, "item_id").select("item_id", "step", "n_steps", "d", *[f"d_lag{i}" for i in range(1, max_p + 1)], (F.col("d") - expected).alias("e"))
    w = Window.partitionBy("item_id").orderBy("step")
    return rows.select("*", *[F.lag("e", i).over(w).alias(f"e_lag{i}") for i in range(1, max_q + 1)])


def terms(max_p: int = MAX_P, max_q: int = MAX_Q) -> list[str]:
    return ["const", *[f"d_lag{i}" for i in range(1, max_p + 1)], *[f"e_lag{i}" for i in range(1, max_q + 1)]]


def _fitted(order: Column, n: Column, matrix: Column, right: Column, yy: Column) -> Column:
    """``(bic, p, q, beta, rss)`` of one order (a struct with the ``used`` flag of every term)."""
    used = lambda i: F.get(order["used"], i)
    system = F.transform(matrix, lambda r, i: F.transform(r, lambda v, j: F.when(used(i) & used(j), v + F.when(i == j, RIDGE).otherwise(0.0))
                                                          .otherwise(F.when(i == j, 1.0).otherwise(0.0))))
    values = F.transform(right, lambda v, i: F.when(used(i), v).otherwise(0.0))
    return linear.let(linear.solved(system, values), lambda beta: linear.let(
        F.greatest(linear.residual_sum(matrix, right, yy, beta), F.lit(1e-300)),
        lambda rss: F.struct((n * F.log(rss / n) + (1 + order["p"] + order["q"]) * F.log(n)).alias("bic"),
                             order["p"].alias("p"), order["q"].alias("q"), beta.alias("beta"), rss.alias("rss"))))


def fit_arma(rows: DataFrame, max_p: int = MAX_P, max_q: int = MAX_Q) -> DataFrame:
    """Per series of ``innovation_rows`` the chosen ``p, q``, its ``bic``, ``beta`` over ``terms``
    (0 for absent ones), ``sigma`` and ``n``."""
    names = terms(max_p, max_q)
    x = rows.withColumn("const", F.lit(1.0)).dropna(subset=["d", *names[1:]])
    sums = linear.gram_arrays(linear.gram_sums(x, "item_id", names, "d"), names)
    used = lambda p, q: F.array(*[F.lit(k == 0 or 1 <= k <= p or max_p < k <= max_p + q) for k in range(len(names))])
    orders = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(q).alias("q"), used(p, q).alias("used")) for p in range(max_p + 1) for q in range(max_q + 1)])
    n = F.col("n").cast("double")
    best = F.array_min(F.transform(orders, lambda o: _fitted(o, n, F.col("xx"), F.col("xy"), F.col("yy"))))
    dof = F.greatest(n - 1 - F.col("b.p") - F.col("b.q"), F.lit(1.0))
    return sums.select("item_id", "n", best.alias("b")).select("item_id", "b.p", "b.q", "b.bic", "b.beta", F.sqrt(F.col("b.rss") / dof).alias("sigma"), "n")


def arma_forecast(history: DataFrame, horizon: int, season_length: int = 24, freq: str = "1 hour",
                  quantiles: Sequence[float] = (0.1, 0.5, 0.9), max_p: int = MAX_P, max_q: int = MAX_Q,
                  long_order: int = LONG_ORDER, model: str = "seasonal_arma") -> DataFrame:
    """FORECAST rows: the differences roll forward from the last ones and the last innovations,
    future innovations being 0, and are integrated over the seasons."""
    rows = innovation_rows(history, max_p, max_q, long_order, season_length)
    keep = max(max_p, max_q)
    recent = F.transform(F.sort_array(F.collect_list(F.struct("step", "d", "e")), asc=False), lambda x: F.struct(x["d"].alias("d"), x["e"].alias("e")))
    last = (rows.filter((F.col("step") >= F.col("n_steps") - keep) & F.col("e").isNotNull()).groupBy("item_id").agg(recent.alias("last"))
                .filter(F.size("last") == keep))
    per = fit_arma(rows, max_p, max_q).join(last, "item_id")
    phi, theta = F.slice("beta", 2, max_p), F.slice("beta", 2 + max_p, max_q)

    def step(state: Column, _: Column) -> Column:
        d = F.col("beta")[0] + linear.dot(phi, state["w"]) + linear.dot(theta, state["e"])
        return linear.let(d, lambda d: F.struct(F.slice(F.concat(F.array(d), state["w"]), 1, max_p).alias("w"),
                                                F.slice(F.concat(F.array(F.lit(0.0)), state["e"]), 1, max_q).alias("e"),
                                                F.concat(state["out"], F.array(d)).alias("out")))

    # latest first, as the coefficients are
    start = F.struct(F.slice(F.transform("last", lambda x: x["d"]), 1, max_p).alias("w"), F.slice(F.transform("last", lambda x: x["e"]), 1, max_q).alias("e"),
                     F.array().cast("array<double>").alias("out"))
    dh = per.select("item_id", "sigma", F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step, lambda s: s["out"]).alias("dhat"))
    return autoreg.integrated(history, dh, horizon, season_length, freq, quantiles, model)
