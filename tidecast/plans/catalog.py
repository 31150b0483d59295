"""The named queries registered in ``__spark_entry__``: one per operator group of the
inventory, each reading the driver tables at ``sf_dir`` and running on all their rows.

``QUERIES[name] = (spark_builder, oracle_sql or None)``.  Every output column is
aliased identically on both sides; doubles are rounded to 6 places on both sides so
the order of floating-point additions cannot change the compared values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.functions.features import add_lags
from tidecast.functions.time import format_run_id, ts_text
from tidecast.operators import blocks
from tidecast.operators import metrics as M
from tidecast.operators import series as S
from tidecast.operators.models import arma, autoreg, fourier, global_ar, naive, samples
from tidecast.plans import datasets as D
from tidecast.plans import oracle as O
from tidecast.plans.backtest import backtest, backtest_all, choose, leaderboard
from tidecast.session import materialize
from tidecast.sources import readers as R
from tidecast.sources import sinks as K

# Fixed values of the workload: 72-hour horizon, 24-hour season, one week of context,
# scored at the 0.7 quantile, evaluator quantiles 0.1/0.5/0.9, 100 sample paths.
H, M_SEASON, CTX = 72, 24, 168
TARGET_Q = 0.7
EVAL_QS = (0.1, 0.5, 0.9)
MSIS_QS = (0.025, 0.1, 0.5, 0.9, 0.975)
INTERVAL_QS = (0.05, 0.25, 0.5, 0.75, 0.95)

# how a multi-branch query keeps its grid: "persist" (memory/disk, recomputed from
# lineage if an executor is lost) or "checkpoint" (reliable copy in spark.checkpoint.dir)
REUSE = "persist"

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[Builder, str | None]] = {}


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), places).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def rounded_sql(sql: str, columns: list[str], doubles: list[str], places: int = 6) -> str:
    sel = ", ".join(f"round({c}, {places}) AS {c}" if c in doubles else c for c in columns)
    return f"SELECT {sel} FROM (\n{sql}\n) q"


def register(name: str, columns: list[str] | None = None, doubles: list[str] = (), sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = fn(spark, sf_dir)
            if columns:
                out = out.select(*columns)
            return rounded(out)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        q = rounded_sql(sql, columns, list(doubles)) if sql is not None else None
        QUERIES[name] = (run, q)
        return run
    return deco


FC_COLS = ["model", "item_id", "step", "ts", "quantile", "value"]
POINT_COLS = ["rmse", "mae", "smape", "mpe", "mape", "mean_y", "n"]
POINT_DOUBLES = ["rmse", "mae", "smape", "mpe", "mape", "mean_y"]
IM_COLS = ["model", "item_id", "mse", "abs_error", "abs_target_sum", "abs_target_mean",
           "seasonal_error", "mase", "mape", "smape", "msis"]


def _hourly(spark, d):
    return D.events_hourly(spark, d)


def _grid(spark, d):
    """The hourly grid, computed once and kept (``REUSE``): queries that read it in several
    branches (history, holdout, several models) then scan ``events`` only once."""
    return materialize(D.events_hourly(spark, d), "events_hourly", REUSE)


def _raw_hourly(spark, d):
    return D.events_cells(spark, d, "1 hour")


def _users(spark, d):
    return D.events_as_series(spark, d, "user_id")


def _sn(hist, h):
    return naive.seasonal_naive(hist, h, M_SEASON, "1 hour", (TARGET_Q,))


def _resample(qs):
    return lambda hist, h: naive.kernel_resample(hist, h, CTX, M_SEASON, 0.5, "1 hour", qs)


# ----------------------------------------------------------------------------- P, T, A1–A4

@register("apply_mapping", ["order_id", "order_date", "total_price", "priority"], ["total_price"],
          "SELECT CAST(o_orderkey AS BIGINT) AS order_id, CAST(o_orderdate AS DATE) AS order_date, "
          "CAST(o_totalprice AS DOUBLE) AS total_price, CAST(o_orderpriority AS VARCHAR) AS priority FROM orders")
def q_apply_mapping(spark, d):
    """Keep, rename and cast listed columns of ``orders``."""
    return S.apply_mapping(D.table(spark, d, "orders"), [
        ("o_orderkey", "bigint", "order_id", "bigint"),
        ("o_orderdate", "timestamp", "order_date", "date"),
        ("o_totalprice", "double", "total_price", "double"),
        ("o_orderpriority", "string", "priority", "string")])


@register("hourly_series", ["item_id", "ts", "step", "n_steps", "target"], ["target"],
          O.with_(O.hourly(), "SELECT item_id, ts, step, n_steps, target FROM series"))
def q_hourly_series(spark, d):
    """A1/F2: hourly sum per event type on the full grid, empty hours 0."""
    return _hourly(spark, d)


@register("series_start", ["item_id", "start", "start_day", "start_id"], [],
          O.with_([O.cells()], "SELECT item_id, start, strftime(start, '%Y-%m-%d') AS start_day, "
                               "strftime(start, '%Y-%m-%d-%H-%M-%S') AS start_id FROM "
                               "(SELECT item_id, min(ts) AS start FROM cells GROUP BY 1)"))
def q_series_start(spark, d):
    """First time of each (ungridded) hourly series, with its run-date and
    run-id renderings (``yyyy-MM-dd``, ``yyyy-MM-dd-HH-mm-ss``)."""
    st = S.series_start(_raw_hourly(spark, d))
    return st.select("item_id", "start", format_run_id("start", False).alias("start_day"),
                     format_run_id("start").alias("start_id"))


@register("describe_series", ["n_series", "n_points", "min_length", "max_length"], [],
          "SELECT count(*) AS n_series, CAST(sum(n) AS BIGINT) AS n_points, CAST(min(n) AS BIGINT) AS min_length, "
          "CAST(max(n) AS BIGINT) AS max_length FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1)")
def q_describe_series(spark, d):
    """A1: number of series and points of the per-user raw series."""
    return S.describe_series(_users(spark, d))


@register("filter_min_length", ["item_id", "ts", "target"], ["target"],
          "SELECT CAST(user_id AS VARCHAR) AS item_id, ts, value AS target FROM events "
          "WHERE user_id IN (SELECT user_id FROM events GROUP BY 1 HAVING count(*) >= 70)")
def q_filter_min_length(spark, d):
    """P5: per-user raw series with at least 70 points."""
    return S.filter_min_length(_users(spark, d), 70)


@register("holdout_split", ["item_id", "ts", "target", "split"], ["target"],
          O.with_(O.hourly(), f"SELECT item_id, ts, target, CASE WHEN step >= n_steps - {H} THEN 'holdout' "
                              f"ELSE 'train' END AS split FROM series"))
def q_holdout_split(spark, d):
    """Last 72 hours of each series are the holdout."""
    return S.holdout_split(_hourly(spark, d), H)


@register("holdout_split_raw", ["item_id", "ts", "target", "split"], ["target"],
          f"SELECT CAST(user_id AS VARCHAR) AS item_id, ts, value AS target, CASE WHEN row_number() OVER "
          f"(PARTITION BY user_id ORDER BY ts DESC, value DESC) <= 10 THEN 'holdout' ELSE 'train' END AS split "
          f"FROM events")
def q_holdout_split_raw(spark, d):
    """P6/W1 on ungridded series: the per-task top-n path (last 10 events per user)."""
    return S.holdout_split(_users(spark, d), 10)


@register("tail", ["item_id", "ts", "target"], ["target"],
          O.with_(O.hourly(), f"SELECT item_id, ts, target FROM series WHERE step >= n_steps - {CTX}"))
def q_tail(spark, d):
    """Last 168 points of each series."""
    return S.tail(_hourly(spark, d), CTX)


@register("context", ["item_id", "ts", "target"], ["target"],
          O.with_(O.hourly(), f"SELECT item_id, ts, target FROM series WHERE step < n_steps - {H} "
                              f"AND step >= n_steps - {H} - {CTX}"))
def q_context(spark, d):
    """The 168-point context window just before the 72-point holdout."""
    return S.context(_hourly(spark, d), CTX, H)


@register("one_series", ["item_id", "ts", "target"], ["target"],
          O.with_(O.hourly(), "SELECT item_id, ts, target FROM series WHERE item_id = 'click'"))
def q_one_series(spark, d):
    """One series by key."""
    return S.one_series(_hourly(spark, d), "click")


@register("first_series", ["item_id", "ts", "target"], ["target"],
          "SELECT CAST(user_id AS VARCHAR) AS item_id, ts, value AS target FROM events "
          "WHERE CAST(user_id AS VARCHAR) = (SELECT min(CAST(user_id AS VARCHAR)) FROM events)")
def q_first_series(spark, d):
    """All rows of the first series (smallest key)."""
    return S.first_series(_users(spark, d))


@register("sort_by_time", ["item_id", "ts", "step", "target"], ["target"],
          O.with_(O.hourly(), "SELECT item_id, ts, step, target FROM series ORDER BY item_id, ts"))
def q_sort_by_time(spark, d):
    """Series ordered by key and time."""
    return S.sort_by_time(_hourly(spark, d))


@register("nest_unnest", ["item_id", "start_text", "n_target", "step", "ts", "target"], ["target"],
          O.with_(O.hourly(), "SELECT item_id, strftime(min(ts) OVER (PARTITION BY item_id), '%Y-%m-%d %H:%M:%S') "
                              "AS start_text, CAST(count(*) OVER (PARTITION BY item_id) AS INTEGER) AS n_target, "
                              "step, ts, target FROM series"))
def q_nest_unnest(spark, d):
    """Nest each series into one record, rename, and explode it back."""
    nested = S.nest_target(_grid(spark, d)).withColumnRenamed("item_id", "id")
    nested = S.canonicalise(nested)
    # what belongs to the record rides along with its points: no join back
    kept = {"start_text": ts_text("start"), "n_target": F.size("target").cast("int")}
    return S.unnest_target(nested, "1 hour", kept)


@register("feature_channels", ["item_id", "ts", "target", "feat_0", "feat_1"], ["target", "feat_0", "feat_1"],
          O.with_(O.hourly(), "SELECT item_id, ts, target, CAST(hour(ts) AS DOUBLE) AS feat_0, "
                              "CAST(isodow(ts) - 1 AS DOUBLE) AS feat_1 FROM series"))
def q_feature_channels(spark, d):
    """Hour-of-day and weekday channels, nested as dynamic_feat, unnested
    channel by channel and joined back onto the points."""
    grid = _grid(spark, d)
    cov = S.calendar_covariates(grid)
    nested = S.nest_target(grid).join(S.nest_features(cov), "item_id")
    back = S.unnest_feature(nested, 0, "1 hour").unionByName(S.unnest_feature(nested, 1, "1 hour"))
    return S.join_covariates(grid.select("item_id", "ts", "target"), back, 2)


@register("covariate_join", ["item_id", "ts", "target", "feat_0", "feat_1", "cat_index", "category"],
          ["target", "feat_0", "feat_1"],
          O.with_(O.hourly() + [("cats", "SELECT item_id, CAST(dense_rank() OVER (ORDER BY item_id) - 1 AS INTEGER) "
                                         "AS category FROM (SELECT DISTINCT item_id FROM series)")],
                  "SELECT s.item_id, s.ts, s.target, CAST(hour(s.ts) AS DOUBLE) AS feat_0, "
                  "CAST(isodow(s.ts) - 1 AS DOUBLE) AS feat_1, 0 AS cat_index, c.category "
                  "FROM series s LEFT JOIN cats c USING (item_id)"))
def q_covariate_join(spark, d):
    """Dynamic features (pivoted channels) and the static category on every point."""
    grid = _grid(spark, d)
    cats = S.static_categories(grid, "item_id")
    out = S.join_covariates(grid.select("item_id", "ts", "target"), S.calendar_covariates(grid), 2, cats)
    return out.withColumn("cat_index", F.col("cat_index").cast("int"))


@register("feature_mean", ["ts", "feat_index", "value"], ["value"],
          O.with_(O.hourly() + [("keep", f"SELECT item_id FROM series GROUP BY 1 HAVING count(*) >= {H}")],
                  "SELECT ts, feat_index, sum(v) / (SELECT count(DISTINCT item_id) FROM series) AS value FROM ("
                  "SELECT ts, 0 AS feat_index, CAST(hour(ts) AS DOUBLE) AS v FROM series WHERE item_id IN (SELECT item_id FROM keep) "
                  "UNION ALL SELECT ts, 1, CAST(isodow(ts) - 1 AS DOUBLE) FROM series WHERE item_id IN (SELECT item_id FROM keep)"
                  ") GROUP BY 1, 2"))
def q_feature_mean(spark, d):
    """A4: feature sum over the predict set divided by the number of training series."""
    grid = _grid(spark, d)
    n_train = grid.agg(F.count_distinct("item_id")).scalar()
    predict = S.filter_min_length(grid, H)
    out = S.mean_feature_across_series(S.calendar_covariates(predict), n_train)
    return out.withColumn("feat_index", F.col("feat_index").cast("int"))


@register("sum_across_series", ["ts", "target"], ["target"],
          O.with_(O.hourly(), "SELECT ts, CASE WHEN count(target) = (SELECT count(DISTINCT item_id) FROM series) "
                              "THEN sum(target) END AS target FROM series GROUP BY 1"))
def q_sum_across_series(spark, d):
    """Point-wise sum over the gridded series."""
    return S.sum_across_series(_hourly(spark, d), strict=True)


@register("sum_across_series_strict", ["ts", "target"], ["target"],
          O.with_([O.cells()], "SELECT ts, CASE WHEN count(target) = (SELECT count(DISTINCT item_id) FROM cells) "
                               "THEN sum(target) END AS target FROM cells GROUP BY 1"))
def q_sum_across_series_strict(spark, d):
    """A3: strict sum on the ungridded hourly cells — an hour missing anywhere is NULL."""
    return S.sum_across_series(_raw_hourly(spark, d), strict=True)


@register("group_multivariate", ["ts", "dim", "item_id", "value"], ["value"],
          O.with_([O.cells("hour", "user_id", "ucells"),
                   ("dims", "SELECT item_id, CAST(row_number() OVER (ORDER BY item_id) - 1 AS INTEGER) AS dim FROM "
                            "(SELECT DISTINCT item_id FROM ucells)"),
                   ("cells", "SELECT * FROM ucells"),
                   ("means", "SELECT item_id, CAST(sum(CAST(target AS DECIMAL(18,2))) AS DOUBLE) / count(target) AS fill "
                             "FROM cells GROUP BY 1")]
                  + O.grid("hour", "cells", "series", "NULL"),
                  "SELECT s.ts, d.dim, s.item_id, coalesce(s.target, m.fill) AS value FROM series s "
                  "JOIN dims d USING (item_id) JOIN means m USING (item_id)"))
def q_group_multivariate(spark, d):
    """All per-user hourly series aligned on one grid, gaps = series mean."""
    cells = materialize(D.events_cells(spark, d, "1 hour", "user_id"), "user_hourly_cells", REUSE)
    return S.group_multivariate(cells, "1 hour", D.MONEY_SCALE)


@register("multivariate_gram", ["dim_a", "dim_b", "gram", "covariance", "n"], ["gram", "covariance"],
          O.with_([O.cells("hour", "user_id", "ucells"),
                   ("dims", "SELECT item_id, CAST(row_number() OVER (ORDER BY item_id) - 1 AS INTEGER) AS dim FROM "
                            "(SELECT DISTINCT item_id FROM ucells)"),
                   ("cells", "SELECT * FROM ucells"),
                   ("means", "SELECT item_id, CAST(sum(CAST(target AS DECIMAL(18,2))) AS DOUBLE) / count(target) AS fill "
                             "FROM cells GROUP BY 1")]
                  + O.grid("hour", "cells", "series", "NULL")
                  + [("mv", "SELECT s.ts, d.dim, coalesce(s.target, m.fill) AS v FROM series s JOIN dims d USING (item_id) JOIN means m USING (item_id)"),
                     ("mm", "SELECT dim, avg(v) AS m FROM mv GROUP BY 1")],
                  "SELECT dim_a, dim_b, round(g, 2) AS gram, round(g / n - a.m * b.m, 4) AS covariance, n FROM (SELECT a.dim AS dim_a, b.dim AS dim_b, sum(a.v * b.v) AS g, count(*) AS n "
                  "FROM mv a JOIN mv b ON b.ts = a.ts AND b.dim >= a.dim GROUP BY 1, 2) JOIN mm a ON a.dim = dim_a JOIN mm b ON b.dim = dim_b"))
def q_multivariate_gram(spark, d):
    """Gram sums and covariances of all pairs of per-user hourly series, from tiles of time by
    dimension."""
    cells = materialize(D.events_cells(spark, d, "1 hour", "user_id"), "user_hourly_cells", REUSE)
    # not kept: it has a row per user and hour, and comes from the cells without another shuffle
    mv = S.group_multivariate(cells, "1 hour", D.MONEY_SCALE)
    means = materialize(mv.groupBy("dim").agg(F.avg("value").alias("mean")), "user_means", REUSE)
    out = blocks.covariance(blocks.gram(blocks.tiles(mv)), means)
    return out.select("dim_a", "dim_b", F.round("gram", 2).alias("gram"), F.round("covariance", 4).alias("covariance"), "n")


@register("label_boundaries", ["item_id", "ts", "target", "segment"], ["target"],
          O.with_(O.hourly(), f"SELECT item_id, ts, target, CASE WHEN step < n_steps - {2 * H} THEN 'train' "
                              f"WHEN step < n_steps - {H} THEN 'test' ELSE 'predict' END AS segment FROM series"))
def q_label_boundaries(spark, d):
    """Train ⊂ test ⊂ predict, marked on the longest set."""
    grid = _grid(spark, d)
    return S.label_boundaries(grid, S.train_part(grid, 2 * H), S.train_part(grid, H))


@register("lags", ["item_id", "ts", "target", "lag_1", "lag_24", "lag_168"],
          ["target", "lag_1", "lag_24", "lag_168"],
          O.with_(O.hourly(), "SELECT item_id, ts, target, lag(target, 1) OVER w AS lag_1, lag(target, 24) OVER w "
                              "AS lag_24, lag(target, 168) OVER w AS lag_168 FROM series "
                              "WINDOW w AS (PARTITION BY item_id ORDER BY ts)"))
def q_lags(spark, d):
    """Lagged values 1, 24 and 168 hours back."""
    return add_lags(_hourly(spark, d), (1, 24, 168))


# ----------------------------------------------------------------------------- M1–M4

@register("seasonal_naive", FC_COLS, ["quantile", "value"],
          O.with_(O.hourly() + O.split() + [O.seasonal_naive()], "SELECT * FROM sn"))
def q_seasonal_naive(spark, d):
    """M1: 72-hour seasonal-naive forecast (m = 24) from the history before the holdout."""
    hist = S.train_part(_grid(spark, d), H)
    return naive.seasonal_naive(hist, H, M_SEASON, "1 hour", ())


@register("resample_quantiles", FC_COLS, ["quantile", "value"],
          O.with_(O.hourly() + O.split() + O.resample(EVAL_QS), "SELECT * FROM np"))
def q_resample_quantiles(spark, d):
    """Kernel-weighted same-phase resampling, quantiles 0.1/0.5/0.9 + mean."""
    hist = S.train_part(_grid(spark, d), H)
    return naive.kernel_resample(hist, H, CTX, M_SEASON, 0.5, "1 hour", EVAL_QS)


@register("fourier_gram", ["item_id", "term_pair", "value"], ["value"], O.fourier_gram_sql())
def q_fourier_gram(spark, d):
    """M3/M7: per-series Gram sums of [1, trend, daily and weekly Fourier terms, y]."""
    hist = S.train_part(_grid(spark, d), H)
    names = [n for n, _, _ in fourier.design(F.col("ts"), F.col("step"), "1 hour")]
    return fourier.gram_long(fourier.gram_sums(hist, "1 hour", exact_target=True), names)


@register("ar1_fit", ["item_id", "phi", "intercept", "n", "sigma"], ["phi", "intercept", "sigma"],
          O.with_(O.hourly() + O.split() + [
              ("dd", f"SELECT item_id, step, target - lag(target, {M_SEASON}) OVER w AS d_t, "
                     f"lag(target, 1) OVER w - lag(target, {M_SEASON + 1}) OVER w AS d_prev FROM hist "
                     f"WINDOW w AS (PARTITION BY item_id ORDER BY step)"),
              ("fit", "SELECT item_id, regr_slope(d_t, d_prev) AS phi, regr_intercept(d_t, d_prev) AS intercept, "
                      "CAST(regr_count(d_t, d_prev) AS BIGINT) AS n, regr_sxx(d_t, d_prev) AS sxx, "
                      "regr_syy(d_t, d_prev) AS syy, regr_sxy(d_t, d_prev) AS sxy FROM dd GROUP BY 1")],
              "SELECT item_id, phi, intercept, n, CASE WHEN n > 2 AND sxx > 0 THEN "
              "sqrt(greatest(syy - sxy * sxy / sxx, 0.0) / (n - 2)) END AS sigma FROM fit"))
def q_ar1_fit(spark, d):
    """M4: AR(1) on 24-hour differences — slope, intercept, residual scale."""
    return autoreg.fit_ar1(S.train_part(_grid(spark, d), H), M_SEASON).drop("d_mean", "d_last")


# ----------------------------------------------------------------------------- B1, A5–A16

@register("backtest_metrics", ["model", "item_id"] + POINT_COLS, POINT_DOUBLES,
          O.with_(O.hourly() + O.split() + [O.seasonal_naive(), O.paired("sn")],
                  f"SELECT model, item_id, {O.POINT} FROM paired GROUP BY 1, 2"))
def q_backtest_metrics(spark, d):
    """Flagship — B1/J2/A5–A7/A10: seasonal-naive backtest scored per series at q 0.7."""
    bt = backtest(_grid(spark, d), _sn, H)
    return M.point_metrics(bt.paired(TARGET_Q))


@register("pooled_metrics", ["model", "rmse", "mae", "mean_y", "smape"], ["rmse", "mae", "mean_y", "smape"],
          O.with_(O.hourly() + O.split() + [O.seasonal_naive(), O.paired("sn")],
                  "SELECT p.model, p.rmse, p.mae, p.mean_y, s.smape FROM (SELECT model, sqrt(avg((f - y) * (f - y))) "
                  "AS rmse, avg(abs(f - y)) AS mae, avg(y) AS mean_y FROM paired GROUP BY 1) p JOIN (SELECT model, "
                  "avg(smape) AS smape FROM (SELECT model, item_id, avg(2 * abs(f - y) / (abs(y) + abs(f))) AS smape "
                  "FROM paired GROUP BY 1, 2) GROUP BY 1) s USING (model)"))
def q_pooled_metrics(spark, d):
    """RMSE and MAE over all cells, sMAPE as the mean of item sMAPEs."""
    bt = backtest(_grid(spark, d), _sn, H)
    return M.pooled_metrics(bt.paired(TARGET_Q))


@register("summed_metrics", ["model"] + POINT_COLS, POINT_DOUBLES,
          O.with_(O.hourly() + O.split() + [O.seasonal_naive(), O.paired("sn")], O.summed()))
def q_summed_metrics(spark, d):
    """Metrics of the series summed over items per step."""
    bt = backtest(_grid(spark, d), _sn, H)
    return M.summed_series_metrics(bt.paired(TARGET_Q))


LB_QS = (0.1, 0.5, 0.7, 0.9)


def _leaderboard_models():
    return {
        "seasonal_naive_24": lambda h, n: naive.seasonal_naive(h, n, 24, "1 hour", LB_QS),
        "seasonal_naive_168": lambda h, n: naive.seasonal_naive(h, n, 168, "1 hour", LB_QS),
        "resample": _resample(LB_QS),
        "mean": lambda h, n: naive.context_mean(h, n, CTX, "1 hour", LB_QS),
        "seasonal_ar1": lambda h, n: autoreg.ar_forecast(h, n, M_SEASON, None, "1 hour", LB_QS),
        "seasonal_ar2": lambda h, n: autoreg.ar_p_forecast(h, n, 2, M_SEASON, None, "1 hour", LB_QS),
    }


@register("leaderboard", ["model"] + POINT_COLS, POINT_DOUBLES,
          O.with_(O.hourly() + O.split() + [O.seasonal_naive(24, name="sn24"),
                                            O.seasonal_naive(168, name="sn168")]
                  + O.resample(LB_QS) + [O.context_mean(),
                                     ("fc", "SELECT * FROM sn24 UNION ALL SELECT * FROM sn168 UNION ALL "
                                            "SELECT * FROM np UNION ALL SELECT * FROM cm UNION ALL "
                                            f"SELECT * FROM ({O.ar1_forecast_sql(LB_QS)}) UNION ALL "
                                            f"SELECT * FROM ({O.ar2_forecast_sql(LB_QS)})"),
                                     O.paired("fc")], O.summed()))
def q_leaderboard(spark, d):
    """Six models backtested on one split, summed metrics per model."""
    bt = backtest_all(_grid(spark, d), _leaderboard_models(), H)
    return leaderboard(bt, TARGET_Q)


@register("leaderboard_fitted", ["model"] + POINT_COLS, POINT_DOUBLES,
          O.with_(O.hourly() + O.split() + [
              ("fc", f"SELECT * FROM ({O.fourier_forecast_sql(LB_QS)}) UNION ALL SELECT * FROM ({O.arma_forecast_sql(LB_QS)})"),
              O.paired("fc")], O.summed()))
def q_leaderboard_fitted(spark, d):
    """The models solved per series (trend + Fourier, ARMA with chosen orders) on one split."""
    bt = backtest_all(_grid(spark, d), {
        "fourier": lambda h, n: fourier.fourier_forecast(h, n, "1 hour", quantiles=LB_QS),
        "seasonal_arma": lambda h, n: arma.arma_forecast(h, n, M_SEASON, "1 hour", LB_QS)}, H)
    return leaderboard(bt, TARGET_Q)


def _user_daily_metrics(spark, d):
    bt = backtest(materialize(D.events_user_daily(spark, d), "events_user_daily", REUSE),
                  lambda h, n: naive.seasonal_naive(h, n, 7, "1 day", (TARGET_Q,)), 7)
    return M.point_metrics(bt.paired(TARGET_Q))


_UD = O.user_daily() + O.split(7) + [
    ("sn", "SELECT 'seasonal_naive_7' AS model, l.item_id, CAST(s.h AS INTEGER) AS step, "
           "CAST(l.t_end + to_days(s.h) AS TIMESTAMP) AS ts, CAST(NULL AS DOUBLE) AS quantile, x.target AS value "
           "FROM lastrow l, (SELECT unnest(range(1, 8)) AS h) s, hist x "
           "WHERE x.item_id = l.item_id AND x.step = l.n_steps - 7 + ((s.h - 1) % 7)"),
    O.paired("sn"),
    ("pm", f"SELECT model, item_id, {O.POINT} FROM paired GROUP BY 1, 2")]


@register("metric_extremes", ["model", "argmin", "min", "argmax", "max"], ["min", "max"],
          O.with_(_UD + [("ok", "SELECT * FROM pm WHERE smape IS NOT NULL AND NOT isnan(smape)")],
                  "SELECT model, (SELECT item_id FROM ok o2 WHERE o2.model = o.model ORDER BY smape, item_id LIMIT 1) "
                  "AS argmin, min(smape) AS min, (SELECT item_id FROM ok o3 WHERE o3.model = o.model ORDER BY smape DESC, "
                  "item_id LIMIT 1) AS argmax, max(smape) AS max FROM ok o GROUP BY model"))
def q_metric_extremes(spark, d):
    """Best and worst user by sMAPE (7-day seasonal-naive backtest of daily sums)."""
    return M.metric_extremes(_user_daily_metrics(spark, d), "smape")


@register("metric_head", ["model", "item_id"] + POINT_COLS, POINT_DOUBLES,
          O.with_(_UD, "SELECT * FROM pm ORDER BY item_id LIMIT 5"))
def q_metric_head(spark, d):
    """T4: first five rows of the per-user metric table."""
    return M.metric_head(_user_daily_metrics(spark, d), 5)


@register("metric_histogram", ["bucket", "lo", "hi", "n"], ["lo", "hi"],
          O.with_(_UD, O.histogram_sql("pm", "smape")))
def q_metric_histogram(spark, d):
    """Users per right-closed sMAPE bucket, empty buckets kept."""
    return M.metric_histogram(_user_daily_metrics(spark, d), "smape")


@register("prediction_intervals", ["model", "item_id", "step", "ts", "median", "lo50", "hi50", "lo90", "hi90"],
          ["median", "lo50", "hi50", "lo90", "hi90"],
          O.with_(O.hourly() + O.split() + O.resample(INTERVAL_QS),
                  "SELECT model, item_id, step, ts, max(CASE WHEN quantile = 0.5 THEN value END) AS median, "
                  "max(CASE WHEN quantile = 0.25 THEN value END) AS lo50, max(CASE WHEN quantile = 0.75 THEN value END) AS hi50, "
                  "max(CASE WHEN quantile = 0.05 THEN value END) AS lo90, max(CASE WHEN quantile = 0.95 THEN value END) AS hi90 "
                  "FROM np GROUP BY 1, 2, 3, 4"))
def q_prediction_intervals(spark, d):
    """50 % and 90 % intervals and the median per forecast step."""
    hist = S.train_part(_grid(spark, d), H)
    return M.prediction_intervals(naive.kernel_resample(hist, H, CTX, M_SEASON, 0.5, "1 hour", INTERVAL_QS))


@register("sample_quantiles", ["item_id", "hour", "q10", "q50", "q70", "q90", "mean", "n"],
          ["q10", "q50", "q70", "q90", "mean"],
          "SELECT item_id, hour, " + ", ".join(
              f"min(CASE WHEN rn = CAST(round_even((n - 1) * CAST({q!r} AS DOUBLE), 0) AS BIGINT) THEN value END) "
              f"AS q{int(q * 100):02d}"
              for q in (0.1, 0.5, 0.7, 0.9)) +
          ", avg(value) AS mean, max(n) AS n FROM (SELECT event_type AS item_id, CAST(hour(ts) AS INTEGER) AS hour, value, "
          "row_number() OVER (PARTITION BY event_type, hour(ts) ORDER BY value) - 1 AS rn, "
          "count(*) OVER (PARTITION BY event_type, hour(ts)) AS n FROM events) GROUP BY 1, 2")
def q_sample_quantiles(spark, d):
    """Nearest-rank quantiles and mean of event values per type and hour of day."""
    ev = D.table(spark, d, "events").select(F.col("event_type").alias("item_id"),
                                           F.hour("ts").cast("int").alias("hour"), "value")
    return M.summarise_samples(ev, ["item_id", "hour"], "value", (0.1, 0.5, 0.7, 0.9), bins=16)


@register("describe_forecast", ["model", "item_id", "num_samples", "horizon", "start_date", "n_values"], [],
          O.with_(O.hourly(), "SELECT 'daily_paths' AS model, item_id, count(DISTINCT step // 24) AS num_samples, "
                              "CAST(max(step % 24) + 1 AS INTEGER) AS horizon, min(ts) AS start_date, "
                              "count(*) AS n_values FROM series GROUP BY 1, 2"))
def q_describe_forecast(spark, d):
    """Each day of a series read as one 24-step sample path; count and shape."""
    grid = _grid(spark, d)
    samples = grid.select(F.lit("daily_paths").alias("model"), "item_id",
                          (F.pmod("step", F.lit(24)) + 1).cast("int").alias("step"), "ts",
                          F.floor(F.col("step") / 24).cast("int").alias("sample_id"),
                          F.col("target").alias("value"))
    return M.describe_forecast(samples)


# ----------------------------------------------------------------------------- E1–E9

def _eval_backtest(spark, d, qs=MSIS_QS):
    return backtest(_grid(spark, d), _resample(qs), H)


@register("seasonal_error", ["item_id", "seasonal_error"], ["seasonal_error"],
          O.with_(O.hourly() + O.split() + [O.seasonal_error()], "SELECT * FROM se"))
def q_seasonal_error(spark, d):
    """Mean absolute 24-hour difference over each history."""
    return M.seasonal_error(S.train_part(_grid(spark, d), H), M_SEASON)


_EVAL = O.hourly() + O.split() + O.resample(MSIS_QS) + O.item_metrics_sql("np")


@register("item_metrics", IM_COLS, IM_COLS[2:], O.with_(_EVAL, "SELECT * FROM im"))
def q_item_metrics(spark, d):
    """MASE, MSIS, sMAPE … per series for the resampling model."""
    bt = _eval_backtest(spark, d)
    return M.item_metrics(bt.forecast, bt.holdout, bt.history, M_SEASON)


@register("quantile_loss", ["model", "item_id", "quantile", "quantile_loss"], ["quantile", "quantile_loss"],
          O.with_(_EVAL + [O.quantile_metrics_sql()], "SELECT model, item_id, quantile, quantile_loss FROM qm"))
def q_quantile_loss(spark, d):
    """E5: quantile loss per series and quantile."""
    bt = _eval_backtest(spark, d)
    return M.quantile_metrics(bt.forecast, bt.holdout, EVAL_QS)


@register("coverage", ["model", "item_id", "quantile", "coverage"], ["quantile", "coverage"],
          O.with_(_EVAL + [O.quantile_metrics_sql()], "SELECT model, item_id, quantile, coverage FROM qm"))
def q_coverage(spark, d):
    """Share of actuals below each forecast quantile."""
    bt = _eval_backtest(spark, d)
    return M.quantile_metrics(bt.forecast, bt.holdout, EVAL_QS)


@register("weighted_quantile_loss", ["model", "quantile", "wql", "coverage"], ["quantile", "wql", "coverage"],
          O.with_(_EVAL + [O.quantile_metrics_sql(), O.wql_sql()], "SELECT * FROM wq"))
def q_weighted_quantile_loss(spark, d):
    """Quantile loss weighted by Σ|y| per quantile."""
    bt = _eval_backtest(spark, d)
    return M.weighted_quantile_loss(M.quantile_metrics(bt.forecast, bt.holdout, EVAL_QS))


@register("metric_projection", ["model", "item_id", "msis", "mase", "smape"], ["msis", "mase", "smape"],
          O.with_(_EVAL, "SELECT model, item_id, msis, mase, smape FROM im"))
def q_metric_projection(spark, d):
    """The metric-versus-metric view (MSIS against MASE) and the per-series sMAPE."""
    bt = _eval_backtest(spark, d)
    return M.item_metrics(bt.forecast, bt.holdout, bt.history, M_SEASON).select(
        "model", "item_id", "msis", "mase", "smape")


_AGG_NAMES = ["MSE", "abs_error", "abs_target_sum", "abs_target_mean", "seasonal_error", "MASE", "MAPE",
              "sMAPE", "MSIS", "RMSE", "NRMSE", "ND"]


@register("agg_metrics", ["model", "metric", "value"], ["value"],
          O.with_(_EVAL + [O.quantile_metrics_sql(), O.wql_sql(),
                           ("a", "SELECT model, avg(mse) AS MSE, sum(abs_error) AS abs_error, sum(abs_target_sum) AS "
                                 "abs_target_sum, avg(abs_target_mean) AS abs_target_mean, avg(seasonal_error) AS "
                                 "seasonal_error, avg(mase) AS MASE, avg(mape) AS MAPE, avg(smape) AS sMAPE, "
                                 "avg(msis) AS MSIS FROM im GROUP BY 1"),
                           ("a2", "SELECT *, sqrt(MSE) AS RMSE, sqrt(MSE) / abs_target_mean AS NRMSE, "
                                  "abs_error / abs_target_sum AS ND FROM a")],
                  " UNION ALL ".join(f"SELECT model, '{n}' AS metric, CAST({n} AS DOUBLE) AS value FROM a2"
                                     for n in _AGG_NAMES)
                  + " UNION ALL SELECT model, 'wQuantileLoss[' || CAST(quantile AS VARCHAR) || ']', wql FROM wq"
                  + " UNION ALL SELECT model, 'Coverage[' || CAST(quantile AS VARCHAR) || ']', coverage FROM wq"
                  + " UNION ALL SELECT model, 'mean_wQuantileLoss', avg(wql) FROM wq GROUP BY 1"
                  + " UNION ALL SELECT model, 'MAE_Coverage', avg(abs(coverage - quantile)) FROM wq GROUP BY 1"))
def q_agg_metrics(spark, d):
    """The aggregate metric report, long form."""
    bt = _eval_backtest(spark, d)
    im = M.item_metrics(bt.forecast, bt.holdout, bt.history, M_SEASON)
    return M.agg_metrics(im, M.quantile_metrics(bt.forecast, bt.holdout, EVAL_QS))


@register("median_forecast", ["item_id", "step", "ts", "value"], ["value"],
          O.with_(O.hourly() + [("hist", "SELECT * FROM series"),
                                ("lastrow", "SELECT item_id, n_steps, ts AS t_end FROM hist WHERE step = n_steps - 1"),
                                O.seasonal_naive(24, 168)],
                  "SELECT item_id, step, ts, value FROM sn"))
def q_median_forecast(spark, d):
    """Median of a 168-hour forecast past the end of the full series."""
    fc = naive.seasonal_naive(_grid(spark, d), 168, M_SEASON, "1 hour", (0.5,))
    return M.pick_quantile(fc, 0.5)


# ----------------------------------------------------------------------------- rows-only

@register("fourier_forecast", FC_COLS, ["quantile", "value"], O.fourier_forecast_sql(EVAL_QS))
def q_fourier_forecast(spark, d):
    """M3: ridge trend + daily/weekly Fourier forecast with Gaussian quantiles."""
    hist = S.train_part(_grid(spark, d), H)
    return fourier.fourier_forecast(hist, H, "1 hour", quantiles=EVAL_QS)


@register("ar_forecast", FC_COLS, ["quantile", "value"], O.ar1_forecast_sql(EVAL_QS))
def q_ar_forecast(spark, d):
    """M4: seasonal AR(1) roll-forward, closed form."""
    hist = S.train_part(_grid(spark, d), H)
    return autoreg.ar_forecast(hist, H, M_SEASON, None, "1 hour", EVAL_QS)


@register("choose_model", FC_COLS, ["quantile", "value"],
          O.with_(O.hourly() + O.split() + [O.seasonal_naive(24, name="sn24"),
                                            O.seasonal_naive(168, name="sn168")]
                  + O.resample(LB_QS) + [O.context_mean(),
                                     ("fc", "SELECT * FROM sn24 UNION ALL SELECT * FROM sn168 UNION ALL "
                                            "SELECT * FROM np UNION ALL SELECT * FROM cm")],
                  "SELECT * FROM fc WHERE model = 'resample'"))
def q_choose_model(spark, d):
    """Pick one predictor's forecast by name out of the multi-model backtest."""
    bt = backtest_all(_grid(spark, d), _leaderboard_models(), H)
    return choose(bt.forecast, "resample")


@register("ar2_forecast", FC_COLS, ["quantile", "value"], O.ar2_forecast_sql(EVAL_QS))
def q_ar2_forecast(spark, d):
    """M4 with p = 2: seasonal AR(2) from Gram sums, rolled forward in the JVM."""
    hist = S.train_part(_grid(spark, d), H)
    return autoreg.ar_p_forecast(hist, H, 2, M_SEASON, None, "1 hour", EVAL_QS)


@register("global_ar", FC_COLS, ["quantile", "value"])
def q_global_ar(spark, d):
    """M5: one pooled regression over all series (lags ≥ H, calendar, category)."""
    hist = S.train_part(_grid(spark, d), H)
    cats = S.static_categories(hist, "item_id")
    return global_ar.global_ar_forecast(hist, H, "1 hour", EVAL_QS, cats, M_SEASON, quantile_method="residual")


@register("global_quantiles", FC_COLS, ["quantile", "value"])
def q_global_quantiles(spark, d):
    """M5 with its quantiles fitted by the check loss: they differ by series and step.  No SQL: the
    rounds stop by the loss; tests compare the fit with a linear program's optimum."""
    hist = S.train_part(_grid(spark, d), H)
    cats = S.static_categories(hist, "item_id")
    return global_ar.global_ar_forecast(hist, H, "1 hour", EVAL_QS, cats, M_SEASON)


_PATHS = O.with_(O.hourly() + O.split() + [O.seasonal_naive()] + O.sample_paths_ctes(),
                 "SELECT model, item_id, step, ts, sample_id, value FROM paths")


@register("sample_paths", ["model", "item_id", "step", "ts", "sample_id", "value"], ["value"], _PATHS)
def q_sample_paths(spark, d):
    """M6: 100 sample paths per series — seasonal naive + hashed residual draws."""
    hist = S.train_part(_grid(spark, d), H)
    point = naive.seasonal_naive(hist, H, M_SEASON, "1 hour", ())
    return samples.sample_paths(point, samples.residual_pool(hist, M_SEASON), 100, 42)


@register("sample_path_quantiles", ["model", "item_id", "step", "q10", "q50", "q70", "q90", "mean", "n"],
          ["q10", "q50", "q70", "q90", "mean"],
          "SELECT model, item_id, step, " + ", ".join(
              f"min(CASE WHEN rn = {r} THEN value END) AS q{q}" for q, r in ((10, 10), (50, 50), (70, 69), (90, 89))) +
          f", avg(value) AS mean, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY model, item_id, step "
          f"ORDER BY value) - 1 AS rn FROM ({_PATHS})) GROUP BY 1, 2, 3")
def q_sample_path_quantiles(spark, d):
    """M6 + A12: nearest-rank quantiles of the sample paths per forecast step."""
    hist = S.train_part(_grid(spark, d), H)
    point = naive.seasonal_naive(hist, H, M_SEASON, "1 hour", ())
    return samples.path_quantiles(point, samples.residual_pool(hist, M_SEASON), (0.1, 0.5, 0.7, 0.9))


@register("ancestral_paths", ["model", "item_id", "step", "ts", "sample_id", "value"], ["value"],
          O.with_(O.hourly() + O.split() + O.ancestral_ctes(), "SELECT model, item_id, step, ts, sample_id, value FROM ancestral"))
def q_ancestral_paths(spark, d):
    """M6: 100 paths per series whose steps depend on one another: every path feeds its own
    draws back through the seasonal AR(2)."""
    return samples.ancestral_paths(S.train_part(_grid(spark, d), H), H, 2, M_SEASON, "1 hour", 100, 42)


@register("arma_orders", ["item_id", "p", "q", "bic", "intercept", "phi1", "phi2", "theta1", "theta2", "sigma", "n"],
          ["bic", "intercept", "phi1", "phi2", "theta1", "theta2", "sigma"],
          O.with_(O.hourly() + O.split() + O.arma_ctes(), "SELECT item_id, p, q, bic, beta[1] AS intercept, beta[2] AS phi1, beta[3] AS phi2, "
                                                          "beta[4] AS theta1, beta[5] AS theta2, sigma, n FROM arma"))
def q_arma_orders(spark, d):
    """M4: the orders with the least information criterion and their coefficients."""
    fit = arma.fit_arma(arma.innovation_rows(S.train_part(_grid(spark, d), H), season_length=M_SEASON))
    return fit.select("*", *[F.col("beta")[k].alias(name) for k, name in enumerate(("intercept", "phi1", "phi2", "theta1", "theta2"))])


@register("arma_forecast", FC_COLS, ["quantile", "value"], O.arma_forecast_sql(EVAL_QS))
def q_arma_forecast(spark, d):
    """M4 with moving-average terms: the chosen ARMA of each series rolled forward."""
    return arma.arma_forecast(S.train_part(_grid(spark, d), H), H, M_SEASON, "1 hour", EVAL_QS)


# ----------------------------------------------------------------------------- daily, long history

@register("orders_daily_series", ["item_id", "ts", "step", "n_steps", "target"], ["target"],
          O.with_(O.orders_daily(), "SELECT item_id, ts, step, n_steps, target FROM series"))
def q_orders_daily_series(spark, d):
    """A1/F2 (daily): order value per priority and day, each series on its own span."""
    return D.orders_daily(spark, d)


@register("lineitem_daily_series", ["item_id", "ts", "step", "n_steps", "target"], ["target"],
          O.with_(O.lineitem_daily(), "SELECT item_id, ts, step, n_steps, target FROM series"))
def q_lineitem_daily_series(spark, d):
    """A1/F2 (daily): shipped quantity per return flag and day."""
    return D.lineitem_daily(spark, d)


DAILY_H, DAILY_M = 28, 7


@register("orders_daily_backtest", ["model", "item_id"] + POINT_COLS, POINT_DOUBLES,
          O.with_(O.orders_daily() + O.split(DAILY_H) + [
              O.seasonal_naive(DAILY_M, DAILY_H, "day"), O.paired("sn")],
              f"SELECT model, item_id, {O.POINT} FROM paired GROUP BY 1, 2"))
def q_orders_daily_backtest(spark, d):
    """B1 on daily order value: 28-day weekly-seasonal-naive backtest per priority."""
    grid = materialize(D.orders_daily(spark, d), "orders_daily", REUSE)
    bt = backtest(grid, lambda h, n: naive.seasonal_naive(h, n, DAILY_M, "1 day", (TARGET_Q,)), DAILY_H)
    return M.point_metrics(bt.paired(TARGET_Q))


@register("user_hourly_backtest", ["model"] + POINT_COLS, POINT_DOUBLES,
          O.with_([O.cells("hour", "user_id")] + O.grid("hour") + O.split() + [O.seasonal_naive(), O.paired("sn")],
                  O.summed()))
def q_user_hourly_backtest(spark, d):
    """B1/A11 over many series: every user's hourly value series (full grid, empty hours
    0), a 72-hour seasonal-naive backtest, scored on the series summed over users."""
    cells = D.events_cells(spark, d, "1 hour", "user_id")
    grid = materialize(S.regularise(cells, "1 hour", fill=0.0, span="global"), "user_hourly", REUSE)
    bt = backtest(grid, _sn, H)
    return M.summed_series_metrics(bt.paired(TARGET_Q))


@register("global_ar_scheduled", FC_COLS, ["quantile", "value"])
def q_global_ar_scheduled(spark, d):
    """M5 with the scheduled preset (168 steps ahead) on the long daily order series:
    lags 168, 175, 182 days, weekly season, fitted on all but the last 168 days."""
    grid = materialize(D.orders_daily(spark, d), "orders_daily", REUSE)
    hist = S.train_part(grid, 168)
    return global_ar.global_ar_forecast(hist, 168, "1 day", EVAL_QS, None, DAILY_M, quantile_method="residual")


# ----------------------------------------------------------------------------- records

@register("series_json_lines", ["item_id", "ts", "step", "target"], ["target"],
          O.with_([O.cells()] + O.grid("hour", "cells", "series", "NULL"), "SELECT item_id, ts, step, target FROM series"))
def q_series_json_lines(spark, d):
    """Hourly series with gaps as JSON records (gaps as NaN text), parsed back
    and exploded."""
    grid = materialize(S.regularise(D.events_cells(spark, d), "1 hour", span="global"), "gappy_hourly", REUSE)
    back = R.parse_series_lines(K.series_lines(S.nest_target(grid)))
    return S.unnest_target(back, "1 hour")


@register("forecast_documents", ["model", "item_id", "step", "ts", "value"], ["value"],
          O.with_(O.hourly() + O.split() + [O.seasonal_naive()] + O.resample(EVAL_QS),
                  "SELECT model, item_id, step, ts, value FROM sn UNION ALL "
                  "SELECT model, item_id, step, ts, value FROM np WHERE quantile = 0.5"))
def q_forecast_documents(spark, d):
    """Two models' forecasts as JSON documents per model and series, the median
    looked up in the parsed quantile map."""
    hist = S.train_part(_grid(spark, d), H)
    fc = naive.seasonal_naive(hist, H, M_SEASON, "1 hour", EVAL_QS).unionByName(_resample(EVAL_QS)(hist, H))
    return R.parse_forecast_documents(K.forecast_documents(fc), "0.5", "1 hour")


@register("drop_zero_actuals", ["model", "item_id", "mpe", "mape"], ["mpe", "mape"],
          O.with_(_UD[:-1], "SELECT model, item_id, avg(CASE WHEN y <> 0 THEN (f - y) / y END) AS mpe, "
                            "avg(CASE WHEN y <> 0 THEN abs(f - y) / abs(y) END) AS mape FROM paired GROUP BY 1, 2"))
def q_drop_zero_actuals(spark, d):
    """P10: the percent errors of the daily user backtest without zero actuals."""
    bt = backtest(materialize(D.events_user_daily(spark, d), "events_user_daily", REUSE),
                  lambda h, n: naive.seasonal_naive(h, n, 7, "1 day", (TARGET_Q,)), 7)
    return M.point_metrics(bt.paired(TARGET_Q), drop_zero_actuals=True).select("model", "item_id", "mpe", "mape")


@register("agg_metrics_json", ["model", "metric", "value"], ["value"],
          O.with_(O.hourly() + O.split() + [O.seasonal_naive(), O.paired("sn")],
                  "SELECT model, unnest(['MAE', 'RMSE']) AS metric, unnest([avg(abs(f - y)), sqrt(avg((f - y) * (f - y)))]) AS value "
                  "FROM paired GROUP BY 1"))
def q_agg_metrics_json(spark, d):
    """K9: a model's metrics as one JSON document, parsed back."""
    paired = backtest(_grid(spark, d), _sn, H).paired(TARGET_Q)
    e = F.col("f") - F.col("y")
    long = (paired.groupBy("model").agg(F.avg(F.abs(e)).alias("MAE"), F.sqrt(F.avg(e * e)).alias("RMSE"))
                  .select("model", F.explode(F.create_map(F.lit("MAE"), "MAE", F.lit("RMSE"), "RMSE")).alias("metric", "value")))
    docs = M.agg_metrics_json(long)
    return docs.select("model", F.explode(F.from_json("json", "map<string,double>")).alias("metric", "value"))


SHORT_H, SHORT_M, SHORT_CTX = 14, 14, 28


@register("short_series_backtest", ["model", "n_series", "rmse", "mae", "mean_y", "n"], ["rmse", "mae", "mean_y"],
          O.with_(O.short_series_ctes(TARGET_Q, SHORT_H, SHORT_M, SHORT_CTX),
                  "SELECT model, count(DISTINCT item_id) AS n_series, sqrt(avg((f - y) * (f - y))) AS rmse, avg(abs(f - y)) AS mae, "
                  "avg(y) AS mean_y, count(*) AS n FROM paired GROUP BY 1"))
def q_short_series_backtest(spark, d):
    """B1/J2/J3 where some histories are shorter than a season: every model forecasts every
    step of every user, so all are scored on the same points."""
    cells = D.events_cells(spark, d, "1 day", "user_id")
    grid = materialize(S.regularise(cells, "1 day", fill=0.0, span="series"), "user_daily_spans", REUSE)
    grid = grid.filter(F.col("n_steps") > SHORT_H)      # without any history there is nothing to forecast from
    qs = (TARGET_Q,)
    bt = backtest_all(grid, {
        "seasonal_naive": lambda h, n: naive.seasonal_naive(h, n, SHORT_M, "1 day", qs),
        "mean": lambda h, n: naive.context_mean(h, n, SHORT_CTX, "1 day", qs),
        "resample": lambda h, n: naive.kernel_resample(h, n, SHORT_CTX, SHORT_M, 0.5, "1 day", qs),
        "seasonal_ar1": lambda h, n: autoreg.ar_forecast(h, n, SHORT_M, None, "1 day", qs)}, SHORT_H)
    paired = bt.paired(TARGET_Q)
    return paired.groupBy("model").agg(
        F.count_distinct("item_id").alias("n_series"), F.sqrt(F.avg((F.col("f") - F.col("y")) ** 2)).alias("rmse"),
        F.avg(F.abs(F.col("f") - F.col("y"))).alias("mae"), F.avg("y").alias("mean_y"), F.count(F.lit(1)).alias("n"))


# ----------------------------------------------------------------------------- R1

@register("incremental_cells", ["item_id", "ts", "target"], ["target"],
          O.with_([O.cells()], "SELECT item_id, ts, target FROM cells"))
def q_incremental_cells(spark, d):
    """Hourly totals per event file, merged over the files in one plan: what the
    incremental ingest holds once every file has arrived.  No state is kept."""
    from tidecast.streaming.ingest import cells_by_file
    return cells_by_file(spark, d, "events", "1 hour", scale=D.MONEY_SCALE)


@register("incremental_refresh", FC_COLS, ["quantile", "value"],
          O.with_([O.cells()] + O.grid_series_span("hour") + [
              ("hist", "SELECT * FROM series"), ("lastrow", "SELECT item_id, n_steps, ts AS t_end FROM hist WHERE step = n_steps - 1")]
              + O.fourier_ctes(EVAL_QS, model="refresh", seasonalities=O.REFRESH_SEASONALITIES), "SELECT * FROM ff"))
def q_incremental_refresh(spark, d):
    """The refreshed forecasts after every week of every event file has arrived as a
    contribution of its own: merged moments give what a full refit gives."""
    from tidecast.streaming.refresh import RefreshSpec, forecast_by_parts
    rows = D.table(spark, d, "events").withColumn(
        "arrival", F.concat_ws("#", F.col("_metadata.file_path"), F.date_trunc("week", "ts").cast("string")))
    return forecast_by_parts(rows, "arrival", RefreshSpec(scale=D.MONEY_SCALE, horizon=H, quantiles=EVAL_QS))
