"""DuckDB SQL for every checkable catalog query — the independent second opinion.

The SQL is written from the operator definitions, not generated from Spark plans.
The driver registers the tables (``events``, ``orders`` …) as views.  Fragments are
composed as named CTEs; each final query returns the same columns, names and types as
its Spark twin in ``tidecast.plans.catalog``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

H, M, C = 72, 24, 168          # notebook preset: horizon, season, context

# Fixed values, stated here again so that a change in the library shows as a difference:
# right-closed histogram edges; (name, period in days, Fourier order, prior scale).
HISTOGRAM_EDGES = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0, 2.0)
SEASONALITIES = (("daily", 1.0, 4, 10.0), ("weekly", 7.0, 3, 0.1))
REFRESH_SEASONALITIES = (("daily", 1.0, 2, 10.0), ("weekly", 7.0, 1, 0.1))
RESAMPLE_DECAY = 0.5


def with_(ctes: Sequence[tuple[str, str]], final: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in ctes) + "\n" + final


def cells(unit: str = "hour", item: str = "event_type", name: str = "cells") -> tuple[str, str]:
    return (name, f"SELECT CAST({item} AS VARCHAR) AS item_id, "
                  f"CAST(date_trunc('{unit}', ts) AS TIMESTAMP) AS ts, "
                  f"CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS target "
                  f"FROM events GROUP BY 1, 2")


def grid(unit: str = "hour", src: str = "cells", name: str = "series", fill: str = "0.0",
         prefix: str = "") -> list[tuple[str, str]]:
    """Global-span grid of ``src`` with GRID columns, gaps filled with ``fill``."""
    p = prefix
    return [
        (f"{p}bounds", f"SELECT min(ts) AS lo, max(ts) AS hi FROM {src}"),
        (f"{p}items", f"SELECT DISTINCT item_id FROM {src}"),
        (f"{p}grid0", f"SELECT i.item_id, b.lo, CAST(date_diff('{unit}', b.lo, b.hi) + 1 AS INTEGER) AS n_steps "
                      f"FROM {p}items i CROSS JOIN {p}bounds b"),
        (f"{p}grid1", f"SELECT item_id, lo, n_steps, CAST(unnest(range(0, n_steps)) AS INTEGER) AS step FROM {p}grid0"),
        (name, f"SELECT g.item_id, CAST(g.lo + to_{unit}s(g.step) AS TIMESTAMP) AS ts, g.step, g.n_steps, "
               f"coalesce(c.target, {fill}) AS target "
               f"FROM {p}grid1 g LEFT JOIN {src} c ON c.item_id = g.item_id AND c.ts = g.lo + to_{unit}s(g.step)"),
    ]


def hourly() -> list[tuple[str, str]]:
    return [cells("hour")] + grid("hour")


def user_daily() -> list[tuple[str, str]]:
    return [cells("day", "user_id")] + grid("day")


def split(h: int = H, src: str = "series") -> list[tuple[str, str]]:
    return [
        ("hist", f"SELECT item_id, ts, step, n_steps - {h} AS n_steps, target FROM {src} WHERE step < n_steps - {h}"),
        ("hold", f"SELECT item_id, ts, step - (n_steps - {h}) + 1 AS h, target FROM {src} WHERE step >= n_steps - {h}"),
        ("lastrow", "SELECT item_id, n_steps, ts AS t_end FROM hist WHERE step = n_steps - 1"),
    ]


def seasonal_naive(m: int = M, h: int = H, unit: str = "hour", name: str = "sn",
                   model: str | None = None) -> tuple[str, str]:
    model = model or f"seasonal_naive_{m}"
    return (name,
            f"SELECT '{model}' AS model, l.item_id, CAST(s.h AS INTEGER) AS step, "
            f"CAST(l.t_end + to_{unit}s(s.h) AS TIMESTAMP) AS ts, CAST(NULL AS DOUBLE) AS quantile, x.target AS value "
            f"FROM lastrow l, (SELECT unnest(range(1, {h + 1})) AS h) s, hist x "
            f"WHERE x.item_id = l.item_id AND x.step = l.n_steps - {m} + ((s.h - 1) % {m})")


def sample_paths_ctes(m: int = M, samples: int = 100, seed: int = 42) -> list[tuple[str, str]]:
    """Each sample adds the residual whose number its hash gives, of all seasonal differences."""
    return [
        ("res0", f"SELECT item_id, step, target - lag(target, {m}) OVER (PARTITION BY item_id ORDER BY step) AS r FROM hist"),
        ("res", "SELECT item_id, r, row_number() OVER (PARTITION BY item_id ORDER BY step) - 1 AS k, "
                "count(*) OVER (PARTITION BY item_id) AS n FROM res0 WHERE r IS NOT NULL"),
        ("sizes", "SELECT DISTINCT item_id, n FROM res"),
        ("drawn", f"SELECT s.*, d.sample_id, CAST('0x' || substr(md5(concat_ws('|', s.item_id, s.step, d.sample_id, {seed})), 1, 8) AS BIGINT) AS u "
                  f"FROM sn s, (SELECT CAST(unnest(range(0, {samples})) AS INTEGER) AS sample_id) d"),
        ("paths", "SELECT d.model, d.item_id, d.step, d.ts, d.sample_id, d.value + res.r AS value FROM drawn d "
                  "JOIN sizes z USING (item_id) JOIN res ON res.item_id = d.item_id AND res.k = d.u % z.n"),
    ]


def context_mean(c: int = C, h: int = H, name: str = "cm", model: str = "mean") -> tuple[str, str]:
    return (name,
            f"SELECT '{model}' AS model, l.item_id, CAST(s.h AS INTEGER) AS step, "
            f"CAST(l.t_end + to_hours(s.h) AS TIMESTAMP) AS ts, CAST(NULL AS DOUBLE) AS quantile, a.v AS value "
            f"FROM lastrow l, (SELECT unnest(range(1, {h + 1})) AS h) s, "
            f"(SELECT item_id, avg(target) AS v FROM hist WHERE step >= n_steps - {c} GROUP BY 1) a "
            f"WHERE a.item_id = l.item_id")


def resample(quantiles: Sequence[float], h: int = H, c: int = C, m: int = M, decay: float = RESAMPLE_DECAY,
         model: str = "resample", name: str = "np") -> list[tuple[str, str]]:
    """Kernel-weighted same-phase resampling; one row per (step, quantile) + mean."""
    qcols = ", ".join(f"min(CASE WHEN cum_w >= {float(q)!r} * tot_w THEN target END) AS v_{i}"
                      for i, q in enumerate(quantiles))
    entries = [f"SELECT item_id, t_end, h0, CAST(NULL AS DOUBLE) AS quantile, v_mean AS value FROM {name}_pp"]
    entries += [f"SELECT item_id, t_end, h0, {float(q)!r} AS quantile, v_{i} AS value FROM {name}_pp"
                for i, q in enumerate(quantiles)]
    return [
        (f"{name}_cand", f"SELECT item_id, ts, target, n_steps, CAST(ts + to_hours(n_steps - 1 - step) AS TIMESTAMP) AS t_end, "
                         f"step % {m} AS phase, exp({-decay!r} * floor((n_steps - 1 - step) / {m})) AS w "
                         f"FROM hist WHERE step >= n_steps - {c} AND target IS NOT NULL"),
        (f"{name}_cw", f"SELECT *, sum(w) OVER (PARTITION BY item_id, phase ORDER BY target, ts "
                       f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_w, "
                       f"sum(w) OVER (PARTITION BY item_id, phase) AS tot_w FROM {name}_cand"),
        (f"{name}_pp0", f"SELECT item_id, phase, max(n_steps) AS n_steps, max(t_end) AS t_end, "
                        f"sum(w * target) / sum(w) AS v_mean, {qcols} FROM {name}_cw GROUP BY 1, 2"),
        (f"{name}_pp", f"SELECT *, ((((phase - (n_steps - 1) - 1) % {m}) + {m}) % {m}) + 1 AS h0 FROM {name}_pp0"),
        (f"{name}_e", " UNION ALL ".join(entries)),
        (name, f"SELECT '{model}' AS model, item_id, CAST(hh AS INTEGER) AS step, "
               f"CAST(t_end + to_hours(hh) AS TIMESTAMP) AS ts, quantile, value "
               f"FROM (SELECT *, unnest(range(h0, {h + 1}, {m})) AS hh FROM {name}_e WHERE h0 <= {h})"),
    ]


def paired(fc: str, q: str = "0.7") -> tuple[str, str]:
    """Point models carry NULL-quantile rows only; they are their own ``q`` quantile."""
    return ("paired", f"SELECT f.model, f.item_id, f.step, f.ts, h.target AS y, f.value AS f FROM {fc} f "
                      f"JOIN hold h ON h.item_id = f.item_id AND h.h = f.step "
                      f"WHERE f.quantile = {q} OR (f.quantile IS NULL AND NOT EXISTS "
                      f"(SELECT 1 FROM {fc} g WHERE g.model = f.model AND g.quantile IS NOT NULL))")


POINT = ("sqrt(avg((f - y) * (f - y))) AS rmse, avg(abs(f - y)) AS mae, "
         "avg(2 * abs(f - y) / (abs(y) + abs(f))) AS smape, avg((f - y) / y) AS mpe, "
         "avg(abs(f - y) / abs(y)) AS mape, avg(y) AS mean_y, count(*) AS n")


def summed(src: str = "paired") -> str:
    return (f"SELECT model, {POINT} FROM (SELECT model, step, sum(y) AS y, sum(f) AS f FROM {src} "
            f"GROUP BY 1, 2) GROUP BY 1")


def seasonal_error(m: int = M, name: str = "se") -> tuple[str, str]:
    return (name, f"SELECT a.item_id, avg(abs(a.target - b.target)) AS seasonal_error FROM "
                  f"(SELECT *, CASE WHEN n_steps > {m} THEN {m} ELSE 1 END AS m FROM hist) a "
                  f"JOIN hist b ON b.item_id = a.item_id AND b.step = a.step - a.m GROUP BY 1")


def item_metrics_sql(fc: str = "np", alpha: float = 0.05) -> list[tuple[str, str]]:
    lo, hi = alpha / 2, 1 - alpha / 2
    k = 2.0 / alpha
    return [
        ("wide", f"SELECT model, item_id, step, max(CASE WHEN quantile IS NULL THEN value END) AS mean, "
                 f"max(CASE WHEN quantile = 0.5 THEN value END) AS med, "
                 f"max(CASE WHEN quantile = {lo!r} THEN value END) AS lo, "
                 f"max(CASE WHEN quantile = {hi!r} THEN value END) AS hi FROM {fc} GROUP BY 1, 2, 3"),
        ("wj", "SELECT w.*, h.target AS y FROM wide w JOIN hold h ON h.item_id = w.item_id AND h.h = w.step"),
        ("per", f"SELECT model, item_id, avg((mean - y) * (mean - y)) AS mse, sum(abs(y - med)) AS abs_error, "
                f"avg(abs(y - med)) AS mae_, sum(abs(y)) AS abs_target_sum, avg(abs(y)) AS abs_target_mean, "
                f"avg(abs(y - med) / abs(y)) AS mape, avg(2 * abs(y - med) / (abs(y) + abs(med))) AS smape, "
                f"avg((hi - lo) + {k!r} * greatest(lo - y, 0.0) + {k!r} * greatest(y - hi, 0.0)) AS interval_ "
                f"FROM wj GROUP BY 1, 2"),
        seasonal_error(),
        ("im", "SELECT p.model, p.item_id, p.mse, p.abs_error, p.abs_target_sum, p.abs_target_mean, "
               "s.seasonal_error, p.mae_ / s.seasonal_error AS mase, p.mape, p.smape, "
               "p.interval_ / s.seasonal_error AS msis FROM per p LEFT JOIN se s ON s.item_id = p.item_id"),
    ]


def quantile_metrics_sql(fc: str = "np", qs: Sequence[float] = (0.1, 0.5, 0.9)) -> tuple[str, str]:
    ql = ", ".join(repr(float(q)) for q in qs)
    return ("qm", f"SELECT f.model, f.item_id, f.quantile, "
                  f"2 * sum(abs((f.value - h.target) * (CASE WHEN h.target <= f.value THEN 1.0 ELSE 0.0 END - f.quantile))) "
                  f"AS quantile_loss, avg(CASE WHEN h.target < f.value THEN 1.0 ELSE 0.0 END) AS coverage "
                  f"FROM {fc} f JOIN hold h ON h.item_id = f.item_id AND h.h = f.step "
                  f"WHERE f.quantile IN ({ql}) GROUP BY 1, 2, 3")


def wql_sql() -> tuple[str, str]:
    return ("wq", "SELECT q.model, q.quantile, q.ql / d.den AS wql, q.coverage FROM "
                  "(SELECT model, quantile, sum(quantile_loss) AS ql, avg(coverage) AS coverage FROM qm GROUP BY 1, 2) q "
                  "JOIN (SELECT model, sum(abs_target_sum) AS den FROM im GROUP BY 1) d ON d.model = q.model")


def fourier_design(freq_days: float = 1.0 / 24, seasonalities=SEASONALITIES) -> list[tuple[str, str]]:
    t = "(epoch_us(ts) / 86400000000.0)"
    cols = [("const", "1.0"), ("trend", f"CAST(step AS DOUBLE) * {freq_days!r}")]
    for name, period, order, _ in seasonalities:
        for k in range(1, order + 1):
            a = 2.0 * math.pi * k / period
            cols.append((f"{name}_sin{k}", f"sin({a!r} * {t})"))
            cols.append((f"{name}_cos{k}", f"cos({a!r} * {t})"))
    return cols


def fourier_penalties(seasonalities=SEASONALITIES) -> list[float]:
    return [1e-6, 1e-6] + [1.0 / (prior * prior) for _, _, order, prior in seasonalities for _ in range(2 * order)]


def gram_pairs(names: Sequence[str]) -> list[tuple[str, str]]:
    """Every unordered pair of the names in their order, each with y, and y with itself."""
    return [(names[i], names[j]) for i in range(len(names)) for j in range(i, len(names))] + [(n, "y") for n in names] + [("y", "y")]


def elimination(name: str, src: str, k: int, keys: str) -> list[tuple[str, str]]:
    """Gauss-Jordan elimination of the ``k x (k+1)`` matrices ``m`` of ``src``, a row of which is left
    per ``keys``: column k+1 then holds the solution, ``beta``."""
    return [(name + "_steps", f"WITH RECURSIVE e AS (SELECT {keys}, 1 AS k, m FROM {src} UNION ALL "
                              f"SELECT {keys}, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / m[k][k]) "
                              f"ELSE list_transform(r, lambda v, j: v - r[k] * m[k][j] / m[k][k]) END) FROM e WHERE k <= {k}) "
                              f"SELECT * FROM e WHERE k = {k + 1}"),
            (name, f"SELECT {keys}, list_transform(m, lambda r: r[{k + 1}]) AS beta FROM {name}_steps")]


def gaussian_z(quantiles: Sequence[float]) -> str:
    rows = [("CAST(NULL AS DOUBLE)", "0.0")] + [(f"CAST({float(q)!r} AS DOUBLE)", repr(NormalDist().inv_cdf(q))) for q in quantiles]
    return " UNION ALL ".join(f"SELECT {q} AS quantile, CAST({z} AS DOUBLE) AS z" for q, z in rows)


def fourier_ctes(quantiles: Sequence[float], h: int = H, unit: str = "hour", freq_days: float = 1.0 / 24, model: str = "fourier",
                 name: str = "ff", z: str = "zf", seasonalities=SEASONALITIES) -> list[tuple[str, str]]:
    """Trend + Fourier ridge on y / mean|y|, solved by elimination; residuals summed row by row."""
    d = fourier_design(freq_days, seasonalities)
    k = len(d)
    vector = "[" + ", ".join(e for _, e in d) + "]"
    pen = "[" + ", ".join(repr(p) for p in fourier_penalties(seasonalities)) + "]"
    return [
        ("fscale", "SELECT item_id, CASE WHEN avg(abs(target)) > 0 THEN avg(abs(target)) ELSE 1.0 END AS s FROM hist GROUP BY 1"),
        ("fx", f"SELECT item_id, target / s AS y, {vector} AS v FROM hist JOIN fscale USING (item_id) WHERE target IS NOT NULL"),
        ("fg", f"SELECT item_id, i, list(g ORDER BY j) AS r FROM (SELECT item_id, i, j, CASE WHEN j > {k} THEN sum(v[i] * y) ELSE sum(v[i] * v[j]) + "
               f"CASE WHEN i = j THEN {pen}[i] ELSE 0.0 END END AS g FROM fx, (SELECT unnest(range(1, {k + 1})) AS i), (SELECT unnest(range(1, {k + 2})) AS j) GROUP BY 1, 2, 3) GROUP BY 1, 2"),
        ("fm", "SELECT item_id, list(r ORDER BY i) AS m FROM fg GROUP BY 1"),
    ] + elimination("fbeta", "fm", k, "item_id") + [
        ("fres", "SELECT item_id, sqrt(avg(power(y - list_dot_product(v, beta), 2))) AS sigma FROM fx JOIN fbeta USING (item_id) GROUP BY 1"),
        ("ffut", f"SELECT l.item_id, CAST(q.h AS INTEGER) AS h, CAST(l.t_end + to_{unit}s(q.h) AS TIMESTAMP) AS ts, l.n_steps - 1 + q.h AS step "
                 f"FROM lastrow l, (SELECT unnest(range(1, {h + 1})) AS h) q"),
        (z, gaussian_z(quantiles)),
        (name, f"SELECT '{model}' AS model, item_id, h AS step, ts, {z}.quantile, s * (list_dot_product({vector}, beta) + {z}.z * sigma) AS value "
               f"FROM ffut JOIN fbeta USING (item_id) JOIN fres USING (item_id) JOIN fscale USING (item_id) CROSS JOIN {z}"),
    ]


def fourier_forecast_sql(quantiles: Sequence[float]) -> str:
    return with_(hourly() + split() + fourier_ctes(quantiles), "SELECT * FROM ff")


def fourier_gram_sql() -> str:
    d = fourier_design()
    names = [n for n, _ in d]
    x = ", ".join(f"{e} AS {n}" for n, e in d)
    exact = {("const", "y"): "CAST(sum(CAST(y AS DECIMAL(18,2))) AS DOUBLE)",
             ("y", "y"): "CAST(sum(CAST(y AS DECIMAL(18,2)) * CAST(y AS DECIMAL(18,2))) AS DOUBLE)"}
    sums = ", ".join(f"{exact.get((a, b), f'sum({a} * {b})')} AS g__{a}__{b}" for a, b in gram_pairs(names))
    unions = " UNION ALL ".join(f"SELECT item_id, '{a}__{b}' AS term_pair, g__{a}__{b} AS value FROM g"
                                for a, b in gram_pairs(names))
    return with_(hourly() + split() + [
        ("x", f"SELECT item_id, target AS y, {x} FROM hist WHERE target IS NOT NULL"),
        ("g", f"SELECT item_id, {sums} FROM x GROUP BY 1"),
    ], unions)


def histogram_sql(src: str, metric: str) -> str:
    e = HISTOGRAM_EDGES
    case = " ".join(f"WHEN {metric} > {float(e[i])!r} AND {metric} <= {float(e[i + 1])!r} THEN {i}"
                    for i in range(len(e) - 1))
    buckets = " UNION ALL ".join(f"SELECT {i} AS bucket, CAST({float(e[i])!r} AS DOUBLE) AS lo, "
                                 f"CAST({float(e[i + 1])!r} AS DOUBLE) AS hi"
                                 for i in range(len(e) - 1))
    return (f"SELECT b.bucket, b.lo, b.hi, CAST(coalesce(c.n, 0) AS BIGINT) AS n FROM ({buckets}) b LEFT JOIN "
            f"(SELECT bkt AS bucket, count(*) AS n FROM (SELECT CASE {case} END AS bkt FROM {src}) "
            f"WHERE bkt IS NOT NULL GROUP BY 1) c ON c.bucket = b.bucket")


def table_cells(table: str, item: str, ts: str, value: str, unit: str = "day",
                name: str = "cells") -> tuple[str, str]:
    return (name, f"SELECT CAST({item} AS VARCHAR) AS item_id, CAST(date_trunc('{unit}', {ts}) AS TIMESTAMP) AS ts, "
                  f"CAST(sum(CAST({value} AS DECIMAL(18,2))) AS DOUBLE) AS target FROM {table} GROUP BY 1, 2")


def grid_series_span(unit: str = "day", src: str = "cells", name: str = "series",
                     fill: str = "0.0") -> list[tuple[str, str]]:
    """Each series on its own first..last grid (span='series')."""
    return [
        ("sbounds", f"SELECT item_id, min(ts) AS lo, CAST(date_diff('{unit}', min(ts), max(ts)) + 1 AS INTEGER) "
                    f"AS n_steps FROM {src} GROUP BY 1"),
        ("sgrid1", "SELECT item_id, lo, n_steps, CAST(unnest(range(0, n_steps)) AS INTEGER) AS step FROM sbounds"),
        (name, f"SELECT g.item_id, CAST(g.lo + to_{unit}s(g.step) AS TIMESTAMP) AS ts, g.step, g.n_steps, "
               f"coalesce(c.target, {fill}) AS target FROM sgrid1 g LEFT JOIN {src} c "
               f"ON c.item_id = g.item_id AND c.ts = g.lo + to_{unit}s(g.step)"),
    ]


def orders_daily() -> list[tuple[str, str]]:
    return [table_cells("orders", "o_orderpriority", "o_orderdate", "o_totalprice")] + grid_series_span("day")


def lineitem_daily() -> list[tuple[str, str]]:
    return [table_cells("lineitem", "l_returnflag", "l_shipdate", "l_quantity")] + grid_series_span("day")


def ar1_ctes(quantiles: Sequence[float], h: int = H, m: int = M, unit: str = "hour",
             model: str = "seasonal_ar1", name: str = "ar1") -> list[tuple[str, str]]:
    """Seasonal AR(1): closed-form difference forecast summed over seasons, Gaussian rows.
    Without variation in the lagged differences the drift is the mean difference; a history
    shorter than a season is forecast by its mean."""
    from statistics import NormalDist
    zs = [("CAST(NULL AS DOUBLE)", "0.0")] + [(f"CAST({float(q)!r} AS DOUBLE)", repr(NormalDist().inv_cdf(q)))
                                              for q in quantiles]
    z_rows = " UNION ALL ".join(f"SELECT {q} AS quantile, CAST({z} AS DOUBLE) AS z" for q, z in zs)
    return [
        ("dd", f"SELECT item_id, step, target - lag(target, {m}) OVER w AS d_t, "
               f"lag(target, 1) OVER w - lag(target, {m + 1}) OVER w AS d_prev FROM hist "
               f"WINDOW w AS (PARTITION BY item_id ORDER BY step)"),
        ("fit", "SELECT item_id, CASE WHEN regr_sxx(d_t, d_prev) > 0 THEN regr_slope(d_t, d_prev) ELSE 0.0 END AS phi, "
                "CASE WHEN regr_sxx(d_t, d_prev) > 0 THEN regr_intercept(d_t, d_prev) ELSE coalesce(avg(d_t), 0.0) END AS c, "
                "regr_count(d_t, d_prev) AS n, "
                "regr_sxx(d_t, d_prev) AS sxx, regr_syy(d_t, d_prev) AS syy, regr_sxy(d_t, d_prev) AS sxy "
                "FROM dd GROUP BY 1"),
        ("fit2", "SELECT item_id, phi, c, CASE WHEN n > 2 AND sxx > 0 THEN "
                 "sqrt(greatest(syy - sxy * sxy / sxx, 0.0) / (n - 2)) END AS sigma FROM fit"),
        ("dlast", "SELECT d.item_id, coalesce(d.d_t, 0.0) AS d_last FROM dd d JOIN hist x "
                  "ON x.item_id = d.item_id AND x.step = d.step WHERE d.step = x.n_steps - 1"),
        ("base", f"SELECT item_id, step - (n_steps - {m}) AS p, target AS y_base, "
                 f"CAST(ts + to_{unit}s(n_steps - 1 - step) AS TIMESTAMP) AS t_end FROM hist "
                 f"WHERE n_steps >= {m} AND step >= n_steps - {m}"),
        ("hs", f"SELECT *, unnest(range(p + 1, {h + 1}, {m})) AS hh FROM base WHERE p + 1 <= {h}"),
        ("terms", f"SELECT hs.item_id, hs.hh, hs.y_base, hs.t_end, hs.p, f.phi, f.c, f.sigma, dl.d_last, "
                  f"unnest(range(0, CAST(floor((hs.hh - hs.p - 1) / {m}) AS BIGINT) + 1)) AS j "
                  f"FROM hs JOIN fit2 f USING (item_id) JOIN dlast dl USING (item_id)"),
        ("dh", f"SELECT *, CAST(hh - j * {m} AS DOUBLE) AS k FROM terms"),
        ("pt", "SELECT item_id, hh, y_base, t_end, p, max(sigma) AS sigma, "
               "sum(CASE WHEN abs(phi - 1.0) < 1e-12 THEN c * k ELSE c * (1.0 - pow(phi, k)) / (1.0 - phi) END "
               "+ pow(phi, k) * d_last) AS dsum FROM dh GROUP BY 1, 2, 3, 4, 5"),
        ("zq", z_rows),
        (name, f"SELECT '{model}' AS model, item_id, CAST(hh AS INTEGER) AS step, CAST(t_end + to_{unit}s(hh) AS TIMESTAMP) AS ts, "
               f"zq.quantile, y_base + dsum + zq.z * coalesce(sigma * sqrt(CAST(floor((hh - p - 1) / {m}) AS DOUBLE) + 1.0), 0.0) "
               f"AS value FROM pt CROSS JOIN zq UNION ALL "
               f"SELECT '{model}', l.item_id, CAST(s.h AS INTEGER), CAST(l.t_end + to_{unit}s(s.h) AS TIMESTAMP), zq.quantile, a.v "
               f"FROM lastrow l, (SELECT unnest(range(1, {h + 1})) AS h) s, (SELECT item_id, avg(target) AS v FROM hist GROUP BY 1) a, zq "
               f"WHERE a.item_id = l.item_id AND l.n_steps < {m}"),
    ]


def ar1_forecast_sql(quantiles: Sequence[float]) -> str:
    return with_(hourly() + split() + ar1_ctes(quantiles), "SELECT * FROM ar1")


def short_series_ctes(q: float, h: int, m: int, c: int) -> list[tuple[str, str]]:
    """Daily totals per user, each on its own span, split off their last ``h`` days; the same
    forecasts as the library's models, histories below ``m`` days included."""
    steps = f"(SELECT unnest(range(1, {h + 1})) AS h)"
    mean = "(SELECT item_id, avg(target) AS v FROM hist GROUP BY 1)"
    at = "CAST(l.t_end + to_days(s.h) AS TIMESTAMP)"
    return [cells("day", "user_id")] + grid_series_span("day") + split(h) + [
        ("sn", f"SELECT 'seasonal_naive' AS model, l.item_id, CAST(s.h AS INTEGER) AS step, {at} AS ts, CAST(NULL AS DOUBLE) AS quantile, "
               f"CASE WHEN l.n_steps >= {m} THEN x.target ELSE a.v END AS value FROM lastrow l JOIN {mean} a USING (item_id) CROSS JOIN {steps} s "
               f"LEFT JOIN hist x ON x.item_id = l.item_id AND x.step = l.n_steps - {m} + ((s.h - 1) % {m})"),
        ("cm", f"SELECT 'mean' AS model, l.item_id, CAST(s.h AS INTEGER) AS step, {at} AS ts, CAST(NULL AS DOUBLE) AS quantile, a.v AS value "
               f"FROM lastrow l JOIN (SELECT item_id, avg(target) AS v FROM hist WHERE step >= n_steps - {c} GROUP BY 1) a USING (item_id) CROSS JOIN {steps} s"),
        ("cand", f"SELECT item_id, ts, target, step % {m} AS phase, exp(-0.5 * floor((n_steps - 1 - step) / {m})) AS w FROM hist WHERE step >= n_steps - {c}"),
        ("cw", "SELECT *, sum(w) OVER (PARTITION BY item_id, phase ORDER BY target, ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_w, "
               "sum(w) OVER (PARTITION BY item_id, phase) AS tot_w FROM cand"),
        ("ph", f"SELECT item_id, phase, min(CASE WHEN cum_w >= {q!r} * tot_w THEN target END) AS v FROM cw GROUP BY 1, 2"),
        ("np", f"SELECT 'resample' AS model, l.item_id, CAST(s.h AS INTEGER) AS step, {at} AS ts, CAST({q!r} AS DOUBLE) AS quantile, coalesce(p.v, a.v) AS value "
               f"FROM lastrow l JOIN {mean} a USING (item_id) CROSS JOIN {steps} s "
               f"LEFT JOIN ph p ON p.item_id = l.item_id AND p.phase = (l.n_steps - 1 + s.h) % {m}"),
    ] + ar1_ctes((q,), h, m, "day") + [
        ("fc", f"SELECT * FROM sn UNION ALL SELECT * FROM cm UNION ALL SELECT * FROM np UNION ALL SELECT * FROM ar1 WHERE quantile = {q!r}"),
        ("paired", "SELECT f.model, f.item_id, f.step, f.ts, h.target AS y, f.value AS f FROM fc f JOIN hold h ON h.item_id = f.item_id AND h.h = f.step"),
    ]


def ar2_forecast_sql(quantiles: Sequence[float], h: int = H, m: int = M, ridge: float = 1e-8,
                     model: str = "seasonal_ar2") -> str:
    """Seasonal AR(2): the differences rolled forward by a recursive CTE, then integrated over
    seasons; Gaussian rows."""
    return with_(hourly() + split(h) + ar2_fit_ctes(m, ridge) + [
        ("roll", "WITH RECURSIVE r(item_id, k, x1, x2) AS ("
                 "SELECT f.item_id, 1, f.c + f.p1 * l.dl1 + f.p2 * l.dl2, l.dl1 FROM fit f JOIN last2 l USING (item_id) "
                 "WHERE l.dl1 IS NOT NULL AND l.dl2 IS NOT NULL "
                 f"UNION ALL SELECT r.item_id, r.k + 1, f.c + f.p1 * r.x1 + f.p2 * r.x2, r.x1 FROM r JOIN fit f "
                 f"USING (item_id) WHERE r.k < {h}) SELECT item_id, k, x1 AS dhat FROM r"),
        ("zq", gaussian_z(quantiles)),
    ] + integrated_ctes("fit", model, "ar2", h, m), "SELECT * FROM ar2")


def integrated_ctes(fit: str, model: str, name: str, h: int = H, m: int = M, unit: str = "hour") -> list[tuple[str, str]]:
    """The season before plus the differences ``roll`` of the seasons passed; sigma from ``fit``."""
    return [
        ("base", f"SELECT item_id, step - (n_steps - {m}) AS p, target AS y_base, "
                 f"CAST(ts + to_{unit}s(n_steps - 1 - step) AS TIMESTAMP) AS t_end FROM hist "
                 f"WHERE n_steps >= {m} AND step >= n_steps - {m}"),
        ("hs", f"SELECT *, unnest(range(p + 1, {h + 1}, {m})) AS hh FROM base WHERE p + 1 <= {h}"),
        ("terms", f"SELECT hs.*, unnest(range(0, CAST(floor((hs.hh - hs.p - 1) / {m}) AS BIGINT) + 1)) AS j FROM hs"),
        ("pt", f"SELECT t.item_id, t.hh, t.y_base, t.t_end, t.p, sum(r.dhat) AS dsum FROM terms t "
               f"JOIN roll r ON r.item_id = t.item_id AND r.k = t.hh - t.j * {m} GROUP BY 1, 2, 3, 4, 5"),
        (name, f"SELECT '{model}' AS model, pt.item_id, CAST(hh AS INTEGER) AS step, CAST(t_end + to_{unit}s(hh) AS TIMESTAMP) AS ts, "
               f"zq.quantile, y_base + dsum + zq.z * coalesce(f.sigma * sqrt(CAST(floor((hh - pt.p - 1) / {m}) AS DOUBLE) + 1.0), 0.0) "
               f"AS value FROM pt JOIN {fit} f USING (item_id) CROSS JOIN zq"),
    ]


def ar2_fit_ctes(m: int = M, ridge: float = 1e-8) -> list[tuple[str, str]]:
    """3×3 ridge normal equations solved by Cramer's rule."""
    r = repr(ridge)
    det = ("(a00*(a11*a22 - a12*a12) - a01*(a01*a22 - a12*a02) + a02*(a01*a12 - a11*a02))")
    return [
        ("d0", f"SELECT item_id, step, n_steps, target - lag(target, {m}) OVER w AS d FROM hist "
               f"WINDOW w AS (PARTITION BY item_id ORDER BY step)"),
        ("d1", "SELECT *, lag(d, 1) OVER w AS l1, lag(d, 2) OVER w AS l2 FROM d0 "
               "WINDOW w AS (PARTITION BY item_id ORDER BY step)"),
        ("g", f"SELECT item_id, count(*) + {r} AS a00, sum(l1) AS a01, sum(l2) AS a02, sum(l1 * l1) + {r} AS a11, "
              f"sum(l1 * l2) AS a12, sum(l2 * l2) + {r} AS a22, sum(d) AS b0, sum(l1 * d) AS b1, sum(l2 * d) AS b2, "
              f"sum(d * d) AS yy, count(*) AS n FROM d1 WHERE d IS NOT NULL AND l1 IS NOT NULL AND l2 IS NOT NULL "
              f"GROUP BY 1"),
        ("sol", f"SELECT item_id, n, yy, b0, b1, b2, a00 - {r} AS g00, a01, a02, a11 - {r} AS g11, a12, a22 - {r} AS g22, "
                f"(b0*(a11*a22 - a12*a12) - a01*(b1*a22 - a12*b2) + a02*(b1*a12 - a11*b2)) / {det} AS c, "
                f"(a00*(b1*a22 - a12*b2) - b0*(a01*a22 - a12*a02) + a02*(a01*b2 - b1*a02)) / {det} AS p1, "
                f"(a00*(a11*b2 - b1*a12) - a01*(a01*b2 - b1*a02) + b0*(a01*a12 - a11*a02)) / {det} AS p2 FROM g"),
        ("fit", "SELECT item_id, c, p1, p2, sqrt(greatest(yy - 2*(c*b0 + p1*b1 + p2*b2) + "
                "(c*c*g00 + p1*p1*g11 + p2*p2*g22 + 2*(c*p1*a01 + c*p2*a02 + p1*p2*a12)), 0.0) / "
                "greatest(n - 3, 1)) AS sigma FROM sol"),
        ("last2", "SELECT item_id, max(CASE WHEN step = n_steps - 1 THEN d END) AS dl1, "
                  "max(CASE WHEN step = n_steps - 2 THEN d END) AS dl2 FROM d0 GROUP BY 1"),
    ]


def ancestral_ctes(m: int = M, h: int = H, samples: int = 100, seed: int = 42) -> list[tuple[str, str]]:
    """Paths of the AR(2) with drawn residuals, step by step: a path's state is its last two
    differences and its last season of values."""
    return ar2_fit_ctes(m) + [
        ("inn", "SELECT d.item_id, d.step, d.d - f.c - f.p1 * d.l1 - f.p2 * d.l2 AS r FROM d1 d JOIN fit f USING (item_id)"),
        ("pool", "SELECT item_id, list(r ORDER BY step) AS pool FROM inn WHERE r IS NOT NULL GROUP BY 1"),
        ("season", f"SELECT item_id, list(target ORDER BY step) AS ys FROM hist WHERE step >= n_steps - {m} GROUP BY 1"),
        ("walk", f"WITH RECURSIVE w(item_id, sample_id, k, x1, x2, ys) AS ("
                 f"SELECT l.item_id, CAST(s.sample_id AS INTEGER), 0, l.dl1, l.dl2, y.ys FROM last2 l JOIN season y USING (item_id), (SELECT unnest(range(0, {samples})) AS sample_id) s "
                 f"UNION ALL SELECT item_id, sample_id, k, d, x1, list_append(ys[2:], ys[1] + d) FROM ("
                 f"SELECT w.item_id, w.sample_id, w.k + 1 AS k, w.x1, w.ys, f.c + f.p1 * w.x1 + f.p2 * w.x2 + p.pool[CAST('0x' || substr(md5(concat_ws('|', w.item_id, w.k + 1, w.sample_id, {seed})), 1, 8) AS BIGINT) % len(p.pool) + 1] AS d "
                 f"FROM w JOIN fit f USING (item_id) JOIN pool p USING (item_id) WHERE w.k < {h})) "
                 f"SELECT item_id, sample_id, k, ys[{m}] AS value FROM w WHERE k > 0"),
        ("ancestral", "SELECT 'ancestral_ar2' AS model, w.item_id, CAST(w.k AS INTEGER) AS step, CAST(l.t_end + to_hours(w.k) AS TIMESTAMP) AS ts, w.sample_id, w.value "
                      "FROM walk w JOIN lastrow l USING (item_id)"),
    ]


def _gram_list(name: str, src: str, k: int, keys: str = "item_id") -> list[tuple[str, str]]:
    """``m``: the k x (k+1) normal equations of ``src`` (vector v, value y) as a list of rows."""
    return [(name + "_r", f"SELECT {keys}, i, list(g ORDER BY j) AS r FROM (SELECT {keys}, i, j, sum(v[i] * (CASE WHEN j > {k} THEN y ELSE v[j] END)) AS g "
                          f"FROM {src}, (SELECT unnest(range(1, {k + 1})) AS i), (SELECT unnest(range(1, {k + 2})) AS j) GROUP BY ALL) GROUP BY ALL"),
            (name, f"SELECT {keys}, list(r ORDER BY i) AS m FROM {name}_r GROUP BY ALL")]


def arma_ctes(m: int = M, max_p: int = 2, max_q: int = 2, long_order: int = 6, ridge: float = 1e-8) -> list[tuple[str, str]]:
    """Both regressions by elimination, residual sums row by row, every order's criterion."""
    k = 1 + max_p + max_q
    lags = ", ".join(f"lag(d, {i}) OVER w AS l{i}" for i in range(1, long_order + 1))
    long_v = ", ".join(["1.0", *[f"l{i}" for i in range(1, long_order + 1)]])
    short = ["1.0", *[f"l{i}" for i in range(1, max_p + 1)], *[f"e{i}" for i in range(1, max_q + 1)]]
    diag = f"list_transform(m, lambda r, i: list_transform(r, lambda v, j: CASE WHEN i = j THEN v + {ridge!r} ELSE v END))"
    used = lambda i: f"({i} = 1 OR ({i} >= 2 AND {i} <= p + 1) OR ({i} >= {max_p + 2} AND {i} <= {max_p + 1} + q))"
    return [
        ("sd", f"SELECT item_id, step, n_steps, target - lag(target, {m}) OVER (PARTITION BY item_id ORDER BY step) AS d FROM hist"),
        ("sl", f"SELECT *, {lags} FROM sd WINDOW w AS (PARTITION BY item_id ORDER BY step)"),
        ("lx", f"SELECT item_id, d AS y, [{long_v}] AS v FROM sl WHERE d IS NOT NULL AND l{long_order} IS NOT NULL"),
    ] + _gram_list("lg", "lx", long_order + 1) + [("lgr", f"SELECT item_id, {diag} AS m FROM lg")] + elimination("lb", "lgr", long_order + 1, "item_id") + [
        ("en", f"SELECT s.*, CASE WHEN l{long_order} IS NOT NULL THEN d - list_dot_product([{long_v}], beta) END AS e FROM sl s JOIN lb USING (item_id)"),
        ("el", "SELECT *, " + ", ".join(f"lag(e, {i}) OVER w AS e{i}" for i in range(1, max_q + 1)) + " FROM en WINDOW w AS (PARTITION BY item_id ORDER BY step)"),
        ("ax", f"SELECT item_id, d AS y, [{', '.join(short)}] AS v FROM el WHERE d IS NOT NULL AND e{max_q} IS NOT NULL AND l{max_p} IS NOT NULL"),
    ] + _gram_list("ag", "ax", k) + [
        ("ao", f"SELECT item_id, CAST(p AS INTEGER) AS p, CAST(q AS INTEGER) AS q, list_transform(m, lambda r, i: list_transform(r, lambda v, j: "
               f"CASE WHEN {used('i')} AND (j = {k + 1} OR {used('j')}) THEN (CASE WHEN i = j THEN v + {ridge!r} ELSE v END) WHEN i = j THEN 1.0 ELSE 0.0 END)) AS m "
               f"FROM ag, (SELECT unnest(range(0, {max_p + 1})) AS p), (SELECT unnest(range(0, {max_q + 1})) AS q)"),
    ] + elimination("ab", "ao", k, "item_id, p, q") + [
        ("ar", "SELECT item_id, p, q, beta, count(*) AS n, sum(power(y - list_dot_product(v, beta), 2)) AS rss FROM ax JOIN ab USING (item_id) GROUP BY ALL"),
        ("ac", "SELECT *, n * ln(rss / n) + (1 + p + q) * ln(n) AS bic FROM ar"),
        ("arma", "SELECT item_id, p, q, bic, beta, sqrt(rss / greatest(n - 1 - p - q, 1)) AS sigma, n FROM "
                 "(SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY bic, p, q) AS place FROM ac) WHERE place = 1"),
    ]


def arma_forecast_sql(quantiles: Sequence[float], h: int = H, m: int = M) -> str:
    return with_(hourly() + split(h) + arma_ctes(m) + [
        ("ends", "SELECT item_id, max(CASE WHEN step = n_steps - 1 THEN d END) AS d1, max(CASE WHEN step = n_steps - 2 THEN d END) AS d2, "
                 "max(CASE WHEN step = n_steps - 1 THEN e END) AS e1, max(CASE WHEN step = n_steps - 2 THEN e END) AS e2 FROM en GROUP BY 1"),
        ("roll", "WITH RECURSIVE r(item_id, k, x1, x2, e1, e2) AS (SELECT item_id, 0, d1, d2, e1, e2 FROM ends "
                 "UNION ALL SELECT r.item_id, r.k + 1, a.beta[1] + a.beta[2] * r.x1 + a.beta[3] * r.x2 + a.beta[4] * r.e1 + a.beta[5] * r.e2, r.x1, 0.0, r.e1 "
                 f"FROM r JOIN arma a USING (item_id) WHERE r.k < {h}) SELECT item_id, k, x1 AS dhat FROM r WHERE k > 0"),
        ("zq", gaussian_z(quantiles)),
    ] + integrated_ctes("arma", "seasonal_arma", "fc", h, m), "SELECT * FROM fc")
