"""Series reshaping: mapping, regular grids, splits, nesting, cross-series alignment.

Forms (see ``tidecast.schema``): a *series* frame has ``item_id, ts, target``; a
*grid* frame is a series put on a regular time grid by :func:`regularise` and also
carries ``step`` (0-based position) and ``n_steps`` (length of that series).

On a grid every positional question ("last H points", "phase within a season") is a
filter on ``step``/``n_steps``, so no window and no extra shuffle is needed.  Raw
(ungridded) series fall back to a per-series window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.functions.arith import exact_sum
from tidecast.functions.time import add_steps, bucket, freq_micros, steps_between, to_micros

GRID_COLUMNS = ["item_id", "ts", "step", "n_steps", "target"]


def is_grid(df: DataFrame) -> bool:
    return "step" in df.columns and "n_steps" in df.columns


# --------------------------------------------------------------------------- mapping

def apply_mapping(df: DataFrame, mappings: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Keep, rename and cast columns by a list of ``(source, source_type, target, target_type)``.

    Only listed columns survive, in list order.  ``source_type`` documents the input;
    the cast is to ``target_type``.  Catalyst prunes the scan to the listed sources.
    """
    cols = []
    for src, _src_type, tgt, tgt_type in mappings:
        cols.append(F.col(src).cast(tgt_type).alias(tgt))
    return df.select(*cols)


def to_series(df: DataFrame, ts: str, value: str | None = None,
              item_id: str | Column | None = None) -> DataFrame:
    """Pick the time column as key and a value column (default: first other column)."""
    if value is None:
        item_name = item_id if isinstance(item_id, str) else None
        value = next(c for c in df.columns if c not in (ts, item_name))
    if item_id is None:
        item = F.lit("0")
    elif isinstance(item_id, str):
        item = F.col(item_id).cast("string")
    else:
        item = item_id.cast("string")
    return df.select(item.alias("item_id"), F.col(ts).cast("timestamp_ntz").alias("ts"),
                     F.col(value).cast("double").alias("target"))


def canonicalise(nested: DataFrame) -> DataFrame:
    """Rename record fields to the canonical names (``id`` → ``item_id`` …)."""
    renames = {"id": "item_id", "feat_static_cat": "cat", "feat_dynamic_real": "dynamic_feat"}
    return nested.withColumnsRenamed({k: v for k, v in renames.items() if k in nested.columns})


# --------------------------------------------------------------------------- grids

def aggregate_cells(df: DataFrame, freq: str, how: str = "sum", scale: int | None = None) -> DataFrame:
    """Floor ``ts`` to ``freq`` cells and aggregate ``target`` per ``(item_id, cell)``.

    ``exact_sum`` needs the number of decimals of the values (``scale``); it is for money
    tables, where the sum must not depend on the order of addition.

    Partial (map-side) aggregation runs before the shuffle, so a hot item costs one
    row per cell per task, not one row per event.
    """
    if (how == "exact_sum") != (scale is not None):
        raise ValueError("exact_sum, and only it, takes a scale")
    agg = {
        "exact_sum": exact_sum("target", scale or 0),
        "sum": F.sum("target"),
        "mean": F.avg("target"),
        "count": F.count("target").cast("double"),
        "last": F.max_by("target", "ts"),
    }[how]
    return (df.withColumn("cell", bucket("ts", freq))
              .groupBy("item_id", F.col("cell").alias("ts"))
              .agg(agg.alias("target")))


def _unique_cells(series: DataFrame) -> DataFrame:
    """One row per ``(item_id, ts)``; a duplicate fails the job with a clear message.

    When the input already comes from an aggregate on the same keys Spark reuses its
    partitioning and adds no shuffle.
    """
    return (series.groupBy("item_id", "ts")
                  .agg(F.count(F.lit(1)).alias("_n"), F.first("target").alias("target"))
                  .select("item_id", "ts",
                          F.when(F.col("_n") > 1,
                                 F.raise_error(F.concat(
                                     F.lit("regularise: duplicate time for item "),
                                     F.col("item_id"), F.lit(" at "),
                                     F.col("ts").cast("string"))).cast("double"))
                           .otherwise(F.col("target")).alias("target")))


def regularise(series: DataFrame, freq: str = "1 hour", fill=None, span: str = "series",
               start=None, end=None, check_unique: bool = True) -> DataFrame:
    """Put every series on a full grid ``lo, lo+freq, …, hi``.

    span='series'  each series from its own first to last time (default)
    span='global'  every series over the overall first..last time of the frame; the
                   two bounds are scalar subqueries, so no cross join is planned
    start/end      fixed bounds (like ``date_range(start, periods, freq)``)

    fill: None (NULL), a number, or 'ffill' (last observed value).  Input times must
    already sit on the grid (see :func:`aggregate_cells`): a time beside it, or outside
    ``start``/``end``, fails the job.  Output: GRID columns.
    """
    cells = _unique_cells(series) if check_unique else series.select("item_id", "ts", "target")
    phase = F.pmod(to_micros("ts"), F.lit(freq_micros(freq)))
    seen = cells.groupBy("item_id").agg(
        F.array_sort(F.collect_list(F.struct("ts", "target"))).alias("cells"),
        F.min("ts").alias("first"), F.max("ts").alias("last"), F.min(phase).alias("low_phase"), F.max(phase).alias("high_phase"),
        F.min_by("ts", phase).alias("low_at"), F.max_by("ts", phase).alias("high_at"), F.max(F.col("ts").isNull()).alias("no_time"))
    if start is not None or end is not None:
        lo = F.lit(start).cast("timestamp_ntz") if start is not None else F.col("first")
        hi = F.lit(end).cast("timestamp_ntz") if end is not None else F.col("last")
    elif span == "global":
        lo, hi = cells.agg(F.min("ts")).scalar(), cells.agg(F.max("ts")).scalar()
    elif span == "series":
        lo, hi = F.col("first"), F.col("last")
    else:
        raise ValueError("span must be 'series' or 'global'")
    bounds = seen.withColumns({"lo": lo, "hi": hi}).withColumn("phase", F.pmod(to_micros("lo"), F.lit(freq_micros(freq))))

    # a cell without a place on the grid must not vanish: the phases and the ends of a series'
    # times tell whether there is one, so no cell is compared with the grid
    beside = (F.when(F.col("no_time") | F.col("lo").isNull(), F.lit("NULL")).when(F.col("first") < F.col("lo"), F.col("first").cast("string"))
              .when(F.col("last") > F.col("hi"), F.col("last").cast("string")).when(F.col("low_phase") != F.col("phase"), F.col("low_at").cast("string"))
              .when(F.col("high_phase") != F.col("phase"), F.col("high_at").cast("string")).when(F.col("item_id").isNull(), F.col("first").cast("string")))
    n_steps = F.when(beside.isNotNull(), F.raise_error(F.concat(
        F.lit("regularise: no grid place for item "), F.coalesce("item_id", F.lit("NULL")), F.lit(" at "), beside)).cast("int")).otherwise(
        steps_between("lo", "hi", freq) + 1)
    # each cell is followed by the grid's places up to the next one, so a series is shuffled as its
    # cells and not as its grid
    placed = (bounds.withColumn("n_steps", n_steps)
              .withColumn("cells", F.transform("cells", lambda c: F.struct(steps_between("lo", c["ts"], freq).alias("at"), c["target"].alias("target"))))
              .withColumn("cell", F.explode(F.transform("cells", lambda c, i: F.struct(
                  F.when(i == 0, F.lit(0)).otherwise(c["at"]).alias("from"), c["at"].alias("at"), c["target"].alias("target"),
                  F.greatest(c["at"], F.coalesce(F.get("cells", i + 1)["at"], F.col("n_steps")) - 1).alias("to"))))))
    out = (placed.withColumn("step", F.explode(F.sequence("cell.from", "cell.to")))
           .select("item_id", add_steps(F.col("lo"), F.col("step"), freq).alias("ts"), F.col("step").cast("int").alias("step"), F.col("n_steps").cast("int").alias("n_steps"),
                   F.when(F.col("step") == F.col("cell.at"), F.col("cell.target")).alias("target")))
    if fill is None:
        pass
    elif fill == "ffill":
        w = Window.partitionBy("item_id").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
        out = out.withColumn("target", F.last("target", ignorenulls=True).over(w))
    else:
        out = out.withColumn("target", F.coalesce(F.col("target"), F.lit(float(fill))))
    return out.select(*GRID_COLUMNS)


# --------------------------------------------------------------------------- positions

def _latest() -> tuple[Column, Column]:
    return F.col("ts").desc(), F.col("target").desc()


def with_reverse_rank(series: DataFrame, name: str = "rank_from_end") -> DataFrame:
    """1 for the last point of each series, 2 for the one before, ….

    Grid frames get it by arithmetic; raw frames by a per-series window ordered by
    time (ties broken by ``target``).  With a filter ``rank <= n`` behind it Spark keeps
    only ``n`` rows per series and task before the shuffle (see :func:`tail`).
    """
    if is_grid(series):
        return series.withColumn(name, F.col("n_steps") - F.col("step"))
    return series.withColumn(name, F.row_number().over(Window.partitionBy("item_id").orderBy(*_latest())))


def last_n_threshold(series: DataFrame, n: int) -> DataFrame:
    """Per series, the ``(ts, target)`` key of its n-th most recent row (or its oldest row
    when shorter than ``n``) and how many of the last ``n`` rows have that key.  Only ``n``
    rows per series and task are shuffled."""
    ranked = with_reverse_rank(series.select("item_id", "ts", "target"), "_r").filter(F.col("_r") <= n)
    key = F.struct(F.col("ts"), F.col("target"))
    last = ranked.groupBy("item_id", "ts", "target").agg(F.count(F.lit(1)).alias("_ties"))
    return last.groupBy("item_id").agg(F.min(key).alias("_threshold"), F.min_by("_ties", key).alias("_ties"))


def holdout_split(series: DataFrame, horizon: int) -> DataFrame:
    """Mark the last ``horizon`` points of each series ``holdout``, the rest ``train``.

    A series of length ≤ horizon has no train rows, as slicing ``[:-H]`` gives.  Grid
    frames decide by arithmetic; raw frames by a per-series threshold (no series is ranked
    whole in one task).  Of rows that tie with the threshold as many are held out as make
    ``horizon`` rows in all.
    """
    def mark(last: Column) -> Column:
        return F.when(last, F.lit("holdout")).otherwise(F.lit("train"))

    if is_grid(series):
        return series.withColumn("split", mark((F.col("n_steps") - F.col("step")) <= horizon))
    j = series.join(last_n_threshold(series, horizon), "item_id", "left")
    key = F.struct(F.col("ts"), F.col("target"))
    # rows that share the threshold's key: as many as belong to the last ones
    tie = key.eqNullSafe(F.col("_threshold"))
    nth = F.row_number().over(Window.partitionBy("item_id").orderBy("ts"))
    ties = j.filter(tie).withColumn("split", mark(nth <= F.col("_ties")))
    rest = j.filter(~tie).withColumn("split", mark(key > F.col("_threshold")))
    return rest.unionByName(ties).drop("_threshold", "_ties")


def train_part(grid: DataFrame, horizon: int) -> DataFrame:
    """History before the holdout, as a grid with ``n_steps`` shortened by ``horizon``."""
    return (grid.filter(F.col("step") < F.col("n_steps") - horizon)
                .withColumn("n_steps", (F.col("n_steps") - horizon).cast("int")))


def holdout_part(grid: DataFrame, horizon: int) -> DataFrame:
    """The last ``horizon`` points with their forecast step 1..H (``h``)."""
    return (grid.filter(F.col("step") >= F.col("n_steps") - horizon)
                .withColumn("h", (F.col("step") - (F.col("n_steps") - horizon) + 1).cast("int")))


def tail(series: DataFrame, n: int) -> DataFrame:
    """The last ``n`` points of every series (labels, plot context, truncation)."""
    ranked = with_reverse_rank(series, "_rank")
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def context(grid: DataFrame, n: int, horizon: int = 0) -> DataFrame:
    """The ``n`` points just before the last ``horizon`` ones (a model's context window)."""
    return tail(train_part(grid, horizon) if horizon else grid, n)


def filter_min_length(series: DataFrame, n: int) -> DataFrame:
    """Keep series with at least ``n`` points: partial count per item + left-semi join."""
    keep = series.groupBy("item_id").count().filter(F.col("count") >= n).select("item_id")
    return series.join(keep, "item_id", "left_semi")


def one_series(series: DataFrame, item_id: str) -> DataFrame:
    return series.filter(F.col("item_id") == F.lit(item_id))


def first_series(series: DataFrame) -> DataFrame:
    """All rows of the first series (smallest ``item_id``); the bound is a scalar subquery."""
    first = series.agg(F.min("item_id")).scalar()
    return series.filter(F.col("item_id") == first)


def sort_by_time(series: DataFrame) -> DataFrame:
    return series.orderBy("item_id", "ts")


def series_start(series: DataFrame) -> DataFrame:
    return series.groupBy("item_id").agg(F.min("ts").alias("start"))


def describe_series(series: DataFrame) -> DataFrame:
    """Number of series, number of points, shortest and longest series (one row)."""
    per = series.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.count(F.lit(1)).alias("n_series"),
                   F.sum("n").cast("long").alias("n_points"),
                   F.min("n").cast("long").alias("min_length"),
                   F.max("n").cast("long").alias("max_length"))


# --------------------------------------------------------------------------- nesting

def nest_target(series: DataFrame, value: str = "target") -> DataFrame:
    """Collect each series into ``(item_id, start, target ARRAY<DOUBLE>)`` (A2).

    The array holds one element per grid step, so its size is bounded by the series'
    time span, not by the data volume.  ``struct(ts, value)`` keeps NULLs in place.
    """
    return (series.groupBy("item_id")
                  .agg(F.min("ts").alias("start"),
                       F.transform(F.array_sort(F.collect_list(F.struct("ts", value))),
                                   lambda x: x[value]).alias("target")))


def nest_features(cov: DataFrame) -> DataFrame:
    """COVARIATE long table → ``dynamic_feat ARRAY<ARRAY<DOUBLE>>`` per item."""
    per_channel = (cov.groupBy("item_id", "feat_index")
                      .agg(F.transform(F.array_sort(F.collect_list(F.struct("ts", "value"))),
                                       lambda x: x["value"]).alias("values")))
    return (per_channel.groupBy("item_id")
                       .agg(F.transform(F.array_sort(F.collect_list(F.struct("feat_index", "values"))),
                                        lambda x: x["values"]).alias("dynamic_feat")))


def unnest_target(nested: DataFrame, freq: str = "1 hour", keep: dict[str, Column] | None = None) -> DataFrame:
    """``start + k·freq`` for every element of ``target`` (P12); long form with ``step`` and the
    record's ``keep`` columns."""
    keep = keep or {}
    return (nested.select("item_id", "start", *[c.alias(n) for n, c in keep.items()], F.posexplode("target").alias("step", "target"))
                  .select("item_id", add_steps(F.col("start"), F.col("step"), freq).alias("ts"),
                          F.col("step").cast("int").alias("step"), "target", *keep))


def unnest_feature(nested: DataFrame, feat_index: int | None = None,
                   freq: str = "1 hour") -> DataFrame:
    """Dynamic-feature channel(s) back to COVARIATE rows (P13); all channels if None."""
    if feat_index is not None:
        ch = nested.select("item_id", "start", F.lit(feat_index).alias("feat_index"),
                           F.col("dynamic_feat")[feat_index].alias("values"))
    else:
        ch = nested.select("item_id", "start",
                           F.posexplode("dynamic_feat").alias("feat_index", "values"))
    return (ch.select("item_id", "start", "feat_index",
                      F.posexplode("values").alias("step", "value"))
              .select("item_id", add_steps(F.col("start"), F.col("step"), freq).alias("ts"),
                      F.col("feat_index").cast("int").alias("feat_index"), "value"))


# --------------------------------------------------------------------------- across series

def sum_across_series(series: DataFrame, strict: bool = True) -> DataFrame:
    """Point-wise sum over series on the shared time index (A3).

    strict: a time missing from any series gives NULL (aligned-add semantics), not a
    partial sum.  The series count is a scalar subquery; the sum is a partial aggregate
    per time, so the number of series per time never sits in one task.
    """
    n_series = series.agg(F.count_distinct("item_id")).scalar()
    per_ts = series.groupBy("ts").agg(F.sum("target").alias("s"),
                                      F.count("target").alias("n"))
    value = F.when(F.col("n") == n_series, F.col("s")) if strict else F.col("s")
    return per_ts.select("ts", value.alias("target"))


def mean_feature_across_series(cov: DataFrame, n_series: Column | int,
                               feat_index: int | None = None) -> DataFrame:
    """Point-wise feature sum divided by a *given* series count (A4).

    The divisor is the number of training series even when ``cov`` holds fewer, as in
    the workload.
    """
    if feat_index is not None:
        cov = cov.filter(F.col("feat_index") == feat_index)
    div = n_series if isinstance(n_series, Column) else F.lit(n_series)
    return (cov.groupBy("ts", "feat_index")
               .agg(F.sum("value").alias("s"))
               .select("ts", "feat_index", (F.col("s") / div.cast("double")).alias("value")))


def calendar_covariates(grid: DataFrame) -> DataFrame:
    """COVARIATE rows for the two dynamic channels: hour of day (0), day of week (1)."""
    from tidecast.functions.features import calendar_features
    feats = calendar_features("ts")
    arr = F.array(*[F.struct(F.lit(i).alias("feat_index"), c.alias("value"))
                    for i, (_, c) in enumerate(feats)])
    return (grid.select("item_id", "ts", F.explode(arr).alias("f"))
                .select("item_id", "ts", F.col("f.feat_index").cast("int").alias("feat_index"),
                        F.col("f.value").alias("value")))


def join_covariates(series: DataFrame, cov: DataFrame, n_features: int,
                    cat: DataFrame | None = None) -> DataFrame:
    """Attach dynamic features (pivoted to ``feat_<i>``) and static categories."""
    wide = (cov.groupBy("item_id", "ts").pivot("feat_index", list(range(n_features)))
               .agg(F.first("value")))
    wide = wide.withColumnsRenamed({str(i): f"feat_{i}" for i in range(n_features)})
    out = series.join(wide, ["item_id", "ts"], "left")
    if cat is not None:
        out = out.join(cat, "item_id", "left")
    return out


def static_categories(df: DataFrame, category: str, cat_index: int = 0) -> DataFrame:
    """``(item_id, cat_index, category INT)``: dense index of a categorical column.

    The item table is joined to the dictionary of distinct values; no broadcast hint: AQE
    broadcasts it only when its measured size is under the threshold.  NULL is a category.
    """
    dictionary = dense_index(df.select(F.col(category).alias("_value")).distinct(), "_value", "category_code")
    pairs = df.select("item_id", category).distinct()
    return (pairs.join(dictionary, pairs[category].eqNullSafe(dictionary["_value"]))
                 .select("item_id", F.lit(cat_index).alias("cat_index"),
                         F.col("category_code").alias("category")))


def dense_index(values: DataFrame, column: str, name: str) -> DataFrame:
    """``values`` (distinct in ``column``) with its place in sorted order, from 0.

    Rows are range-partitioned and numbered within their partition; only the row counts of
    the partitions pass through one task.
    """
    from tidecast.session import materialize
    # kept, so that both branches below see one cut into ranges
    placed = materialize(values.repartitionByRange(column).withColumn("_part", F.spark_partition_id()), name, "persist")
    before = F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).select("_part", before.alias("_before"))
    nth = F.row_number().over(Window.partitionBy("_part").orderBy(column))
    return (placed.withColumn("_nth", nth).join(starts, "_part")
                  .withColumn(name, (F.col("_before") + F.col("_nth") - 1).cast("int")).drop("_part", "_nth", "_before"))


def label_boundaries(predict: DataFrame, train_end: DataFrame, test_end: DataFrame) -> DataFrame:
    """Mark each point ``train`` (≤ end of train), ``test`` (≤ end of test) or ``predict``.

    ``train_end``/``test_end`` are series frames; only their per-series last time is used.
    """
    te = train_end.groupBy("item_id").agg(F.max("ts").alias("train_end"))
    se = test_end.groupBy("item_id").agg(F.max("ts").alias("test_end"))
    return (predict.join(te, "item_id", "left").join(se, "item_id", "left")
                   .withColumn("segment",
                               F.when(F.col("ts") <= F.col("train_end"), F.lit("train"))
                                .when(F.col("ts") <= F.col("test_end"), F.lit("test"))
                                .otherwise(F.lit("predict")))
                   .drop("train_end", "test_end"))


def group_multivariate(series: DataFrame, freq: str = "1 hour", money_scale: int | None = None) -> DataFrame:
    """Align all series on one time grid (J6), long form ``(ts, dim, item_id, value)``.

    Dimensions are the items in sorted order, all of them.  Every dimension is put on the
    overall time grid; a missing time takes the mean of that series' observed values
    (``money_scale``: decimals of the values, to sum them exactly first).
    """
    dims = dense_index(series.select("item_id").distinct(), "item_id", "dim")
    mean = (exact_sum("target", money_scale) / F.count("target")) if money_scale is not None else F.avg("target")
    means = series.groupBy("item_id").agg(mean.alias("fill")).join(dims, "item_id")
    grid = regularise(series.select("item_id", "ts", "target"), freq=freq, span="global")
    # both are dealt by item; hashed, so that the grid is not sorted
    return (grid.join(means.hint("shuffle_hash"), "item_id")
                .select("ts", "dim", "item_id",
                        F.coalesce(F.col("target"), F.col("fill")).alias("value")))


def to_vectors(multivariate: DataFrame, max_dim: int = 96) -> DataFrame:
    """``(ts, target ARRAY<DOUBLE>)`` ordered by dim; more than ``max_dim`` dimensions, whose
    array would not fit a row, fail the job."""
    checked = multivariate.withColumn("value", F.when(F.col("dim") >= max_dim, F.raise_error(F.format_string(
        f"to_vectors: more than {max_dim} dimensions (%s)", F.col("item_id"))).cast("double")).otherwise(F.col("value")))
    return (checked.groupBy("ts")
                   .agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "value"))),
                                    lambda x: x["value"]).alias("target")))
