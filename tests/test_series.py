from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import T0, grid_df, hourly_rows, series_df
from tidecast.operators import series as S


def test_c9_mapping_keeps_listed_columns_in_order(spark):
    df = spark.createDataFrame([(1, "2", 3.5)], "a INT, b STRING, c DOUBLE")
    out = S.apply_mapping(df, [("a", "int", "x", "bigint"), ("b", "string", "y", "int")])
    assert out.columns == ["x", "y"]
    assert out.first() == (1, 2)
    assert dict(out.dtypes) == {"x": "bigint", "y": "int"}


def test_regularise_fills_gaps_and_numbers_steps(spark):
    rows = [("a", T0, 1.0), ("a", T0 + timedelta(hours=3), 4.0)]
    g = S.regularise(series_df(spark, rows), "1 hour", fill=0.0).orderBy("step").collect()
    assert [r.step for r in g] == [0, 1, 2, 3]
    assert [r.target for r in g] == [1.0, 0.0, 0.0, 4.0]
    assert {r.n_steps for r in g} == {4}
    ff = S.regularise(series_df(spark, rows), "1H", fill="ffill").orderBy("step").collect()
    assert [r.target for r in ff] == [1.0, 1.0, 1.0, 4.0]


def test_regularise_global_span(spark):
    rows = [("a", T0, 1.0), ("b", T0 + timedelta(hours=2), 2.0)]
    g = S.regularise(series_df(spark, rows), "1 hour", span="global").collect()
    assert len(g) == 6 and {r.n_steps for r in g} == {3}


def test_c16_duplicate_time_is_rejected(spark):
    rows = [("a", T0, 1.0), ("a", T0, 2.0)]
    with pytest.raises(Exception, match="duplicate time"):
        S.regularise(series_df(spark, rows), "1 hour").collect()


def test_c7_short_series_has_empty_train(spark):
    g = grid_df(spark, hourly_rows("a", [1, 2]))
    split = S.holdout_split(g, 3).collect()
    assert sorted(r.split for r in split) == ["holdout", "holdout"]
    assert S.train_part(g, 3).count() == 0


def test_train_and_holdout_partition_the_series(spark):
    g = grid_df(spark, hourly_rows("a", range(10)) + hourly_rows("b", range(7)))
    s = S.holdout_split(g, 3)
    assert s.filter("split = 'holdout'").groupBy("item_id").count().filter("count != 3").count() == 0
    both = S.train_part(g, 3).select("item_id", "ts").unionByName(S.holdout_part(g, 3).select("item_id", "ts"))
    assert both.exceptAll(g.select("item_id", "ts")).count() == 0
    assert g.select("item_id", "ts").exceptAll(both).count() == 0


def test_window_and_grid_paths_agree(spark):
    rows = hourly_rows("a", range(12)) + hourly_rows("b", range(5))
    raw = S.holdout_split(series_df(spark, rows), 4).select("item_id", "ts", "split")
    grd = S.holdout_split(grid_df(spark, rows), 4).select("item_id", "ts", "split")
    assert raw.exceptAll(grd).count() == 0 and grd.exceptAll(raw).count() == 0
    assert S.tail(series_df(spark, rows), 2).count() == 4


def test_context_is_just_before_holdout(spark):
    g = grid_df(spark, hourly_rows("a", range(10)))
    c = [r.target for r in S.context(g, 3, 2).orderBy("ts").collect()]
    assert c == [5.0, 6.0, 7.0]


def test_filter_min_length(spark):
    s = series_df(spark, hourly_rows("a", range(5)) + hourly_rows("b", range(2)))
    assert {r.item_id for r in S.filter_min_length(s, 3).collect()} == {"a"}


def test_nest_unnest_roundtrip_keeps_nulls_in_place(spark):
    g = grid_df(spark, hourly_rows("a", [1, None, 3]))
    nested = S.nest_target(g)
    assert nested.first().target == [1.0, None, 3.0]
    back = S.unnest_target(nested, "1 hour").select("item_id", "ts", "step", "target")
    assert back.exceptAll(g.select("item_id", "ts", "step", "target")).count() == 0


def test_c5_strict_sum(spark):
    rows = [("A", T0, 1.0), ("A", T0 + timedelta(hours=1), 2.0),
            ("B", T0 + timedelta(hours=1), 3.0), ("B", T0 + timedelta(hours=2), 4.0)]
    out = {r.ts: r.target for r in S.sum_across_series(series_df(spark, rows)).collect()}
    assert out == {T0: None, T0 + timedelta(hours=1): 5.0, T0 + timedelta(hours=2): None}


def test_c15_feature_mean_uses_training_count(spark):
    cov = spark.createDataFrame([("a", T0, 0, 2.0), ("b", T0, 0, 6.0)],
                                "item_id STRING, ts TIMESTAMP_NTZ, feat_index INT, value DOUBLE")
    assert S.mean_feature_across_series(cov, 4).first().value == 2.0


def test_label_boundaries(spark):
    g = grid_df(spark, hourly_rows("a", range(6)))
    seg = [r.segment for r in S.label_boundaries(g, S.train_part(g, 4), S.train_part(g, 2)).orderBy("ts").collect()]
    assert seg == ["train", "train", "test", "test", "predict", "predict"]


def test_group_multivariate_fills_with_series_mean(spark):
    rows = [("a", T0, 1.0), ("a", T0 + timedelta(hours=2), 3.0), ("b", T0 + timedelta(hours=1), 5.0)]
    mv = S.group_multivariate(series_df(spark, rows), "1 hour")
    vec = {r.ts: r.target for r in S.to_vectors(mv).collect()}
    assert vec[T0] == [1.0, 5.0] and vec[T0 + timedelta(hours=1)] == [2.0, 5.0]


def test_static_categories_dense_codes(spark):
    s = series_df(spark, hourly_rows("b", [1]) + hourly_rows("a", [1]))
    cats = {r.item_id: r.category for r in S.static_categories(s, "item_id").collect()}
    assert cats == {"a": 0, "b": 1}


def test_calendar_covariates_and_join(spark):
    g = grid_df(spark, hourly_rows("a", [1, 2]))
    wide = S.join_covariates(g, S.calendar_covariates(g), 2).orderBy("ts").collect()
    assert [r.feat_0 for r in wide] == [0.0, 1.0]
    assert wide[0].feat_1 == 0.0  # 2024-01-01 is a Monday


def test_describe_and_first_series(spark):
    s = series_df(spark, hourly_rows("b", range(3)) + hourly_rows("a", range(2)))
    d = S.describe_series(s).first()
    assert (d.n_series, d.n_points, d.min_length, d.max_length) == (2, 5, 2, 3)
    assert {r.item_id for r in S.first_series(s).collect()} == {"a"}
    assert S.series_start(s).filter(F.col("item_id") == "a").first().start == T0


def test_group_multivariate_has_no_cap(spark):
    import pytest
    rows = [(f"i{k:03d}", T0 + timedelta(hours=k % 3), float(k)) for k in range(150)]
    mv = S.group_multivariate(series_df(spark, rows), "1 hour")
    assert {(r.item_id, r.dim) for r in mv.select("item_id", "dim").distinct().collect()} == {(f"i{k:03d}", k) for k in range(150)}
    assert mv.count() == 450
    with pytest.raises(Exception, match="more than 96 dimensions"):
        S.to_vectors(mv).collect()
    assert len(S.to_vectors(mv, 150).first().target) == 150


def test_readings_beside_the_grid_fail(spark):
    import pytest
    rows = [("a", T0, 1.0), ("a", T0 + timedelta(minutes=90), 2.0), ("a", T0 + timedelta(hours=3), 3.0)]
    with pytest.raises(Exception, match="no grid place for item a at 2024-01-01 01:30"):
        S.regularise(series_df(spark, rows), "1 hour").collect()
    with pytest.raises(Exception, match="no grid place"):
        S.regularise(series_df(spark, [rows[0], rows[2]]), "1 hour", end=T0 + timedelta(hours=2)).collect()


def test_last_rows_with_ties(spark):
    rows = [("a", T0, 1.0)] * 3 + [("a", T0 - timedelta(hours=1), 5.0), ("b", T0, 2.0)]
    raw = series_df(spark, rows)
    assert S.tail(raw, 1).count() == 2 and S.tail(raw, 2).count() == 3
    split = S.holdout_split(raw, 2).groupBy("item_id", "split").count().collect()
    assert {(r.item_id, r.split): r["count"] for r in split} == {("a", "holdout"): 2, ("a", "train"): 2, ("b", "holdout"): 1}


def test_cells_are_plain_sums_by_default(spark):
    import pytest
    rows = [("a", T0, 0.004), ("a", T0, 0.004), ("b", T0, 1e17)]
    got = {r.item_id: r.target for r in S.aggregate_cells(series_df(spark, rows), "1 hour").collect()}
    assert got == {"a": 0.008, "b": 1e17}
    with pytest.raises(ValueError):
        S.aggregate_cells(series_df(spark, rows), "1 hour", "exact_sum")


def test_to_series_takes_a_column_as_item(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", 1.5, "x")], "at STRING, v DOUBLE, k STRING")
    r = S.to_series(df, "at", item_id=F.upper("k")).first()
    assert (r.item_id, r.target) == ("X", 1.5)
