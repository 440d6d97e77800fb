"""Small tables with known answers for the cases that differ between engines."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cardloom.functions import clean, dates
from cardloom.operators import aggregate, encode, folds, joins, metrics, pivots, text, windows


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_mode_takes_the_smallest_value_on_ties_and_counts_missing(spark):
    rows = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, None), (2, None), (2, "z")], "k int, v string")
    table = aggregate.category_profile(rows, ["k"], ["v"])
    assert rows_of(table) == [(1, "a", 2, 0.5, 0.5), (2, None, 2, 2 / 3, 2 / 3)]


def test_statistics_of_missing_and_single_row_groups(spark):
    rows = spark.createDataFrame([(1, None), (1, None), (2, 5.0), (3, 2.0), (3, 2.0), (3, 2.0), (None, 9.0)], "k int, v double")
    table = aggregate.multi_agg(rows, ["k"], [("v", ["size", "count", "sum", "mean", "var", "skew", "median", "nunique"])])
    assert rows_of(table) == [(1, 2, 0, 0.0, None, None, None, None, 0), (2, 1, 1, 5.0, 5.0, None, None, 5.0, 1),
                              (3, 3, 3, 6.0, 2.0, 0.0, 0.0, 2.0, 1)]


def test_corrected_skewness(spark):
    rows = spark.createDataFrame([(1, x) for x in (1.0, 2.0, 3.0, 10.0)], "k int, v double")
    value = aggregate.multi_agg(rows, ["k"], [("v", ["skew"])]).first()["v_skew"]
    assert value == pytest.approx(1.763632614803888)


def test_repeated_output_column_is_refused(spark):
    rows = spark.createDataFrame([(1, 1.0)], "k int, v double")
    with pytest.raises(ValueError):
        aggregate.multi_agg(rows, ["k"], [("v", ["max"]), ("v", ["max"])])


def test_division_by_zero_policies(spark):
    rows = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 2.0), (3.0, 2.0)], "a double, b double")
    got = {p: [r[0] for r in rows.select(clean.finite_ratio(F.col("a"), F.col("b"), p)).collect()] for p in ("zero", "missing", "mark")}
    assert got == {"zero": [0.0, 0.0, None, None, 1.5], "missing": [0.0, 0.0, 0.0, 0.0, 1.5],
                   "mark": [-9999.0, -9999.0, 0.0, 0.0, 1.5]}


def test_gaps_floor_towards_the_past(spark):
    row = spark.sql("SELECT TIMESTAMP_NTZ '2017-01-01 00:00:00' a, TIMESTAMP_NTZ '2017-01-01 12:00:00' b, TIMESTAMP_NTZ '2018-02-21 10:00:00' c")
    got = row.select(dates.floor_days(F.col("a"), F.col("b")), dates.day_gap(F.col("c")), dates.month_gap(F.col("c")),
                     dates.day_seconds(F.col("a"), F.col("b"))).first()
    assert tuple(got) == (-1, -7, -1, 43200)


def test_seconds_part_of_a_25_hour_gap(spark):
    rows = spark.createDataFrame([(1, dt.datetime(2018, 1, 1, 0)), (1, dt.datetime(2018, 1, 2, 1)), (2, dt.datetime(2018, 1, 1))], "k int, t timestamp_ntz")
    table = windows.purchase_gaps(rows, ["k"], ["t"], "t")
    assert rows_of(table.select("k", "purchase_time_diff_days", "purchase_time_diff_seconds")) == [(1, 1.0, 3600.0)] * 2 + [(2, 1.0, 3600.0)]


def test_holiday_at_the_end_of_the_year(spark):
    holidays = spark.createDataFrame([(dt.date(2017, 1, 1),), (dt.date(2017, 12, 25),), (dt.date(2018, 1, 1),)], "holiday date")
    rows = spark.createDataFrame([(dt.datetime(2017, 12, 31, 9),), (dt.datetime(2017, 12, 25, 1),), (dt.datetime(2017, 12, 24),)], "t timestamp_ntz")
    assert rows_of(dates.days_to_holiday(rows, "t", holidays).select("date2Holiday")) == [(-6,), (0,), (1,)]


def test_clamp_keeps_missing_and_rescale_rounds_half_even(spark):
    rows = spark.createDataFrame([(None,), (0.5,), (0.9,)], "v double")
    assert [r[0] for r in rows.select(clean.clamp_above(F.col("v"), 0.8)).collect()] == [None, 0.5, 0.8]
    assert spark.range(1).select(clean.rescale(F.lit(0.125), 1.0, 0.0)).first()[0] == 0.12


def test_row_statistics_use_the_sample_deviation(spark):
    row = spark.createDataFrame([(1.0, 2.0, 6.0)], "a double, b double, c double").select(
        *[c.alias(n) for n, c in clean.row_statistics(["a", "b", "c"]).items()]).first()
    assert row["feature_var"] == pytest.approx(7.0 ** 0.5) and row["feature_mean"] == 3.0 and row["feature_max"] == 6.0


def test_label_codes_read_missing_as_text(spark):
    rows = spark.createDataFrame([("b",), (None,), ("a",), ("z",)], "v string")
    table = encode.label_encode(rows.withColumn("w", F.col("v")), ["v"])
    assert {r["w"]: r["v"] for r in table.collect()} == {"a": 0, "b": 1, None: 2, "z": 3}


def test_out_of_fold_rate_of_an_unseen_key_is_missing(spark):
    rows = spark.createDataFrame([(1, "x", 1, 0), (2, "x", 0, 1), (3, "y", 1, 0)], "id int, k string, y int, fold int")
    got = {(r["k"], r["fold"]): r["k_ctr"] for r in encode.attach_out_of_fold(rows, ["k"], "y", "fold", "id").collect()}
    assert got[("y", 0)] is None
    assert got[("x", 0)] == pytest.approx(1000 * 0.01 / 1.01) and got[("x", 1)] == pytest.approx(1000)


def test_rates_read_both_zeros_and_keys_that_look_alike(spark):
    rows = spark.createDataFrame([(1, 0.0, "1", 1), (2, -0.0, "1", 0), (3, None, "1", 1), (4, 1.0, None, 0), (5, 5.0, "a", None)],
                                 "id int, v double, w string, y int")
    got = {r["id"]: r for r in encode.attach_rates(rows, rows, ["v", "w"], "y", "id").collect()}
    assert got[1]["v_ctr"] == got[2]["v_ctr"] == pytest.approx(1010 / 2.01) and got[3]["v_ctr"] is None
    assert got[1]["v_w_ctr"] == got[2]["v_w_ctr"] == pytest.approx(1010 / 2.01) and got[3]["v_w_ctr"] is None
    assert got[3]["w_ctr"] == pytest.approx(2010 / 3.01) and got[4]["w_ctr"] is None and got[4]["v_ctr"] == pytest.approx(10 / 1.01)
    assert got[5]["v_ctr"] == pytest.approx(1000) or got[5]["v_ctr"] is None


def test_one_hot_with_a_missing_level(spark):
    rows = spark.createDataFrame([("a",), (None,)], "v string")
    assert rows_of(encode.one_hot(rows, null_level=True)) == [(0, 1), (1, 0)]


def test_two_level_sum_ignores_slices_without_rows(spark):
    rows = spark.createDataFrame([(1, "a", -5.0, 0), (1, "b", 3.0, 1)], "card_id int, g string, v double, new int")
    table = aggregate.two_level(rows, "card_id", ["g"], "v", "sum", ["max"], "s", {"_h": F.col("new") == 0, "_n": F.col("new") == 1})
    assert rows_of(table) == [(1, -5.0, 3.0)]


def test_a_pivot_without_a_list_keeps_every_row(spark):
    rows = spark.createDataFrame([(i % 3, i - 50, float(i)) for i in range(100)] + [(1, None, 5.0)], "k int, gap int, v double")
    wide = pivots.sum_pivot(rows, "k", "gap", "v", name=str)
    assert len(wide.columns) == 101
    assert sum(sum(r[1:]) for r in wide.collect()) == sum(range(100))


def test_a_deduplicated_dimension_keeps_a_row_that_exists(spark):
    table = spark.createDataFrame([(1, "a", 9), (1, "b", 2), (2, "c", 3)], "k int, x string, y int")
    joined = joins.dimension(spark.createDataFrame([(1,), (2,), (3,)], "k int"), table, "k", ["x", "y"], dedupe=True)
    assert rows_of(joined) == [(1, "a", 9), (2, "c", 3), (3, None, None)]


def test_tokens_split_at_points_and_keep_accents(spark):
    rows = spark.createDataFrame([(1, "0.5 Été_x, ÉTÉ_X")], "id int, t string")
    assert rows_of(text.token_counts(rows, "id", ["t"])) == [(1, "t", "0", 1), (1, "t", "5", 1), (1, "t", "été_x", 2)]


def test_folds_cover_and_repeat(spark):
    rows = spark.range(500)
    first, second = (rows_of(folds.kfold(rows, "id", 5, 9)) for _ in range(2))
    assert first == second and {r[1] for r in first} == set(range(5))


def test_auc_and_f1_with_ties(spark):
    rows = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.4), (0, 0.1)], "y int, s double")
    assert metrics.roc_auc(rows, "y", "s").first()[0] == 0.625
    assert tuple(metrics.best_f1(rows, "y", "s").first()) == (0.4, 0.8)


def test_outliers_are_capped_by_the_rest(spark):
    rows = spark.createDataFrame([(1, float(x)) for x in [10] * 20 + [12, 1000]], "k int, v double")
    capped = windows.cap_outliers(rows, "k", "v")
    assert capped.agg(F.max("v_capped")).first()[0] == 12.0
