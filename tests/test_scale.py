"""Shapes that keep shuffles, joins and buffers from growing faster than the tables."""

from pyspark.sql import functions as F

from cardloom.catalog import learning
from cardloom.catalog.flows import SETTING
from cardloom.operators import aggregate, models, pivots, ratios, sequences, windows
from cardloom.plans import features, outliers
from cardloom.sources import tables, views
from test_plans import plan


def test_all_scored_models_read_one_stored_table(spark, sf, monkeypatch):
    made, plain = [], learning.model_table
    monkeypatch.setattr(learning, "model_table", lambda *a: made.append(a) or plain(*a))
    def unfitted(train, features, label, *rest, **options):
        scored = train.withColumn("prediction", F.lit(0.5))
        return models.KFoldResult(scored, None, scored)

    monkeypatch.setattr(models, "kfold_boosting", unfitted)
    learning.scored_cards(spark, sf)
    assert len(made) == 1


def test_group_means_are_weighted_without_a_join_to_rows(spark):
    rows = spark.createDataFrame([(1, "a", 2.0), (1, "a", 4.0), (1, "a", 3.0), (1, "b", 9.0), (1, None, 50.0), (2, None, 1.0), (None, "a", 1.0)],
                                 "card_id long, c string, amount double")
    made = aggregate.group_mean_summary(rows, "card_id", ["c"], "amount", ["max", "min", "median"], "m")
    assert sorted(map(tuple, made.collect())) == [(1, 9.0, 3.0, 3.0), (2, None, None, None)]
    assert sorted(map(tuple, aggregate.group_mean_summary(rows, "card_id", ["c"], "amount", ["max", "min", "median"], "m", hot_rows=1).collect())) == [
        (1, 9.0, 3.0, 3.0), (2, None, None, None)]
    assert "FileScan" not in plan(made)  # no stored means are joined back to the rows


def test_baseline_rows_are_dealt_out_by_card(spark, sf, monkeypatch):
    stored = {}
    monkeypatch.setattr(features, "stage", lambda df, name, *a: stored.setdefault(name, df))
    features.baseline_features(views.cards(spark, sf), views.transactions(spark, sf), SETTING)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(stored["baseline_rows"])


def purchases(spark):
    return spark.createDataFrame([(1, "a", 1, 2.0, 0), (1, "a", 2, 4.0, 1), (1, None, 3, 9.0, 0), (1, "b", 4, 3.0, None), (1, "b", 5, 3.0, 1),
                                  (2, "b", 1, 5.0, 0), (None, "a", 1, 7.0, 0), (None, "a", 2, 8.0, 0)],
                                 "card_id long, merchant_id string, at long, purchase_amount double, month_lag int")


def exchanges(df):
    return plan(df).count("Exchange hashpartitioning")


def test_neighbours_are_counted_without_a_join_and_alike_on_both_routes(spark):
    counted = sequences.cooccurrence(purchases(spark), "card_id", ["merchant_id", "month_lag"], ["at"], 2)
    assert "Join" not in plan(counted)
    rows = sorted(map(tuple, counted.collect()))
    assert rows == sorted(map(tuple, sequences.cooccurrence(purchases(spark), "card_id", ["merchant_id", "month_lag"], ["at"], 2, hot_rows=2).collect()))
    assert [r[1:] for r in rows if r[0] == "merchant_id"] == [("a", "a", 2), ("a", "b", 1), ("a", "nan", 2), ("b", "a", 1), ("b", "b", 2),
                                                             ("b", "nan", 2), ("nan", "a", 2), ("nan", "b", 2)]


def test_wide_rows_of_a_pivot_are_made_where_a_keys_cells_lie(spark):
    wide = pivots.sum_pivot(purchases(spark), "card_id", "at", "purchase_amount", [1, 2])
    assert exchanges(wide) == 2 and sorted(map(tuple, wide.collect())) == [(1, 2.0, 4.0), (2, 5.0, 0.0)]
    text = plan(wide)
    below = text[text.index("partial_sum(CASE"):].split("hashpartitioning(")[1]  # the last shuffle before anything wide is made
    assert below.startswith("card_id#") and "at#" not in below.split(")")[0]


def test_distinct_ratios_group_each_column_for_itself(spark):
    made = ratios.distinct_ratios(purchases(spark), "card_id", ["merchant_id", "at"])
    assert "Expand" not in plan(made)
    assert sorted(map(tuple, made.collect())) == [(1, 1.0, 1.0), (2, 0.0, 0.0)]


def test_change_summary_deals_rows_out_once(spark):
    groups = {"merchant": ["card_id", "merchant_id"], "lag": ["card_id", "month_lag"]}
    made, split = (windows.change_summary(purchases(spark), "card_id", groups, ["at"], "purchase_amount", hot_rows=h) for h in (None, 2))
    assert exchanges(made) == 1
    assert sorted(map(tuple, made.collect())) == sorted(map(tuple, split.collect())) == [(1, 1.0, 2.0, 0.0, 4 / 3, 7.0, 0.0), (2, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)]


def test_ordinary_keys_gather_medians_and_distinct_values(spark):
    rows = spark.createDataFrame([(1, 0.0, 3), (1, -0.0, 1), (1, None, 2), (1, 5.0, None), (2, None, None), (None, 1.0, 1)], "k int, v double, w int")
    spec = [("v", ["nunique", "median", "max"]), ("w", ["median", "nunique"])]
    made, split = (aggregate.multi_agg(rows, ["k"], spec, slices={"": F.lit(True), "_few": F.col("w") < 3}, hot_rows=h) for h in (None, 1))
    assert "percentile" not in plan(made) and "Expand" not in plan(made)
    assert sorted(map(tuple, made.collect()), key=str) == sorted(map(tuple, split.collect()), key=str) == [
        (1, 2, 0.0, 5.0, 2.0, 3, 1, 0.0, 0.0, 1.5, 2), (2, 0, None, None, None, 0, 0, None, None, None, 0)]


def test_visit_counts_are_the_same_with_and_without_windows(spark):
    made, joined = (aggregate.visit_counts(purchases(spark), hot_rows=h) for h in (None, 1))
    assert "Join" not in plan(made)
    def rows(df):
        return sorted(map(tuple, df.select("card_id", "merchant_id", "at", "card_merchant_counts_totals", "card_visit_counts").collect()), key=str)
    assert rows(made) == rows(joined) and (1, None, 3, None, 5) in rows(made) and (None, "a", 1, None, None) in rows(made)


def test_orders_are_joined_last(spark, sf):
    joins = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in joins}
    try:
        for name, value in joins.items():
            spark.conf.set(name, value)
        found = plan(views.transactions(spark, sf).groupBy("card_id").agg(F.count("month_lag")))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert found.index("SortMergeJoin [l_orderkey") < found.index("SortMergeJoin [l_partkey")  # the outermost join is shown first


def test_rows_in_buckets_by_card_are_not_shuffled_again(spark):
    rows, old, new = tables.stage_by(purchases(spark), "purchases", 3, "card_id"), ratios.history(), ratios.recent()
    value = "purchase_amount"

    def made(df, dealt):
        profile = aggregate.dealt_profile(df, ["card_id"], ["merchant_id", "at"], {"": F.lit(True)}) if dealt else aggregate.category_profile(
            df, ["card_id"], ["merchant_id", "at"])
        return [profile, aggregate.two_level(df, "card_id", ["merchant_id"], value, "mean", ["max", "median"], "m", {"_h": old, "_n": new}, dealt=dealt),
                *[aggregate.relative_to_group(df, "card_id", ["merchant_id"], value, s, ["max", "median"], "r", dealt=dealt) for s in ("max", "mean")],
                aggregate.group_mean_summary(df, "card_id", ["merchant_id"], value, ["max", "median"], "m"),
                ratios.distinct_ratios(df, "card_id", ["merchant_id", "at"], dealt),
                pivots.share_pivot(df, "card_id", "at", value, [1, 2], dealt=dealt),
                windows.change_summary(df, "card_id", {"merchant": ["card_id", "merchant_id"]}, ["at"], value, dealt=dealt),
                aggregate.multi_agg(df, ["card_id"], [(value, ["max", "mean", "median"])], batch=1, hot_rows=features.NEVER_HOT, dealt=dealt)]

    for dealt, plain in zip(made(rows, True), made(purchases(spark), False)):
        assert exchanges(dealt) == 0
        assert sorted(map(tuple, dealt.select(*plain.columns).collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_a_profile_of_slices_is_that_of_each_slice(spark):
    parts = {"old_": ratios.history(), "new_": ratios.recent()}
    made = aggregate.dealt_profile(purchases(spark), ["card_id"], ["merchant_id", "at"], parts)
    for prefix, where in parts.items():
        plain = aggregate.category_profile(purchases(spark).where(where), ["card_id"], ["merchant_id", "at"], prefix=prefix)
        own = made.select(*plain.columns).where(F.col(f"{prefix}at_nunique").isNotNull())
        assert sorted(map(tuple, own.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_rows_lie_in_buckets_unless_a_card_is_hot(spark):
    assert features.with_buckets(purchases(spark), SETTING).buckets >= 1
    assert features.with_buckets(purchases(spark), features.replace(SETTING, hot_rows=3)).buckets == 0


def test_group_means_come_from_few_sums_and_stay_exact(spark, sf, monkeypatch):
    names, plain = [], outliers.stage
    monkeypatch.setattr(outliers, "stage", lambda df, name, *a: names.append(name) or plain(df, name, *a))
    rows = tables.stage(outliers.outlier_rows(views.transactions(spark, sf), SETTING), "rows")
    wide = outliers.with_group_means(rows, outliers.MEAN_COLUMNS)
    assert names.count("mean_cells") == 4  # passes over the rows, for twelve columns
    for c in ("weekday", "category_2", "merchant_id"):
        found = wide.where(ratios.history() & F.col(c).isNotNull()).select(c, f"{c}_amount_mean").distinct()
        own = aggregate.multi_agg(rows.where(ratios.history()), [c], [("purchase_amount", ["mean"])])
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, own.collect()))
    assert wide.where(F.col("category_2").isNull() & F.col("category_2_amount_mean").isNotNull()).isEmpty()
