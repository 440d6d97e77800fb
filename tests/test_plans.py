"""Plan shapes: what reaches the scan, and what must not appear."""

from dataclasses import replace

from pyspark.sql import functions as F

from cardloom.operators.aggregate import multi_agg
from cardloom.operators.ordering import NEVER_HOT
from cardloom.operators.ratios import history
from cardloom.plans import features
from cardloom.sources import tables, views


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_the_columns_and_rows_it_needs(spark, sf):
    stored = tables.stage(views.transactions(spark, sf), "plan_check")
    text = plan(multi_agg(stored.where(history()), ["card_id"], [("purchase_amount", ["max", "mean"])]))
    assert "LessThanOrEqual(month_lag,0)" in text.split("PushedFilters")[1]
    assert "ReadSchema: struct<card_id:bigint,purchase_amount:double,month_lag:int>" in text


def test_batches_of_one_aggregation_join_without_another_shuffle(spark, sf):
    stored = tables.stage(views.transactions(spark, sf), "plan_check")
    spec = [(c, ["max", "min", "mean"]) for c in ("purchase_amount", "installments", "month_lag")]
    text = plan(multi_agg(stored, ["card_id"], spec, batch=3))
    assert text.count("Exchange hashpartitioning") == 3


def test_no_python_and_no_cartesian_product_in_the_flagship(spark, sf):
    from cardloom.catalog.flows import SETTING
    from cardloom.plans.features import baseline_features
    text = plan(baseline_features(views.cards(spark, sf), views.transactions(spark, sf), SETTING))
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_windows_inside_one_card_share_its_shuffle(spark, sf):
    from cardloom.operators.windows import change_summary
    stored = tables.stage(views.transactions(spark, sf), "plan_check")
    groups = {"card": ["card_id"], "merchant": ["card_id", "merchant_id"]}
    text = plan(change_summary(stored, "card_id", groups, views.TXN_ORDER, "purchase_amount", diff_stats=("max",)))
    assert text.count("Exchange hashpartitioning") == 1


def test_tables_of_bucketed_rows_are_written_before_they_are_joined(spark):
    rows = tables.stage_by(spark.createDataFrame([(k, v) for k in (1, 2, None) for v in range(5)], "card_id int, v int"), "rows", 4, "card_id")
    keys = spark.createDataFrame([(1,), (1,), (3,), (None,)], "card_id int")
    made = [rows.groupBy("card_id").agg((F.sum("v") + i).alias(f"s{i}")) for i in range(2 * features.TOGETHER + 1)]
    setting = features.Setting("2001-09-01", "2001-02-28", ["v"], hot_rows=NEVER_HOT, buckets=4)
    found = features.joined(keys, made, "part", setting)
    assert "Aggregate" not in found._jdf.queryExecution().executedPlan().toString()
    plain = features.joined(keys, made, "part", replace(setting, buckets=0))
    assert found.columns == plain.columns
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str) and found.count() == 4


def test_large_features_of_bucketed_rows_shuffle_no_sums(spark, sf, monkeypatch):
    rows = views.transactions(spark, sf, stepwise=True).where("card_id % 10 = 1")
    setting = features.Setting("2001-09-01", "2001-02-28", views.TXN_ORDER, {"fest": "2001-05-13"}, 0.8, -1)
    plans = []
    monkeypatch.setattr(features, "stored", lambda df, name, s, kept=features.stored: (plans.append((name, plan(df))), kept(df, name, s))[1])
    found = features.large_features(rows, setting)
    shuffled = [name for name, text in plans if "Exchange hashpartitioning" in text]
    assert {name for name, _ in plans} == {"transactions", "period"} and not shuffled
    plain = features.large_features(rows, replace(setting, hot_rows=5))
    assert found.columns == plain.columns
    got, wanted = ({r["card_id"]: r for r in t.collect()} for t in (found, plain))
    assert got.keys() == wanted.keys() and len(got) > 10
    for card, r in got.items():
        assert all(a == b or abs(a - b) <= 1e-6 * max(abs(a), abs(b), 1) for a, b in zip(r, wanted[card]) if isinstance(a, (int, float)))
