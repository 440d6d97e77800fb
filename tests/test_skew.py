"""The route for long groups must give what the plain window and the plain aggregate give."""

import pytest
from pyspark.sql import Window, functions as F

from cardloom.operators import aggregate, encode, folds, ordering, sequences, windows
from cardloom.sources import views


@pytest.fixture(scope="module")
def skewed(spark, sf):
    """Events of which a third belong to one card, with times that repeat."""
    card = F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("card_id"))
    rows = views.events(spark, sf).withColumn("card_id", card).withColumn(
        "purchase_date", F.date_trunc("hour", "purchase_date").cast("timestamp_ntz"))
    return rows.persist()


def as_set(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_hot_keys_are_found_and_few(skewed):
    hot = ordering.hot_keys(skewed, ["card_id"], 100)
    assert [r[0] for r in hot.collect()] == [-1]
    assert ordering.hot_keys(skewed, ["card_id"]) is None


def test_many_keys_of_medium_length_are_all_split(spark):
    rows = spark.range(60_000).selectExpr("id % 3000 AS k", "id AS at", "cast(id * 7 % 11 as double) AS v")  # 20 rows each
    hot = ordering.hot_keys(rows, ["k"], 10)
    assert hot.count() == 3000
    plain, split = (ordering.previous_in_group(rows, ["k"], ["at"], {"p": "v"}, hot_rows=h) for h in (None, 10))
    assert as_set(split, "at", "p") == as_set(plain, "at", "p")


def test_previous_row(skewed):
    order = ["purchase_date", "event_id"]
    columns = ("event_id", "p", "t")
    plain = skewed.withColumn("p", F.lag("purchase_amount").over(Window.partitionBy("card_id").orderBy(*order))) \
        .withColumn("t", F.lag("purchase_date").over(Window.partitionBy("card_id").orderBy(*order)))
    split = ordering.previous_in_group(skewed, ["card_id"], order, {"p": "purchase_amount", "t": "purchase_date"}, hot_rows=100)
    assert as_set(split, *columns) == as_set(plain, *columns)


def test_previous_row_when_every_key_is_hot(skewed):
    order = ["purchase_date", "event_id"]
    rows = skewed.where("event_id % 3 = 0").withColumn("half", F.col("event_id") % 2)
    plain = rows.withColumn("p", F.lag("purchase_amount").over(Window.partitionBy("half").orderBy(*order)))
    split = ordering.previous_in_group(rows, ["half"], order, {"p": "purchase_amount"}, hot_rows=10)
    assert as_set(split, "event_id", "p") == as_set(plain, "event_id", "p")


def test_position(skewed):
    order = ["purchase_date", "event_id"]
    plain = skewed.withColumn("n", F.row_number().over(Window.partitionBy("card_id").orderBy(*order)))
    split = ordering.position_in_group(skewed, ["card_id"], order, "n", hot_rows=100)
    assert as_set(split, "event_id", "n") == as_set(plain, "event_id", "n")


def test_global_index_and_running_totals(skewed):
    rows = skewed.select("event_id", "card_id", F.lit(1).alias("one"))
    indexed = as_set(ordering.global_index(rows, [F.desc("card_id"), "event_id"], "i"), "i", "card_id", "event_id")
    assert [r[0] for r in indexed] != [] and sorted(r[0] for r in indexed) == list(range(rows.count()))
    ordered = sorted(indexed)
    assert [(-r[1], r[2]) for r in ordered] == sorted((-r[1], r[2]) for r in ordered)
    totals = ordering.running_totals(rows, ["event_id"], {"run": "one"})
    assert sorted(r["run"] for r in totals.collect()) == list(range(1, rows.count() + 1))


def test_medians_by_rank(skewed):
    spec = [("purchase_amount", ["median", "max", "nunique"]), ("event_id", ["median"])]
    cheap = {"_cheap": F.col("purchase_amount") < 50, "_all": F.lit(True)}
    plain = aggregate.multi_agg(skewed, ["card_id"], spec, slices=cheap)
    split = aggregate.multi_agg(skewed, ["card_id"], spec, slices=cheap, hot_rows=100)
    assert as_set(split, *plain.columns) == as_set(plain, *plain.columns)


def test_median_of_values_missing_in_a_hot_group(spark):
    rows = spark.createDataFrame([(1, None)] * 30 + [(1, 4.0), (1, 8.0), (2, 1.0)], "k int, v double")
    table = aggregate.multi_agg(rows, ["k"], [("v", ["median", "count"])], hot_rows=10)
    assert as_set(table, *table.columns) == [(1, 6.0, 2), (2, 1.0, 1)]
    none = aggregate.multi_agg(rows.where("v is null or k = 2"), ["k"], [("v", ["median"])], hot_rows=10)
    assert as_set(none, *none.columns) == [(1, None), (2, 1.0)]


def test_chunks_hold_the_whole_sequence(skewed):
    order = ["purchase_date", "event_id"]
    chunks = sequences.sequence_chunks(skewed, "card_id", ["event_id"], order, size=7, hot_rows=100)
    assert chunks.where(F.size("event_id") > 7).count() == 0
    joined = {}
    for r in sorted(chunks.collect(), key=lambda r: (r["card_id"], r["chunk"])):
        joined.setdefault(r["card_id"], []).extend(int(x) for x in r["event_id"])
    rows = sorted(skewed.select("card_id", *order).collect())
    expected = {}
    for r in rows:
        expected.setdefault(r[0], []).append(r[2])
    assert joined == expected


def test_codes_and_folds_do_not_depend_on_the_route(skewed):
    columns = ["merchant_id", "merchant_category_id"]
    assert as_set(encode.label_encode(skewed, columns, hot_rows=3), "event_id", *columns) == as_set(
        encode.label_encode(skewed, columns), "event_id", *columns)
    labelled = skewed.withColumn("y", (F.col("card_id") == -1).cast("int"))
    plain, split = (folds.stratified_kfold(labelled, "event_id", "y", 5, 3, hot_rows=h) for h in (None, 50))
    assert as_set(plain, "event_id", "fold") == as_set(split, "event_id", "fold")
    shares = plain.groupBy("y", "fold").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in shares if r["y"] == y]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_gap_operators_on_the_hot_route(skewed):
    order = ["purchase_date", "event_id"]
    columns = ["event_id", "purchase_time_diff_days", "purchase_time_diff_seconds"]
    plain, split = (windows.purchase_gaps(skewed, ["card_id"], order, "purchase_date", hot_rows=h) for h in (None, 100))
    assert as_set(plain, *columns) == as_set(split, *columns)
