"""Sources, sinks and row-level expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardloom.catalog.base import (CARDS, CLEAN, CLEAN_BASE, EVENTS, HIST, NEW, TXN, floor_days_sql, money,
                                   query, with_views)
from cardloom.catalog.common import base_clean, staged_clean
from cardloom.functions import clean, dates
from cardloom.operators import aggregate, encode
from cardloom.operators.ratios import history, recent, since
from cardloom.operators.select import narrow_types
from cardloom.operators.sequences import feature_tuples
from cardloom.session import stage_path
from cardloom.sources import tables, views

ORDERS_CSV = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string")


def orders(spark: SparkSession, d: str) -> DataFrame:
    return views.table(spark, d, "orders")


@query("A1", "SELECT * FROM orders")
def read_csv_with_header(spark, d):
    path = stage_path(spark, "orders") + ".csv"
    tables.write_table(orders(spark, d), path, "csv")
    return tables.read_table(spark, path, ORDERS_CSV)


@query("A2", "SELECT o_custkey, o_totalprice FROM orders")
def read_pruned_columns(spark, d):
    return tables.read_table(spark, f"{d}/orders.parquet", columns=["o_custkey", "o_totalprice"])


@query("A3 H14", "SELECT o_orderkey, o_orderdate FROM orders")
def read_dates_from_text(spark, d):
    path = stage_path(spark, "order_dates") + ".csv"
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate")
    tables.write_table(orders(spark, d).select("o_orderkey", text), path, "csv")
    loaded = tables.read_table(spark, path, "o_orderkey bigint, o_orderdate string")
    return tables.parse_dates(loaded, ["o_orderdate"], "yyyy-MM-dd HH:mm:ss")


@query("A4 F3", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 1000")
def read_first_rows(spark, d):
    return tables.head(orders(spark, d), 1000, "o_orderdate", "o_orderkey").select("o_orderkey", "o_totalprice")


@query("A5", "SELECT DISTINCT p_name AS feature FROM part")
def read_headerless_names(spark, d):
    path = stage_path(spark, "names")
    tables.write_names(views.table(spark, d, "part").select("p_name").distinct(), path)
    return tables.read_names(spark, path)


@query("A6", "SELECT * FROM customer")
def write_and_read_table(spark, d):
    path = stage_path(spark, "customer")
    customer = views.table(spark, d, "customer")
    tables.write_table(customer, path)
    return tables.read_table(spark, path, customer.schema)


@query("A7", with_views(TXN, CLEAN, f"""
SELECT card_id, count(*) AS rows, {money()} AS amount FROM tx GROUP BY card_id"""))
def staged_table(spark, d):
    staged = tables.stage(staged_clean(spark, d), "clean")
    return staged.groupBy("card_id").agg(
        F.count(F.lit(1)).alias("rows"), aggregate.exact_sum(F.col("purchase_amount"), 2).alias("amount"))


@query("A8 D30", with_views(CARDS, """
SELECT card_id, m AS target FROM cards
JOIN (SELECT feature_1, avg(outlier) AS m FROM cards GROUP BY feature_1) USING (feature_1)"""))
def prediction_file(spark, d):
    path = stage_path(spark, "predictions")
    encoded = encode.mean_encode(views.cards(spark, d), ["feature_1"], "outlier", "_rate")
    tables.write_predictions(encoded, path, prediction="feature_1_rate")
    return spark.read.csv(path, schema="card_id bigint, target double", header=True)


@query("A10", with_views(CARDS, """
SELECT card_id, outlier AS y, feature_1 / 5.0 AS prob FROM cards"""))
def score_dump(spark, d):
    path = stage_path(spark, "scores")
    scored = views.cards(spark, d).withColumn("p", F.col("feature_1") / F.lit(5.0))
    tables.write_scores(scored, path, "card_id", "outlier", "p")
    return spark.read.parquet(path)


@query("B1 G2", with_views(CARDS, """
SELECT card_id, target, 0 AS test_flag FROM cards WHERE is_test = 0
UNION ALL SELECT card_id, NULL, 1 FROM cards WHERE is_test = 1"""))
def train_test_union(spark, d):
    cards = views.cards(spark, d)
    train = cards.where("is_test = 0").select("card_id", "target").withColumn("test_flag", F.lit(0))
    test = cards.where("is_test = 1").select("card_id").withColumn("test_flag", F.lit(1))
    return train.unionByName(test, allowMissingColumns=True)


@query("B2", "SELECT c_custkey AS card_id, CASE WHEN c_acctbal < -500 THEN 1 ELSE 0 END AS outlier FROM customer")
def outlier_label(spark, d):
    customer = views.table(spark, d, "customer")
    return customer.select(F.col("c_custkey").alias("card_id"), clean.below(F.col("c_acctbal"), -500).alias("outlier"))


@query("B3", with_views(TXN, f"""
SELECT card_id, count(*) AS n, 'hist' AS part FROM txn WHERE {HIST} GROUP BY card_id
UNION ALL SELECT card_id, count(*), 'new' FROM txn WHERE {NEW} GROUP BY card_id"""))
def split_history_and_new(spark, d):
    txn = views.transactions(spark, d)
    parts = {"hist": history(), "new": recent()}
    return reduce(DataFrame.unionByName, [
        txn.where(where).groupBy("card_id").agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit(name))
        for name, where in parts.items()])


@query("B4", with_views(TXN, f"""
SELECT card_id, count(*) FILTER (WHERE authorized_flag = 'Y') AS authorised,
       count(*) FILTER (WHERE authorized_flag = 'N') AS refused FROM txn WHERE {HIST} GROUP BY card_id"""))
def split_by_authorisation(spark, d):
    flag = F.col("authorized_flag")
    return views.transactions(spark, d).where(history()).groupBy("card_id").agg(
        F.count_if(flag == "Y").alias("authorised"), F.count_if(flag == "N").alias("refused"))


@query("B6", with_views(TXN, "SELECT card_id, purchase_amount FROM txn WHERE month_lag = 0"))
def exact_lag_slice(spark, d):
    return views.transactions(spark, d).where("month_lag = 0").select("card_id", "purchase_amount")


@query("B7", with_views(CARDS, """
SELECT card_id, target IS NOT NULL AS is_train FROM cards"""))
def split_by_target(spark, d):
    cards = views.cards(spark, d)
    train = cards.where(F.col("target").isNotNull()).select("card_id").withColumn("is_train", F.lit(True))
    return train.unionByName(cards.where(F.col("target").isNull()).select("card_id").withColumn("is_train", F.lit(False)))


@query("B8", with_views(TXN, """
SELECT o_orderkey, l_linenumber, CASE installments WHEN -1 THEN 1 WHEN 999 THEN 0 ELSE installments END AS replaced,
       CASE WHEN installments IN (-1, 999) THEN NULL ELSE installments END AS missing FROM txn"""))
def replace_sentinels(spark, d):
    installments = F.col("installments")
    return views.transactions(spark, d).select(
        "o_orderkey", "l_linenumber", clean.replace_values(installments, {-1: 1, 999: 0}).alias("replaced"),
        clean.replace_values(installments, {-1: None, 999: None}).alias("missing"))


@query("B9", with_views(TXN, """
SELECT o_orderkey, coalesce(category_2, 6.0) AS category_2, coalesce(category_3, 'B') AS category_3 FROM txn"""))
def fill_constants(spark, d):
    txn = views.transactions(spark, d).select("o_orderkey", "category_2", "category_3")
    return txn.na.fill({"category_2": 6.0, "category_3": "B"})


@query("B10", with_views(TXN, """
SELECT o_orderkey, l_linenumber,
  CASE WHEN x = 0 AND purchase_amount <> 0 THEN 0.0 ELSE purchase_amount / nullif(x, 0) END AS zero,
  coalesce(purchase_amount / nullif(x, 0), 0.0) AS missing,
  CASE WHEN x = 0 AND purchase_amount <> 0 THEN -9999.0 ELSE coalesce(purchase_amount / nullif(x, 0), 0.0) END AS mark
FROM (SELECT *, CASE WHEN l_linenumber < 7 THEN l_linenumber - 3 END AS x FROM txn)"""))
def non_finite_policies(spark, d):
    x = F.when(F.col("l_linenumber") < 7, F.col("l_linenumber") - 3)
    return views.transactions(spark, d).select("o_orderkey", "l_linenumber", *[
        clean.finite_ratio(F.col("purchase_amount"), x, policy).alias(policy)
        for policy in ("zero", "missing", "mark")])


@query("B11", with_views(TXN, """mode AS (
SELECT category_2 AS m FROM txn WHERE category_2 IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)""", """
SELECT o_orderkey, l_linenumber, coalesce(category_2, (SELECT m FROM mode)) AS category_2 FROM txn"""))
def fill_with_global_mode(spark, d):
    filled = aggregate.fill_with_mode(views.transactions(spark, d), "category_2")
    return filled.select("o_orderkey", "l_linenumber", "category_2")


@query("B12", with_views(TXN, """
SELECT o_orderkey, l_linenumber, coalesce(category_2, (SELECT avg(category_2) FROM txn)) AS category_2 FROM txn"""))
def fill_with_global_mean(spark, d):
    filled = aggregate.fill_with_mean(views.transactions(spark, d), "category_2")
    return filled.select("o_orderkey", "l_linenumber", "category_2")


@query("B13", with_views(CARDS, """
SELECT card_id, coalesce(CASE WHEN card_id % 7 <> 0 THEN first_active_month END,
  (SELECT first_active_month FROM cards WHERE card_id = 11)) AS first_active_month FROM cards"""))
def fill_from_chosen_row(spark, d):
    month = F.when(F.col("card_id") % 7 != 0, F.col("first_active_month"))
    cards = views.cards(spark, d).select("card_id", month.alias("first_active_month"))
    return aggregate.fill_from_row(cards, "first_active_month", "card_id", 11)


@query("B14", with_views(TXN, """
SELECT o_orderkey, l_linenumber, CASE authorized_flag WHEN 'Y' THEN 1 WHEN 'N' THEN 0 END AS authorized_flag,
  CASE category_3 WHEN 'A' THEN 0 WHEN 'B' THEN 1 WHEN 'C' THEN 2 END AS category_3 FROM txn"""))
def map_codes(spark, d):
    return views.transactions(spark, d).select(
        "o_orderkey", "l_linenumber", clean.code_map(F.col("authorized_flag"), clean.FLAG_CODES).alias("authorized_flag"),
        clean.code_map(F.col("category_3"), clean.CATEGORY_3_CODES).alias("category_3"))


@query("B15", with_views(TXN, """
SELECT o_orderkey, CASE WHEN category_2 > 2 THEN 2.0 ELSE category_2 END AS category_2,
  CASE WHEN purchase_amount > 50000 THEN 50000.0 ELSE purchase_amount END AS purchase_amount FROM txn"""))
def clamp_amounts(spark, d):
    return views.transactions(spark, d).select(
        "o_orderkey", clean.clamp_above(F.col("category_2"), 2.0).alias("category_2"),
        clean.clamp_above(F.col("purchase_amount"), 50000.0).alias("purchase_amount"))


@query("B16", with_views(EVENTS, """
SELECT event_id, round_even(purchase_amount / 0.00150265118 + 497.06, 2) AS purchase_amount FROM ev"""))
def rescale_amounts(spark, d):
    return views.events(spark, d).select("event_id", clean.rescale(F.col("purchase_amount")).alias("purchase_amount"))


@query("B17", with_views(TXN, """
SELECT o_orderkey, l_linenumber, coalesce(CAST(category_3 = 'A' AS INTEGER), 0) AS "category_3_A",
  coalesce(CAST(category_3 = 'B' AS INTEGER), 0) AS "category_3_B",
  coalesce(CAST(category_3 = 'C' AS INTEGER), 0) AS "category_3_C" FROM txn"""))
def indicator_columns(spark, d):
    rows = views.transactions(spark, d).select("o_orderkey", "l_linenumber", "category_3")
    return clean.indicators(rows, "category_3", ["A", "B", "C"]).drop("category_3")


@query("B18", """
SELECT c_custkey AS card_id, CAST(c_mktsegment IS NULL AS INTEGER) AS segment_nan,
""" + ",\n".join(f"CAST(c_mktsegment = '{s}' AS INTEGER) AS \"segment_{s}\"" for s in
                 ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]) + " FROM customer")
def one_hot_columns(spark, d):
    customer = views.table(spark, d, "customer").select(
        F.col("c_custkey").alias("card_id"), F.col("c_mktsegment").alias("segment"))
    return encode.one_hot(customer, null_level=True)


INTERACTIONS_SQL = """keyed AS (SELECT o_orderkey, l_linenumber,
  '0' || '_' || category_1 AS "city_C1",
  coalesce(CAST(category_2 AS VARCHAR), 'nan') || '_' || state_id AS "C2_state",
  coalesce(CAST(category_2 AS VARCHAR), 'nan') || '_' || state_id || '_' || subsector_id AS "C2_state_subsector",
  subsector_id || '_0' AS subsector_city,
  authorized_flag || '_' || coalesce(category_3, 'nan') AS "auth_C3" FROM txn)"""


@query("B19 H13", with_views(TXN, INTERACTIONS_SQL, "SELECT * FROM keyed"))
def interaction_columns(spark, d):
    txn = views.transactions(spark, d)
    return txn.select("o_orderkey", "l_linenumber", *[c.alias(n) for n, c in clean.interaction_keys().items()])


@query("B20", with_views(TXN, INTERACTIONS_SQL, """
SELECT o_orderkey, l_linenumber, """ + ", ".join(
    f'dense_rank() OVER (ORDER BY "{c}") - 1 AS "{c}"'
    for c in ["city_C1", "C2_state", "C2_state_subsector", "subsector_city", "auth_C3"]) + " FROM keyed"))
def label_codes(spark, d):
    keys = clean.interaction_keys()
    rows = views.transactions(spark, d).select("o_orderkey", "l_linenumber", *[c.alias(n) for n, c in keys.items()])
    return encode.label_encode(rows, list(keys))


@query("B21", with_views(CARDS, "SELECT card_id, feature_1 AS code_1, outlier FROM cards"))
def drop_and_rename(spark, d):
    rated = encode.attach_rates(views.cards(spark, d), views.cards(spark, d), ["feature_1", "feature_2"], "outlier", "card_id")
    rated = rated.drop(*[c for c in rated.columns if "_ctr" in c])
    return rated.withColumnsRenamed({"feature_1": "code_1"}).select("card_id", "code_1", "outlier")


@query("B22", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def narrowed_types(spark, d):
    return narrow_types(orders(spark, d).select("o_orderkey", "o_custkey", "o_orderstatus"))


@query("B23", with_views(TXN, "SELECT o_orderkey, purchase_amount / nullif(l_linenumber - 3, 0) AS price FROM txn"))
def guarded_ratio(spark, d):
    return views.transactions(spark, d).select(
        "o_orderkey", clean.ratio(F.col("purchase_amount"), F.col("l_linenumber") - 3).alias("price"))


@query("B24", with_views(CARDS, """
SELECT card_id, feature_sum, feature_sum / 3.0 AS feature_mean, feature_max, feature_min,
  round(sqrt(((feature_1 - m) * (feature_1 - m) + (feature_2 - m) * (feature_2 - m) + (feature_3 - m) * (feature_3 - m)) / 2), 6)
  AS feature_var
FROM (SELECT *, CAST(feature_1 + feature_2 + feature_3 AS DOUBLE) AS feature_sum,
        (feature_1 + feature_2 + feature_3) / 3.0 AS m,
        CAST(greatest(feature_1, feature_2, feature_3) AS DOUBLE) AS feature_max,
        CAST(least(feature_1, feature_2, feature_3) AS DOUBLE) AS feature_min FROM cards)"""))
def row_wise_statistics(spark, d):
    made = clean.row_statistics(["feature_1", "feature_2", "feature_3"])
    made["feature_var"] = F.round(made["feature_var"], 6)
    return views.cards(spark, d).select("card_id", *[c.alias(n) for n, c in made.items()])


@query("B25", with_views(TXN, CLEAN, """
SELECT o_orderkey, l_linenumber, purchase_amount * authorized_flag AS amount_flag,
  purchase_amount / installments_or_null AS price, purchase_amount / n AS amount_per_visits,
  round(purchase_amount / sqrt(n), 6) AS amount_per_sqrt_visits, round(purchase_amount * ln(1 + n), 4) AS amount_log1p_visits
FROM (SELECT *, nullif(installments, 0) AS installments_or_null,
             count(purchase_amount) OVER (PARTITION BY card_id, merchant_id) AS n FROM tx)"""))
def products_and_visit_scaling(spark, d):
    rows = aggregate.visit_counts(staged_clean(spark, d)).withColumn("amount", F.col("purchase_amount"))
    rows = clean.visit_scaled(rows, "amount", "card_merchant_counts_totals", "visits")
    return rows.select(
        "o_orderkey", "l_linenumber", (F.col("amount") * F.col("authorized_flag")).alias("amount_flag"),
        clean.ratio(F.col("amount"), F.col("installments")).alias("price"), "amount_per_visits",
        F.round("amount_per_sqrt_visits", 6).alias("amount_per_sqrt_visits"),
        F.round("amount_log1p_visits", 4).alias("amount_log1p_visits"))


@query("B26", with_views(EVENTS, "SELECT event_id, epoch_us(purchase_date) / 1000000.0 AS seconds FROM ev"))
def epoch_seconds(spark, d):
    return views.events(spark, d).select("event_id", dates.epoch_seconds(F.col("purchase_date")).alias("seconds"))


@query("B27", with_views(CARDS, """
SELECT card_id, feature_1 % 2 AS f1_mod_2, feature_1 % 2 - feature_3 AS f1_minus_f3 FROM cards"""))
def code_parity(spark, d):
    return feature_tuples(views.cards(spark, d), {}).select("card_id", "f1_mod_2", "f1_minus_f3")


@query("B28", with_views(CARDS, "SELECT card_id, feature_1 FROM cards"))
def drop_low_variance(spark, d):
    cards = views.cards(spark, d).select("card_id", "feature_1", F.lit(1.0).alias("constant"),
                                         (F.col("feature_2") / 1000).alias("nearly_constant"))
    return aggregate.drop_low_variance(cards, keep=["card_id"])


PARTS_SQL = """year(ts) AS "year", quarter(ts) AS "quarter", month(ts) AS "month", day(ts) AS "day", hour(ts) AS "hour",
  weekofyear(ts) AS "weekofyear", isodow(ts) - 1 AS "weekday", CAST(isodow(ts) >= 6 AS INTEGER) AS weekend"""


@query("H1 H2 H3 H4", f"SELECT event_id, {PARTS_SQL} FROM events")
def date_parts(spark, d):
    rows = views.table(spark, d, "events").select("event_id", "ts")
    return dates.date_parts(rows, "ts", [*dates.PARTS, "weekend"]).drop("ts")


@query("H5", f"SELECT event_id, {floor_days_sql('ts', chr(39) + '2024-01-15 12:00:00' + chr(39) + '::TIMESTAMP')} AS days FROM events")
def floored_days(spark, d):
    return views.table(spark, d, "events").select(
        "event_id", dates.floor_days(F.col("ts"), dates.timestamp("2024-01-15 12:00:00")).alias("days"))


@query("H6", """SELECT o_orderkey, date_diff('day', DATE '1999-02-28', CAST(o_orderdate AS DATE)) AS day_gap,
  CAST(floor(date_diff('day', DATE '1999-02-28', CAST(o_orderdate AS DATE)) / 30.0) AS INTEGER) AS month_gap FROM orders""")
def base_date_gaps(spark, d):
    day = F.col("o_orderdate")
    return orders(spark, d).select("o_orderkey", dates.day_gap(day, "1999-02-28").alias("day_gap"),
                                   dates.month_gap(day, "1999-02-28").alias("month_gap"))


@query("H7", with_views(TXN, f"""
SELECT o_orderkey, CAST(floor({floor_days_sql("'2001-09-01'::TIMESTAMP", 'purchase_date')} / 30.0) AS INTEGER) + month_lag AS month_diff
FROM txn"""))
def month_age(spark, d):
    return views.transactions(spark, d).select(
        "o_orderkey", dates.month_age(F.col("purchase_date"), "2001-09-01", F.col("month_lag")).alias("month_diff"))


# Days of the supplied order calendar that stand in for the fixed event days.
FIXTURE_EVENTS = {"event_a": "1998-12-25", "event_b": "2000-05-14", "event_c": "2001-03-01"}


def event_sql(day: str, column: str = "purchase_date") -> str:
    gap = floor_days_sql(f"'{day}'::TIMESTAMP", column)
    return f"CASE WHEN {gap} > 0 AND {gap} < 100 THEN {gap} ELSE 0 END"


@query("H8", "SELECT o_orderkey, " + ", ".join(
    f"{event_sql(day, 'o_orderdate')} AS {name}" for name, day in FIXTURE_EVENTS.items()) + " FROM orders")
def event_distances(spark, d):
    rows = orders(spark, d).select("o_orderkey", "o_orderdate")
    return dates.add_event_days(rows, "o_orderdate", FIXTURE_EVENTS).drop("o_orderdate")


@query("H9", with_views(TXN, "SELECT card_id, " + ", ".join(
    f"max({event_sql(day)}) AS {n}_max, min({event_sql(day)}) AS {n}_min, CAST(sum({event_sql(day)}) AS DOUBLE) AS {n}_sum, "
    f"avg({event_sql(day)}) AS {n}_mean, median({event_sql(day)}) AS {n}_median, "
    f"{money(f'(purchase_amount * {event_sql(day)})')} AS purchase_amount_{n}_sum" for n, day in FIXTURE_EVENTS.items())
    + " FROM txn GROUP BY card_id"))
def event_spend(spark, d):
    rows = dates.add_event_days(views.transactions(spark, d), "purchase_date", FIXTURE_EVENTS, "purchase_amount")
    spec = [(n, ["max", "min", "sum", "mean", "median"]) for n in FIXTURE_EVENTS]
    spec += [(f"purchase_amount_{n}", ["sum"]) for n in FIXTURE_EVENTS]
    return aggregate.multi_agg(rows, ["card_id"], spec, exact={f"purchase_amount_{n}": 2 for n in FIXTURE_EVENTS})


HOLIDAY_SQL = """holidays AS (
SELECT DISTINCT make_date(CAST(y AS BIGINT), m, dd) AS holiday FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders),
  (VALUES (1, 1), (4, 21), (5, 1), (9, 7), (10, 12), (11, 2), (11, 15), (12, 25)) AS t(m, dd))"""
# Month and day of the fixed-date national holidays used as the test calendar.
HOLIDAYS = [(1, 1), (4, 21), (5, 1), (9, 7), (10, 12), (11, 2), (11, 15), (12, 25)]


def holiday_calendar(spark: SparkSession, d: str) -> DataFrame:
    """The fixed-date holidays of every year that occurs in the orders."""
    years = orders(spark, d).select(F.year("o_orderdate").alias("y")).distinct()
    days = F.array(*[F.make_date("y", F.lit(m), F.lit(day)) for m, day in HOLIDAYS])
    return years.select(F.explode(days).alias("holiday"))


@query("H10", with_views(HOLIDAY_SQL, """
SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), coalesce(
    min(holiday) FILTER (WHERE holiday > CAST(o_orderdate AS DATE)), max(holiday))) AS "date2Holiday"
FROM orders JOIN holidays ON year(holiday) = year(o_orderdate) GROUP BY o_orderkey, o_orderdate"""))
def days_to_next_holiday(spark, d):
    rows = orders(spark, d).select("o_orderkey", "o_orderdate")
    return dates.days_to_holiday(rows, "o_orderdate", holiday_calendar(spark, d)).drop("o_orderdate")


@query("H11", with_views(CARDS, f"""
SELECT card_id, elapsed_time, elapsed_time * feature_1 AS days_feature1, feature_1 / nullif(elapsed_time, 0) AS days_feature1_ratio,
  elapsed_time * feature_2 AS days_feature2, feature_2 / nullif(elapsed_time, 0) AS days_feature2_ratio
FROM (SELECT *, {floor_days_sql("'2001-09-01'::TIMESTAMP", 'first_active_month::TIMESTAMP')} AS elapsed_time FROM cards)"""))
def tenure_and_codes(spark, d):
    cards = views.cards(spark, d).withColumn("elapsed_time", dates.tenure(F.col("first_active_month"), "2001-09-01"))
    made = dates.tenure_features(["feature_1", "feature_2"])
    return cards.select("card_id", "elapsed_time", *[c.alias(n) for n, c in made.items()])


@query("H12", with_views(EVENTS, """
SELECT event_id, round(sqrt(purchase_amount), 6) AS root, round(ln(1 + purchase_amount), 6) AS log1p,
  abs(purchase_amount - 250) AS distance, round_even(purchase_amount, 1) AS rounded, event_id % 7 AS remainder FROM ev"""))
def scalar_maths(spark, d):
    v = F.col("purchase_amount")
    return views.events(spark, d).select(
        "event_id", F.round(F.sqrt(v), 6).alias("root"), F.round(F.log1p(v), 6).alias("log1p"),
        F.abs(v - 250).alias("distance"), F.bround(v, 1).alias("rounded"), (F.col("event_id") % 7).alias("remainder"))


@query("B5", with_views(TXN, CLEAN, "SELECT card_id, " + ", ".join(
    f"{money(where=f'{HIST} AND month_lag >= {lag}')} AS hist_amount_{abs(lag)}, "
    f"count(*) FILTER (WHERE {HIST} AND month_lag >= {lag}) AS hist_rows_{abs(lag)}" for lag in (-1, -3, -5, -7, -13))
    + " FROM tx GROUP BY card_id"))
def cumulative_lag_slices(spark, d):
    lags = (-1, -3, -5, -7, -13)
    return staged_clean(spark, d).groupBy("card_id").agg(*[c for lag in lags for c in (
        aggregate.exact_sum(F.when(history() & since(lag), F.col("purchase_amount")), 2).alias(f"hist_amount_{abs(lag)}"),
        F.count_if(history() & since(lag)).alias(f"hist_rows_{abs(lag)}"))])


@query("B9 B14 B15", with_views(TXN, CLEAN_BASE, """
SELECT o_orderkey, l_linenumber, category_2, category_3, installments, authorized_flag, category_1, purchase_amount FROM tx"""))
def cleaned_transactions(spark, d):
    return base_clean(spark, d).select("o_orderkey", "l_linenumber", "category_2", "category_3", "installments",
                                       "authorized_flag", "category_1", "purchase_amount")
