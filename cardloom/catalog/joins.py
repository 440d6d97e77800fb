"""Joins, set operations, sorts and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardloom.catalog.base import CARDS, HIST, MERCHANTS, NEW, TXN, money, query, with_views
from cardloom.operators import aggregate, folds, joins, pivots
from cardloom.operators.ordering import global_index
from cardloom.operators.ratios import history, recent
from cardloom.operators.select import top_features
from cardloom.sources import views


@query("C1", with_views(CARDS, TXN, """
SELECT card_id, target, rows FROM cards LEFT JOIN (SELECT card_id, count(*) AS rows FROM txn GROUP BY card_id) USING (card_id)"""))
def enrich_cards(spark, d):
    rows = views.transactions(spark, d).groupBy("card_id").agg(F.count(F.lit(1)).alias("rows"))
    return aggregate.attach(views.cards(spark, d).select("card_id", "target"), rows, ["card_id"])


@query("C2", with_views(TXN, """
SELECT o_orderkey, l_linenumber,
  CAST(SUM(CAST(purchase_amount AS DECIMAL(18,2))) OVER (PARTITION BY card_id, merchant_id) AS DOUBLE) AS pair_amount FROM txn"""))
def enrich_by_two_keys(spark, d):
    txn = views.transactions(spark, d)
    rows = aggregate.group_transform(txn, ["card_id", "merchant_id"], "purchase_amount", {"pair_amount": "sum"})
    return rows.select("o_orderkey", "l_linenumber", "pair_amount")


SIDE = "SELECT card_id, count(*) AS {0}_rows, max(purchase_amount) AS {0}_max FROM txn WHERE {1} GROUP BY card_id"


@query("C3", with_views(TXN, f"""
SELECT * FROM ({SIDE.format('new', NEW)}) FULL JOIN ({SIDE.format('hist', HIST + " AND authorized_flag = 'N'")}) USING (card_id)"""))
def full_outer_history_new(spark, d):
    txn = views.transactions(spark, d)

    def side(name, where):
        return txn.where(where).groupBy("card_id").agg(F.count(F.lit(1)).alias(f"{name}_rows"),
                                                       F.max("purchase_amount").alias(f"{name}_max"))
    return joins.full_outer(["card_id"], side("new", recent()), side("hist", history() & (F.col("authorized_flag") == "N")))


@query("C4", with_views(CARDS, TXN, "SELECT card_id, " + ", ".join(
    f"CAST(EXISTS (SELECT 1 FROM txn t WHERE t.card_id = c.card_id AND month_lag = {lag}) AS INTEGER) AS is_in_new_monthlag{lag}"
    for lag in (1, 2)) + " FROM cards c"))
def membership_flags(spark, d):
    txn = views.transactions(spark, d)
    return joins.membership(views.cards(spark, d).select("card_id"), txn, "card_id", {
        f"is_in_new_monthlag{lag}": F.col("month_lag") == lag for lag in (1, 2)})


@query("C5", with_views(TXN, MERCHANTS, """
SELECT o_orderkey, l_linenumber, txn.city_id, category_4, merchant_group_id FROM txn LEFT JOIN merchants USING (merchant_id)"""))
def join_new_dimension_columns(spark, d):
    joined = joins.add_missing_columns(views.transactions(spark, d), views.merchants(spark, d), "merchant_id")
    return joined.select("o_orderkey", "l_linenumber", "city_id", "category_4", "merchant_group_id")


@query("C6", with_views(TXN, MERCHANTS, """
SELECT category_4, count(*) AS n FROM txn LEFT JOIN
  (SELECT * FROM merchants UNION ALL SELECT * FROM merchants WHERE merchant_group_id < 5) USING (merchant_id)
GROUP BY category_4"""))
def join_dimension_with_fan_out(spark, d):
    merchants = views.merchants(spark, d)
    repeated = merchants.unionByName(merchants.where("merchant_group_id < 5"))
    joined = joins.dimension(views.transactions(spark, d), repeated, "merchant_id", ["category_4"])
    return joined.groupBy("category_4").agg(F.count(F.lit(1)).alias("n"))


@query("C6", with_views(TXN, MERCHANTS, """
SELECT merchant_group_id, count(*) AS n FROM txn LEFT JOIN merchants USING (merchant_id) GROUP BY merchant_group_id"""))
def join_dimension_deduplicated(spark, d):
    merchants = views.merchants(spark, d)
    joined = joins.dimension(views.transactions(spark, d), merchants.unionByName(merchants), "merchant_id",
                             ["merchant_group_id"], dedupe=True)
    return joined.groupBy("merchant_group_id").agg(F.count(F.lit(1)).alias("n"))


@query("C7", with_views(TXN, f"""
SELECT card_id, {money(where=HIST)} AS hist_amount, {money(where=NEW)} AS new_amount FROM txn
GROUP BY card_id HAVING count(*) FILTER (WHERE {HIST}) > 0"""))
def history_left_join_new(spark, d):
    txn = views.transactions(spark, d)
    table = aggregate.multi_agg(txn, ["card_id"], [("purchase_amount", ["sum", "count"])],
                                slices={"_hist": history(), "_new": recent()})
    return table.where("purchase_amount_count_hist > 0").select(
        "card_id", F.col("purchase_amount_sum_hist").alias("hist_amount"),
        F.when(F.col("purchase_amount_count_new") > 0, F.col("purchase_amount_sum_new")).alias("new_amount"))


MONTHS = [200009, 200010, 200011, 200012, 200101, 200102, 200103, 200104, 200105, 200106, 200107, 200108]
MONTHLY = f"""monthly AS (
SELECT o_custkey AS card_id, year(o_orderdate) * 100 + month(o_orderdate) AS year_month, {money('l_extendedprice')} AS s
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""
MONTH_COLUMNS = ", ".join(f"max(s) FILTER (WHERE year_month = {m}) AS old_purchase_amount_sum_{m}" for m in MONTHS)


@query("C8", with_views(CARDS, MONTHLY, f"""
SELECT * FROM (SELECT card_id FROM cards) LEFT JOIN (SELECT card_id, {MONTH_COLUMNS} FROM monthly GROUP BY card_id) USING (card_id)"""))
def join_per_month(spark, d):
    wide = pivots.month_columns(views.monthly_sums(spark, d), "card_id", "year_month", "old_purchase_amount_sum", MONTHS)
    return aggregate.attach(views.cards(spark, d).select("card_id"), wide, ["card_id"])


# Recent months against older months, at the end of the supplied calendar.
TRENDS = [([200108], [200107]), ([200108, 200107], [200106, 200105]),
          ([200108, 200107], [200106, 200105, 200104, 200103]),
          ([200108, 200107, 200106], [200105, 200104, 200103]),
          ([200108, 200107, 200106], [200105, 200104, 200103, 200102, 200101, 200012])]


def trend_sql(months):
    return " + ".join(f"old_purchase_amount_sum_{m}" for m in months)


@query("D46", with_views(MONTHLY, f"wide AS (SELECT card_id, {MONTH_COLUMNS} FROM monthly GROUP BY card_id)",
                         "SELECT card_id, " + ", ".join(
    f"({trend_sql(a)}) / nullif({trend_sql(b)}, 0) AS old_purchase_amount_sum_ratio_{i}"
    for i, (a, b) in enumerate(TRENDS, 1)) + " FROM wide"))
def month_trend_ratios(spark, d):
    wide = pivots.month_columns(views.monthly_sums(spark, d), "card_id", "year_month", "old_purchase_amount_sum", MONTHS)
    trends = pivots.trend_ratios(wide, "old_purchase_amount_sum", TRENDS)
    return trends.select("card_id", *[c for c in trends.columns if "_ratio_" in c])


@query("C9", with_views(CARDS, TXN, f"""
SELECT card_id, amount, n_merchants, first_purchase FROM (SELECT card_id FROM cards)
LEFT JOIN (SELECT card_id, {money()} AS amount FROM txn GROUP BY 1) USING (card_id)
LEFT JOIN (SELECT card_id, count(DISTINCT merchant_id) AS n_merchants FROM txn GROUP BY 1) USING (card_id)
LEFT JOIN (SELECT card_id, min(purchase_date) AS first_purchase FROM txn GROUP BY 1) USING (card_id)"""))
def merge_feature_tables(spark, d):
    by_card = views.transactions(spark, d).groupBy("card_id")
    tables = [by_card.agg(aggregate.exact_sum(F.col("purchase_amount"), 2).alias("amount")),
              by_card.agg(F.count_distinct("merchant_id").alias("n_merchants")),
              by_card.agg(F.min("purchase_date").alias("first_purchase"))]
    return aggregate.attach_all(views.cards(spark, d).select("card_id"), tables, ["card_id"])


@query("C10", """SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer""")
def concat_columns(spark, d):
    customer = views.table(spark, d, "customer")
    return joins.side_by_side("c_custkey", customer.select("c_custkey", "c_name"),
                              customer.select("c_custkey", "c_acctbal"), customer.select("c_custkey", "c_mktsegment"))


@query("G1", with_views(TXN, f"SELECT card_id, purchase_amount FROM txn WHERE {HIST} UNION ALL SELECT card_id, purchase_amount FROM txn WHERE {NEW}"))
def union_history_new(spark, d):
    txn = views.transactions(spark, d).select("card_id", "purchase_amount", "month_lag")
    return txn.where(history()).unionByName(txn.where(recent())).drop("month_lag")


FOLD_SQL = "CAST(('0x' || substr(md5(card_id || ':326'), 1, 8))::BIGINT % 5 AS INTEGER)"


@query("G3", with_views(CARDS, f"""
SELECT fold, count(*) AS rows, {money('target')} / count(target) AS mean_target
FROM (SELECT *, {FOLD_SQL} AS fold FROM cards) GROUP BY fold"""))
def fold_rows_appended(spark, d):
    assigned = folds.kfold(views.cards(spark, d), "card_id", 5, 326)
    return joins.append([
        assigned.where(F.col("fold") == f).agg(
            F.first("fold").alias("fold"), F.count(F.lit(1)).alias("rows"),
            (aggregate.exact_sum(F.col("target"), 2) / F.count("target")).alias("mean_target")) for f in range(5)])


@query("G4", "SELECT c_custkey, c_acctbal FROM customer")
def column_set_algebra(spark, d):
    customer = views.table(spark, d, "customer")
    return joins.without(customer, ["c_name", "c_nationkey", "c_mktsegment", "absent"])


@query("F1", with_views(TXN, """
SELECT card_id, o_orderkey, l_linenumber, purchase_date FROM txn ORDER BY card_id, purchase_date"""))
def sort_by_card_and_date(spark, d):
    rows = views.transactions(spark, d).select("card_id", "o_orderkey", "l_linenumber", "purchase_date")
    return rows.sort("card_id", "purchase_date")


@query("F2", with_views(TXN, """
SELECT merchant_id AS feature, avg(month_lag) AS importance FROM txn GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"""))
def top_by_mean_importance(spark, d):
    rows = views.transactions(spark, d).select(F.col("merchant_id").alias("feature"), F.col("month_lag").alias("importance"))
    return top_features(rows, 20)


@query("F4", "SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS original FROM customer")
def restore_original_order(spark, d):
    indexed = global_index(views.table(spark, d, "customer").select("c_custkey", "c_acctbal"), ["c_custkey"], "original")
    return joins.restore_order(indexed.sort("c_acctbal"), "original", keep=True).drop("c_acctbal")


@query("F6", """SELECT p_type AS value, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, value""")
def sorted_frequency_report(spark, d):
    return joins.frequency_report(views.table(spark, d, "part"), "p_type")
