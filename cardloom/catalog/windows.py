"""Lag, difference, gap and outlier queries."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from cardloom.catalog.base import EVENTS, HIST, NEW, TXN, TXN_ORDER_SQL, digits_sql, floor_days_sql, query, register, with_views
from cardloom.catalog.common import digits
from cardloom.functions import dates
from cardloom.operators import windows
from cardloom.operators.ratios import history, lag_slices, recent
from cardloom.operators.aggregate import multi_agg
from cardloom.plans.features import HIST_LAGS, NEW_LAGS
from cardloom.sources import tables, views

GROUPS = {
    "card": (["card_id"], "E1"),
    "card_merchant": (["card_id", "merchant_id"], "E2"),
    "card_merchant_category": (["card_id", "merchant_category_id"], "E3"),
    "card_category_2": (["card_id", "category_2"], "E4"),
    "card_subsector": (["card_id", "subsector_id"], "E5"),
}


def lagged(keys: list[str]) -> str:
    return f"lag(purchase_amount) OVER (PARTITION BY {', '.join(keys)} ORDER BY {TXN_ORDER_SQL})"


def known(keys: list[str]):
    """Rows whose group keys are all present; a missing key forms no group."""
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).isNotNull()
    return condition


def lag_ratio_query(spark, d, keys):
    txn = views.transactions(spark, d).where(history() & known(keys))
    rows = windows.lag_ratio(txn, keys, views.TXN_ORDER, "purchase_amount", "shift_ratio")
    return multi_agg(rows, ["card_id"], [("shift_ratio", ["max"])])


for _name, (_keys, _row) in GROUPS.items():
    register(f"lag_ratio_per_{_name}", _row, partial(lag_ratio_query, keys=_keys), with_views(TXN, f"""
SELECT card_id, max(r) AS shift_ratio_max FROM (
  SELECT card_id, coalesce({lagged(_keys)}, 0) / nullif(purchase_amount, 0) AS r FROM txn
  WHERE {HIST} AND {' AND '.join(f'{k} IS NOT NULL' for k in _keys)}) GROUP BY card_id"""))


SLICES = {lag: f"{HIST} AND month_lag >= {lag}" for lag in HIST_LAGS} | {lag: f"{NEW} AND month_lag >= {lag}" for lag in NEW_LAGS}


@query("E6", with_views(TXN, f"""diffs AS (
SELECT card_id, month_lag, coalesce(purchase_amount - lag(purchase_amount) OVER (PARTITION BY card_id, {NEW} ORDER BY {TXN_ORDER_SQL}), 0) AS v FROM txn)
SELECT card_id, """ + ", ".join(
    [f"round({made}(v) FILTER (WHERE {where}), 4) + 0.0 AS \"v_{stat}_{lag}\"" for lag, where in SLICES.items() for stat, made in (
        ("max", "max"), ("min", "min"), ("median", "median"), ("std", "stddev_samp"))]
    + [f"{digits_sql(f'avg(v) FILTER (WHERE {where})')} AS \"v_mean_{lag}\"" for lag, where in SLICES.items()]) + " FROM diffs GROUP BY card_id"))
def amount_difference_per_slice(spark, d):
    txn = views.transactions(spark, d).withColumn("_new", recent())
    rows = windows.difference(txn, ["card_id", "_new"], views.TXN_ORDER, "purchase_amount", "v")
    table = multi_agg(rows, ["card_id"], [("v", ["max", "min", "mean", "median", "std"])],
                      slices=lag_slices(history(), HIST_LAGS) | lag_slices(recent(), NEW_LAGS))
    return table.select("card_id", *[(digits(F.col(c)) if "_mean_" in c else F.round(c, 4) + 0.0).alias(c) for c in table.columns if c != "card_id"])


FAMILIES = {"merchant": ["card_id", "merchant_id"], "category": ["card_id", "merchant_category_id"],
            "c2": ["card_id", "category_2"], "subsector": ["card_id", "subsector_id"]}


@query("E7", with_views(TXN, "diffs AS (SELECT card_id, " + ", ".join(
    f"coalesce(purchase_amount - {lagged(k)}, 0) AS d_{n}, coalesce({lagged(k)}, 0) / nullif(purchase_amount, 0) AS r_{n}"
    for n, k in FAMILIES.items()) + " FROM txn)", "SELECT card_id, " + ", ".join(
    f"max(r_{n}) AS {n}_shift_ratio_max, round(max(d_{n}), 4) AS {n}_diff_max, round(median(d_{n}), 4) AS {n}_diff_median"
    for n in FAMILIES) + " FROM diffs GROUP BY card_id"))
def change_summary_per_grouping(spark, d):
    needed = dict.fromkeys([*(c for group in FAMILIES.values() for c in group), *views.TXN_ORDER])
    rows = tables.stage(views.transactions(spark, d).select(*needed), "changes")
    table = windows.change_summary(rows, "card_id", FAMILIES, views.TXN_ORDER, "purchase_amount")
    return table.withColumns({c: F.round(c, 4) for c in table.columns if "_diff_" in c})


PREVIOUS = "lag(purchase_date) OVER (PARTITION BY card_id ORDER BY purchase_date, event_id)"
SECONDS = f"CAST(floor((epoch_us(purchase_date) - epoch_us({PREVIOUS})) / 1000000.0) AS BIGINT)"
GAPS = f"""gaps AS (SELECT event_id, {floor_days_sql('purchase_date', PREVIOUS)} AS dd,
  (({SECONDS} % 86400) + 86400) % 86400 AS ss FROM ev)"""


@query("E8 E9", with_views(EVENTS, GAPS, """
SELECT event_id, coalesce(dd, (SELECT avg(dd) FROM gaps)) AS purchase_time_diff_days,
  coalesce(ss, (SELECT avg(ss) FROM gaps)) AS purchase_time_diff_seconds FROM gaps"""))
def purchase_time_gaps(spark, d):
    rows = windows.purchase_gaps(views.events(spark, d), ["card_id"], views.EVENT_ORDER, "purchase_date")
    return rows.select("event_id", "purchase_time_diff_days", "purchase_time_diff_seconds")


@query("E10", with_views(EVENTS, f"""
SELECT event_id, date_diff('day', CAST({PREVIOUS} AS DATE), CAST(purchase_date AS DATE)) AS day_diff FROM ev"""))
def day_index_difference(spark, d):
    rows = views.events(spark, d).withColumn("day_gap", dates.day_gap(F.col("purchase_date"), "2024-01-31"))
    return windows.difference(rows, ["card_id"], views.EVENT_ORDER, "day_gap", "day_diff", first=None).select("event_id", "day_diff")


@query("E11", """SELECT p_type AS feature, n AS importance, n / CAST(sum(n) OVER () AS DOUBLE) AS normalized_importance,
  sum(n) OVER (ORDER BY n DESC, p_type) / CAST(sum(n) OVER () AS DOUBLE) AS cumulative_importance
FROM (SELECT p_type, count(*) AS n FROM part GROUP BY 1)""")
def cumulative_share(spark, d):
    counts = views.table(spark, d, "part").groupBy(F.col("p_type").alias("feature")).agg(F.count(F.lit(1)).alias("importance"))
    return windows.cumulative_share(counts, "importance", "feature")


LIMITS = """flags AS (
SELECT event_id, card_id, purchase_amount, CAST(purchase_amount > m + 2.04 * s AS INTEGER) AS u, CAST(purchase_amount < m - 2.04 * s AS INTEGER) AS l
FROM ev JOIN (SELECT card_id, CAST(sum(CAST(purchase_amount AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS m,
                     stddev_samp(purchase_amount) AS s FROM ev GROUP BY 1) USING (card_id))"""


@query("E12", with_views(EVENTS, LIMITS, """
SELECT event_id, coalesce(u, 0) AS upper_outlier, coalesce(l, 0) AS lower_outlier FROM flags"""))
def outlier_flags(spark, d):
    rows = windows.outlier_flags(views.events(spark, d), "card_id", "purchase_amount")
    return rows.select("event_id", "upper_outlier", "lower_outlier")


@query("E13", with_views(EVENTS, LIMITS, """
SELECT event_id, CASE WHEN u = 1 THEN max(purchase_amount) FILTER (WHERE u = 0 AND l = 0) OVER (PARTITION BY card_id)
  WHEN l = 1 THEN min(purchase_amount) FILTER (WHERE u = 0 AND l = 0) OVER (PARTITION BY card_id)
  ELSE purchase_amount END AS purchase_amount_capped FROM flags"""))
def capped_outliers(spark, d):
    return windows.cap_outliers(views.events(spark, d), "card_id", "purchase_amount").select("event_id", "purchase_amount_capped")
