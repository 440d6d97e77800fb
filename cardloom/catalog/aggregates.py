"""Grouped statistics, pivots, ratios and rates."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from cardloom.catalog.base import (CARDS, CLEAN, CLEAN_BASE, EVENTS, HIST, MERCHANTS, NEW, TXN, counted, digits_sql, floor_days_sql,
                                   money, money_mean, query, register, with_views)
from cardloom.catalog.common import base_clean, digits, staged_clean
from cardloom.catalog.rows import HOLIDAY_SQL, INTERACTIONS_SQL, holiday_calendar
from cardloom.functions import clean, dates
from cardloom.operators import aggregate, combine, encode, joins, metrics, pivots, ratios
from cardloom.operators.aggregate import multi_agg
from cardloom.operators.folds import kfold
from cardloom.operators.ratios import history, lag_slices, recent
from cardloom.plans import outliers
from cardloom.sources import tables, views

AS_OF = "2001-09-01"
AS_OF_SQL = f"'{AS_OF}'::TIMESTAMP"


# --- one statistic attached to the card list -----------------------------------------------------------------

def attach_query(spark, d, function, value, name):
    return function(views.cards(spark, d).select("card_id"), staged_clean(spark, d).where(history()),
                    ["card_id"], value, name=name)


def attach_sql(value: str, name: str, expression: str) -> str:
    return with_views(CARDS, TXN, CLEAN, f"""
SELECT card_id, {name} FROM (SELECT card_id FROM cards) LEFT JOIN
  (SELECT card_id, {expression} AS {name} FROM tx WHERE {HIST} GROUP BY card_id) USING (card_id)""")


def mode_sql(value: str, name: str, made: str) -> str:
    return with_views(CARDS, TXN, CLEAN, f"""
SELECT card_id, {name} FROM (SELECT card_id FROM cards) LEFT JOIN (
  SELECT card_id, {made} AS {name} FROM (
    SELECT card_id, {value} AS v, count(*) AS n,
           row_number() OVER (PARTITION BY card_id ORDER BY count(*) DESC, {value} NULLS FIRST) AS place
    FROM tx WHERE {HIST} GROUP BY card_id, {value}) GROUP BY card_id) USING (card_id)""")


for _label, _row, _function, _value, _sql in [
    ("mean", "D1", aggregate.group_mean_attach, "purchase_amount", money_mean()),
    ("max", "D3", aggregate.group_max_attach, "purchase_amount", "max(purchase_amount)"),
    ("median", "D4", aggregate.group_median_attach, "purchase_amount", "median(purchase_amount)"),
    ("min", "D5", aggregate.group_min_attach, "purchase_amount", "min(purchase_amount)"),
    ("sum", "D6", aggregate.group_sum_attach, "purchase_amount", f"coalesce({money()}, 0)"),
    ("count", "D7", aggregate.group_count_attach, "category_2", "count(category_2)"),
]:
    register(f"group_{_label}_attach", _row, partial(attach_query, function=_function, value=_value, name="stat"),
             attach_sql(_value, "stat", _sql))


@query("D2", with_views(CARDS, TXN, CLEAN, f"""
SELECT card_id, round(stat, 6) AS stat FROM (SELECT card_id FROM cards) LEFT JOIN
  (SELECT card_id, stddev_samp(installments) AS stat FROM tx WHERE {HIST} GROUP BY card_id) USING (card_id)"""))
def group_std_attach(spark, d):
    table = attach_query(spark, d, aggregate.group_std_attach, "installments", "stat")
    return table.withColumn("stat", F.round("stat", 6))


for _label, _row, _function, _made in [
    ("mode", "D8", aggregate.group_mode_attach, "max(v) FILTER (WHERE place = 1)"),
    ("nunique", "D9", aggregate.group_nunique_attach, "count(*)"),
    ("mode_ratio", "D10", aggregate.group_mode_ratio_attach, "max(n) / CAST(sum(n) AS DOUBLE)"),
    ("nunique_ratio", "D11", aggregate.group_nunique_ratio_attach, "count(*) / CAST(sum(n) AS DOUBLE)"),
]:
    register(f"group_{_label}_attach", _row, partial(attach_query, function=_function, value="merchant_id", name="stat"),
             mode_sql("merchant_id", "stat", _made))


@query("D8 D9 D10 D11", with_views(TXN, """pairs AS (
SELECT card_id, category_2 AS v, count(*) AS n FROM txn GROUP BY 1, 2)
SELECT card_id, arg_min_null(v, coalesce(v, -1) - n * 10) AS category_2_mode, count(*) AS category_2_nunique,
  max(n) / CAST(sum(n) AS DOUBLE) AS category_2_mode_ratio, count(*) / CAST(sum(n) AS DOUBLE) AS category_2_nunique_ratio
FROM pairs GROUP BY card_id"""))
def category_profile_with_missing(spark, d):
    return aggregate.category_profile(views.transactions(spark, d), ["card_id"], ["category_2"])


# --- the spec-driven aggregate ---------------------------------------------------------------------------------

def base_features(spark, d):
    """Row columns of the baseline aggregate."""
    rows = dates.date_parts(base_clean(spark, d), "purchase_date", ["month", "hour", "weekofyear", "weekday", "day", "weekend"])
    ts = F.col("purchase_date")
    rows = rows.withColumn("month_diff", dates.month_age(ts, AS_OF, F.col("month_lag")))
    amount = F.col("purchase_amount")
    return rows.withColumns({"price": clean.ratio(amount, F.col("installments")),
                             "duration": amount * F.col("month_diff"),
                             "amount_month_ratio": clean.ratio(amount, F.col("month_diff"))})


BASE_FEATURES = CLEAN_BASE + f""",
bf AS (SELECT *, month(purchase_date) AS m, hour(purchase_date) AS h, weekofyear(purchase_date) AS w,
  isodow(purchase_date) - 1 AS wd, day(purchase_date) AS dd, CAST(isodow(purchase_date) >= 6 AS INTEGER) AS we,
  CAST(floor({floor_days_sql(AS_OF_SQL, 'purchase_date')} / 30.0) AS INTEGER) + month_lag AS month_diff FROM tx)"""


@query("D12 D12b D12c", with_views(TXN, BASE_FEATURES, f"""
SELECT card_id, count(DISTINCT merchant_id) AS hist_merchant_id_nunique,
  count(DISTINCT merchant_category_id) AS hist_merchant_category_id_nunique,
  {money()} AS hist_purchase_amount_sum, {money_mean()} AS hist_purchase_amount_mean,
  max(purchase_amount) AS hist_purchase_amount_max, min(purchase_amount) AS hist_purchase_amount_min,
  median(purchase_amount) AS hist_purchase_amount_median,
  coalesce(CAST(sum(installments) AS DOUBLE), 0) AS hist_installments_sum, avg(installments) AS hist_installments_mean,
  max(installments) AS hist_installments_max, count(installments) AS hist_installments_count,
  round(var_samp(installments), 6) AS hist_installments_var,
  count(*) AS hist_card_id_size, count(card_id) AS hist_card_id_count,
  max(purchase_date) AS hist_purchase_date_max, min(purchase_date) AS hist_purchase_date_min,
  max(month_diff) AS hist_month_diff_max, avg(month_diff) AS hist_month_diff_mean,
  avg(authorized_flag) AS hist_authorized_flag_mean, avg(we) AS hist_weekend_mean
FROM bf WHERE {HIST} GROUP BY card_id"""))
def multi_statistic_table(spark, d):
    spec = [("merchant_id", ["nunique"]), ("merchant_category_id", ["nunique"]),
            ("purchase_amount", ["sum", "mean", "max", "min", "median"]),
            ("installments", ["sum", "mean", "max", "count", "var"]), ("card_id", ["size", "count"]),
            ("purchase_date", ["max", "min"]), ("month_diff", ["max", "mean"]),
            ("authorized_flag", ["mean"]), ("weekend", ["mean"])]
    rows = tables.stage(base_features(spark, d), "base_features")
    table = multi_agg(rows.where(history()), ["card_id"], spec, prefix="hist_")
    return table.withColumn("hist_installments_var", F.round("hist_installments_var", 6))


@query("D12a D12d", with_views(TXN, BASE_FEATURES, """
SELECT card_id, """ + ", ".join(
    f"round(CASE WHEN count({c}) < 3 THEN NULL WHEN min({c}) = max({c}) THEN 0 ELSE skewness({c}) END, 6) + 0.0 AS {c}_skew, "
    f"round(var_samp({c}), 6) AS {c}_var" for c in ("month_lag", "installments", "month_diff"))
    + " FROM bf GROUP BY card_id"))
def skewness_and_variance(spark, d):
    columns = ("month_lag", "installments", "month_diff")
    table = multi_agg(base_features(spark, d), ["card_id"], [(c, ["skew", "var"]) for c in columns])
    return table.withColumns({f"{c}_{s}": F.round(f"{c}_{s}", 6) + 0.0 for c in columns for s in ("skew", "var")})


@query("D13", with_views(TXN, """
SELECT card_id, count(*) AS card_id_counts, count(*) / CAST((SELECT count(*) FROM txn) AS DOUBLE) AS card_id_ratio
FROM txn GROUP BY card_id"""))
def frequency_and_share(spark, d):
    return aggregate.frequency(views.transactions(spark, d), "card_id", "card_id_counts", "card_id_ratio")


@query("D14", with_views(TXN, CLEAN_BASE, f"""stats AS (
SELECT category_3, {money_mean()} AS m, min(purchase_amount) AS lo, max(purchase_amount) AS hi, {money()} AS s FROM tx GROUP BY 1)
SELECT o_orderkey, l_linenumber, m AS category_3_mean, lo AS category_3_min, hi AS category_3_max, s AS category_3_sum
FROM tx JOIN stats USING (category_3)"""))
def group_statistic_on_rows(spark, d):
    rows = aggregate.group_transform(base_clean(spark, d), ["category_3"], "purchase_amount",
                                     {f"category_3_{s}": s for s in ("mean", "min", "max", "sum")})
    return rows.select("o_orderkey", "l_linenumber", *[f"category_3_{s}" for s in ("mean", "min", "max", "sum")])


@query("D15", with_views(TXN, f"""inner_means AS (
SELECT card_id, merchant_id, {money_mean(where=HIST)} AS h, {money_mean(where=NEW)} AS n FROM txn GROUP BY 1, 2)
SELECT card_id, max(h) AS mean_hist_max, min(h) AS mean_hist_min, {digits_sql('stddev_samp(h)')} AS mean_hist_std,
  {digits_sql('median(h)')} AS mean_hist_median, max(n) AS mean_new_max, min(n) AS mean_new_min,
  {digits_sql('stddev_samp(n)')} AS mean_new_std, {digits_sql('median(n)')} AS mean_new_median FROM inner_means GROUP BY card_id"""))
def two_level_statistics(spark, d):
    table = aggregate.two_level(views.transactions(spark, d), "card_id", ["merchant_id"], "purchase_amount", "mean",
                                ["max", "min", "std", "median"], "mean", {"_hist": history(), "_new": recent()})
    return table.withColumns({f"mean_{p}_{s}": digits(F.col(f"mean_{p}_{s}")) for p in ("hist", "new") for s in ("std", "median")})


GROUP_REFERENCES = {"max": "max(purchase_amount) OVER own", "mean": "CAST(sum(CAST(purchase_amount AS DECIMAL(18,2))) OVER own AS DOUBLE) / count(purchase_amount) OVER own"}


@query("D16", with_views(TXN, "rel AS (SELECT card_id, " + ", ".join(f"purchase_amount / ({e}) AS {n}" for n, e in GROUP_REFERENCES.items())
                         + " FROM txn WINDOW own AS (PARTITION BY card_id, merchant_category_id)) SELECT card_id, " + ", ".join(
    f"{digits_sql(f'max({n})')} AS {n}_max, {digits_sql(f'stddev_samp({n})')} AS {n}_std, {digits_sql(f'median({n})')} AS {n}_median" for n in GROUP_REFERENCES)
    + " FROM rel GROUP BY card_id"))
def spend_relative_to_group(spark, d):
    txn = tables.stage(views.transactions(spark, d), "relative")
    parts = [aggregate.relative_to_group(txn, "card_id", ["merchant_category_id"], "purchase_amount", n, ["max", "std", "median"], n)
             for n in GROUP_REFERENCES]
    table = parts[0].join(parts[1], "card_id")
    return table.select("card_id", *[digits(F.col(c)).alias(c) for c in table.columns if c != "card_id"])


MEAN_COLUMNS = ["category_2", "state_id", "subsector_id"]


# As the reference does, the history means serve both slices.
@query("D17", with_views(TXN, *[f"""m_{c} AS (
SELECT card_id, {c}, {money_mean()} AS m FROM txn WHERE {HIST} AND {c} IS NOT NULL GROUP BY 1, 2)""" for c in MEAN_COLUMNS], "SELECT card_id, " + ", ".join(
    f"{digits_sql(f'max(m_{c}.m) FILTER (WHERE {w})')} AS {c}_mean_{p}_max, {digits_sql(f'median(m_{c}.m) FILTER (WHERE {w})')} AS {c}_mean_{p}_median"
    for c in MEAN_COLUMNS for p, w in (("hist", HIST), ("new", NEW))) + " FROM txn " + " ".join(
    f"LEFT JOIN m_{c} USING (card_id, {c})" for c in MEAN_COLUMNS) + " GROUP BY card_id"))
def category_mean_on_rows(spark, d):
    txn = tables.stage(views.transactions(spark, d).select("card_id", "month_lag", "purchase_amount", *MEAN_COLUMNS), "means")
    table = txn.select("card_id").distinct()
    for c in MEAN_COLUMNS:
        for part, where in (("hist", history()), ("new", recent())):
            made = aggregate.group_mean_summary(txn.where(where), "card_id", [c], "purchase_amount", ["max", "median"],
                                                f"{c}_mean_{part}", source=txn.where(history() & F.col(c).isNotNull()))
            table = table.join(made, "card_id", "left")
    return table.select("card_id", *[digits(F.col(c)).alias(c) for c in table.columns if c != "card_id"])


@query("D18", with_views(TXN, """visits AS (SELECT card_id, merchant_id, count(purchase_amount) AS n FROM txn GROUP BY 1, 2)
SELECT card_id, max(CASE WHEN n > 1 THEN n ELSE 0 END) / CAST(sum(n) AS DOUBLE) AS repurchase_ratio FROM visits GROUP BY card_id"""))
def repurchase_ratio(spark, d):
    return aggregate.repurchase_ratio(views.transactions(spark, d), "card_id", ["merchant_id"], "purchase_amount",
                                      "repurchase_ratio")


@query("D19", with_views(HOLIDAY_SQL, TXN, f"""gaps AS (
SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), coalesce(
    min(holiday) FILTER (WHERE holiday > CAST(o_orderdate AS DATE)), max(holiday))) AS g
FROM orders JOIN holidays ON year(holiday) = year(o_orderdate) GROUP BY o_orderkey, o_orderdate)""", f"""sums AS (
SELECT card_id, g, {money(where=HIST)} AS h, {money(where=NEW)} AS n FROM txn JOIN gaps USING (o_orderkey) GROUP BY 1, 2)
SELECT card_id, max(h) AS hist_holiday_purchase_max, max(n) AS new_holiday_purchase_max,
  max(n) / max(h) AS new_hist_holiday_purchase_max_ratio FROM sums GROUP BY card_id HAVING max(h) IS NOT NULL"""))
def holiday_spend_peak(spark, d):
    rows = dates.days_to_holiday(views.transactions(spark, d), "purchase_date", holiday_calendar(spark, d))
    return ratios.peak_group_ratio(rows, "card_id", "date2Holiday", "purchase_amount", "holiday_purchase")


# --- pivots -------------------------------------------------------------------------------------------------------

GAP_SQL = "CAST(floor(date_diff('day', DATE '2001-02-28', CAST(purchase_date AS DATE)) / 30.0) AS INTEGER)"


def every_gap_sql(cell: str, source: str, where: str = "TRUE") -> str:
    """One row for each card and each month gap that occurs anywhere, as the wide table's cells."""
    return f"""cells AS (SELECT card_id, {GAP_SQL} AS month_gap, {cell} AS cell FROM {source} WHERE {where} GROUP BY 1, 2)
SELECT card_id, month_gap, coalesce(cell, 0) AS cell FROM (SELECT DISTINCT card_id FROM cells)
CROSS JOIN (SELECT DISTINCT month_gap FROM cells) LEFT JOIN cells USING (card_id, month_gap)"""


def every_gap(wide):
    """The wide table as rows: its columns are all gaps found in the data, so no fixed list can cut any."""
    long = wide.unpivot(["card_id"], [F.col(f"`{c}`") for c in wide.columns[1:]], "month_gap", "cell")
    return long.withColumn("month_gap", F.col("month_gap").cast("int"))


def gap_rows(spark, d):
    return staged_clean(spark, d).withColumn("month_gap", dates.month_gap(F.col("purchase_date"), "2001-02-28"))


@query("D20", with_views(TXN, every_gap_sql(money(), "txn", HIST)))
def monthly_spend_pivot(spark, d):
    return every_gap(pivots.sum_pivot(gap_rows(spark, d).where(history()), "card_id", "month_gap", "purchase_amount", name=str))


@query("D21", with_views(TXN, "SELECT card_id, count(DISTINCT weekofyear(purchase_date)) AS purchase_counts, " + ", ".join(
    f"coalesce({money(where=f'weekofyear(purchase_date) = {w}')}, 0) AS week{w}_purchase" for w in range(1, 54))
    + f" FROM txn WHERE {HIST} GROUP BY card_id"))
def weekly_spend_pivot(spark, d):
    rows = dates.date_parts(staged_clean(spark, d).where(history()), "purchase_date", ["weekofyear"])
    return pivots.sum_pivot(rows, "card_id", "weekofyear", "purchase_amount", list(range(1, 54)),
                            lambda w: f"week{w}_purchase", active="purchase_counts")


@query("D22", with_views(TXN, CLEAN, every_gap_sql("CAST(sum(installments) AS DOUBLE)", "tx")))
def monthly_installment_pivot(spark, d):
    return every_gap(pivots.sum_pivot(gap_rows(spark, d), "card_id", "month_gap", "installments", name=str))


@query("D23", with_views(TXN, CLEAN, "SELECT card_id, " + ", ".join(
    f"coalesce(CAST(sum(installments) FILTER (WHERE weekofyear(purchase_date) = {w}) AS DOUBLE), 0) AS week{w}_installments"
    for w in range(1, 54)) + " FROM tx GROUP BY card_id"))
def weekly_installment_pivot(spark, d):
    rows = dates.date_parts(staged_clean(spark, d), "purchase_date", ["weekofyear"])
    return pivots.sum_pivot(rows, "card_id", "weekofyear", "installments", list(range(1, 54)), lambda w: f"week{w}_installments")


@query("D24", with_views(TXN, CLEAN, "SELECT card_id, " + ", ".join(
    f"coalesce({money(where=f'authorized_flag = {v}')}, 0) AS authorized_flag_{v}, "
    f"coalesce({money(where=f'authorized_flag = {v}')}, 0) / nullif({money()}, 0) AS authorized_flag_{v}_ratio" for v in (0, 1))
    + f" FROM tx WHERE {HIST} GROUP BY card_id"))
def spend_by_authorisation(spark, d):
    return pivots.share_pivot(staged_clean(spark, d).where(history()), "card_id", "authorized_flag", "purchase_amount", [0, 1])


def share_sql(column: str, values, table: str = "tx") -> str:
    return "SELECT card_id, " + ", ".join(
        f"coalesce({money(where=f'{column} = {v!r}')}, 0) AS \"{pivots.value_name(column, v)}\", "
        f"coalesce({money(where=f'{column} = {v!r}')}, 0) / nullif({money(where=f'{column} IS NOT NULL')}, 0) AS \"{pivots.value_name(column, v)}_ratio\""
        for v in values) + f" FROM {table} WHERE {HIST} AND {column} IS NOT NULL GROUP BY card_id"


def share_query(spark, d, column, values):
    rows = staged_clean(spark, d).where(history()).withColumn("install_flag", (F.col("installments") > 0).cast("int"))
    if column == "category_4":
        rows = joins.dimension(rows, views.merchants(spark, d), "merchant_id", ["category_4"])
    return pivots.share_pivot(rows, "card_id", column, "purchase_amount", values)


for _column, _values in {"install_flag": [0, 1], "category_1": [0, 1], "category_2": [1.0, 2.0, 3.0, 4.0, 6.0],
                         "category_3": [0, 1, 2], "category_4": ["N", "Y"], "subsector_id": list(range(10))}.items():
    _views = [TXN, CLEAN]
    _table = "tx"
    if _column == "install_flag":
        _views.append("wide AS (SELECT *, CAST(installments > 0 AS INTEGER) AS install_flag FROM tx)")
        _table = "wide"
    if _column == "category_4":
        _views += [MERCHANTS, "wide AS (SELECT tx.*, category_4 FROM tx LEFT JOIN merchants USING (merchant_id))"]
        _table = "wide"
    register(f"spend_share_by_{_column}", "D25", partial(share_query, column=_column, values=_values),
             with_views(*_views, share_sql(_column, _values, _table)))


@query("D26", with_views(TXN, f"""
SELECT card_id, merchant_category_id AS category, {money()} AS amount, count(purchase_amount) AS n FROM txn GROUP BY 1, 2"""))
def card_category_matrix(spark, d):
    return pivots.category_matrix(views.transactions(spark, d), "card_id", "merchant_category_id", "purchase_amount")


@query("D26", with_views(CARDS, TXN, "SELECT card_id, " + ", ".join(
    f"coalesce({counted('purchase_amount', f'city_id = {c}')}, 0) AS \"{c}_purchase_counts\"" for c in range(25))
    + " FROM (SELECT card_id FROM cards) LEFT JOIN txn USING (card_id) GROUP BY card_id"))
def card_city_count_matrix_wide(spark, d):
    wide = pivots.sum_pivot(views.transactions(spark, d), "card_id", "city_id", "purchase_amount", list(range(25)),
                            lambda c: f"{c}_purchase_counts", count=True)
    return aggregate.attach(views.cards(spark, d).select("card_id"), wide, ["card_id"]).na.fill(0)


# --- rates --------------------------------------------------------------------------------------------------------

ITEMS = outliers.RATE_ITEMS
MONTH_AGES = [("new_month_diff_mean", "mean"), ("hist_month_diff_mean", "mean"), ("hist_month_diff_max", "max"), ("hist_month_diff_min", "min")]


def rate_cards(spark, d):
    """Cards with the month ages that rates are learned for, beside the card's own codes."""
    rows = views.transactions(spark, d).withColumn("month_diff", dates.month_age(F.col("purchase_date"), AS_OF, F.col("month_lag")))
    ages = rows.groupBy("card_id").agg(*[
        {"mean": F.avg, "max": F.max, "min": F.min}[stat](F.when(history() if name.startswith("hist") else recent(), F.col("month_diff"))).alias(name)
        for name, stat in MONTH_AGES])
    return tables.stage(views.cards(spark, d).join(ages, "card_id", "left"), "rate_cards")


RATE_CARDS = (f"""ages AS (SELECT card_id, {', '.join(
    f"{ {'mean': 'avg'}.get(stat, stat) }(age) FILTER (WHERE {HIST if name.startswith('hist') else NEW}) AS {name}" for name, stat in MONTH_AGES)}
FROM (SELECT *, CAST(floor({floor_days_sql(AS_OF_SQL, 'purchase_date')} / 30.0) AS INTEGER) + month_lag AS age FROM txn) GROUP BY card_id),
rated AS (SELECT * FROM cards LEFT JOIN ages USING (card_id))""")


def rate_sql(keys, source="rated WHERE is_test = 0"):
    k = ", ".join(keys)
    return (f"(SELECT {k}, (sum(outlier) + 0.01) * 1000 / (count(outlier) + 0.01) AS {encode.rate_name(keys)} "
            f"FROM {source} GROUP BY {k}) USING ({k})")


def rates_sql(sets):
    """Rates of the training cards on every card."""
    return with_views(TXN, CARDS, RATE_CARDS, "SELECT card_id, " + ", ".join(
        f"round({encode.rate_name(k)}, 6) AS {encode.rate_name(k)}" for k in sets) + " FROM rated " + " ".join(f"LEFT JOIN {rate_sql(k)}" for k in sets))


def rounded_rates(rated, sets, *keys):
    return rated.select(*keys, *[F.round(encode.rate_name(k), 6).alias(encode.rate_name(k)) for k in sets])


SINGLE, PAIRS = encode.key_sets(ITEMS, pairs=False), [k for k in encode.key_sets(ITEMS) if len(k) == 2]


@query("D27", rates_sql(SINGLE))
def smoothed_rates(spark, d):
    cards = rate_cards(spark, d)
    return rounded_rates(encode.attach_rates(cards, cards.where("is_test = 0"), ITEMS, "outlier", "card_id", pairs=False), SINGLE, "card_id")


@query("D28", rates_sql(PAIRS))
def smoothed_pair_rates(spark, d):
    cards = rate_cards(spark, d)
    return rounded_rates(encode.attach_rates(cards, cards.where("is_test = 0"), ITEMS, "outlier", "card_id"), PAIRS, "card_id")


def outside_sql(keys):
    """Rate of each (key, fold) from the rows of the key in other folds."""
    k = ", ".join(keys)
    return (f"(SELECT {k}, fold, CASE WHEN sum(n) OVER w > n THEN round((sum(c) OVER w - c + 0.01) * 1000 / (sum(n) OVER w - n + 0.01), 6) END "
            f"AS {encode.rate_name(keys)} FROM (SELECT {k}, fold, sum(outlier) AS c, count(outlier) AS n FROM folded GROUP BY {k}, fold) "
            f"WINDOW w AS (PARTITION BY {k})) USING ({k}, fold)")


def out_of_fold_sql(folded, sets):
    return with_views(TXN, CARDS, RATE_CARDS, folded, "SELECT card_id, fold, " + ", ".join(encode.rate_name(k) for k in sets)
                      + " FROM folded " + " ".join(f"LEFT JOIN {outside_sql(k)}" for k in sets))


FOLDED = "folded AS (SELECT *, CAST(('0x' || substr(md5(card_id || ':326'), 1, 8))::BIGINT % 5 AS INTEGER) AS fold FROM rated)"


@query("D29", out_of_fold_sql(FOLDED, encode.key_sets(ITEMS)))
def out_of_fold_rates(spark, d):
    rated = encode.attach_out_of_fold(kfold(rate_cards(spark, d), "card_id", 5, 326), ITEMS, "outlier", "fold", "card_id")
    return rounded_rates(rated, encode.key_sets(ITEMS), "card_id", "fold")


# --- new period against history --------------------------------------------------------------------------------

DISTINCT = ["merchant_id", "merchant_category_id", "city_id", "subsector_id", "category_2"]


def values_sql(column, where):
    return (f"(count(DISTINCT {column}) FILTER (WHERE {where}) + "
            f"coalesce(max(CASE WHEN {column} IS NULL THEN 1 END) FILTER (WHERE {where}), 0))")


@query("D31", with_views(TXN, "SELECT card_id, " + ", ".join(
    f"coalesce(CAST({values_sql(c, NEW)} AS DOUBLE) / nullif({values_sql(c, HIST)}, 0), 0) AS new_hist_{c}_counts_ratio"
    for c in DISTINCT) + f" FROM txn GROUP BY card_id HAVING count(*) FILTER (WHERE {HIST}) > 0"))
def distinct_count_ratios(spark, d):
    return ratios.distinct_ratios(views.transactions(spark, d), "card_id", DISTINCT)


@query("D32", with_views(TXN, CLEAN, "SELECT card_id, " + ", ".join(
    f"coalesce(CAST(sum({c}) FILTER (WHERE {NEW}) AS DOUBLE) / nullif(sum({c}) FILTER (WHERE {HIST}), 0), 0) AS new_hist_{c}_sum_ratio"
    for c in ("installments", "authorized_flag")) + f" FROM tx GROUP BY card_id HAVING count(*) FILTER (WHERE {HIST}) > 0"))
def sum_ratios(spark, d):
    return ratios.sum_ratios(staged_clean(spark, d), "card_id", ["installments", "authorized_flag"])


INNER_KEYS = ["merchant_category_id", "merchant_id"]


@query("D33", with_views(TXN, *[f"""i_{k} AS (
SELECT card_id, {k}, {money_mean(where=HIST)} AS h, {money_mean(where=NEW)} AS n FROM txn GROUP BY 1, 2),
r_{k} AS (SELECT card_id, """ + ", ".join(f"{digits_sql(f'coalesce({s}(n) / nullif({s}(h), 0), 0)')} AS new_hist_{k}_mean_{s}_ratio" for s in ("max", "min", "median"))
    + f" FROM i_{k} GROUP BY card_id HAVING max(h) IS NOT NULL)" for k in INNER_KEYS], "SELECT * FROM "
    + " JOIN ".join(f"r_{k}" for k in INNER_KEYS) + " USING (card_id)"))
def two_level_ratios(spark, d):
    txn = tables.stage(views.transactions(spark, d), "inner")
    parts = [ratios.two_level_ratios(txn, "card_id", [k], "purchase_amount", ["max", "min", "median"], f"{k}_mean") for k in INNER_KEYS]
    table = parts[0].join(parts[1], "card_id")
    return table.select("card_id", *[digits(F.col(c)).alias(c) for c in table.columns if c != "card_id"])


LAGS = [0, -1, -2, -3, -4, -13]


@query("D34", with_views(TXN, "SELECT card_id, " + ", ".join(
    f"coalesce({money(where=NEW)} / nullif({money(where=f'{HIST} AND month_lag >= {lag}')}, 0), 0) AS \"new_hist_purchase_amount_sum_ratio_{lag}\""
    for lag in LAGS) + f" FROM txn GROUP BY card_id HAVING count(*) FILTER (WHERE {HIST}) > 0"))
def cumulative_lag_ratios(spark, d):
    return ratios.lag_sum_ratios(views.transactions(spark, d), "card_id", "purchase_amount", LAGS)


MEAN_LAGS = (-1, -3, -5, -7, -13)


@query("D35", with_views(TXN, CLEAN, "SELECT card_id, " + ", ".join(
    f"({money_mean(where=w)}) / ({money_mean(where='month_lag = 0')}) AS \"avg_purchase_ratio_{lag}\"" for lag, w in
    [(lag, f"{HIST} AND authorized_flag = 1 AND month_lag >= {lag}") for lag in MEAN_LAGS] + [(lag, f"{NEW} AND month_lag >= {lag}") for lag in (1, 2)])
    + " FROM tx GROUP BY card_id"))
def lag_means_to_current_month(spark, d):
    return ratios.mean_to_current(staged_clean(spark, d), "card_id", "purchase_amount", MEAN_LAGS, (1, 2),
                                  history() & (F.col("authorized_flag") == 1))


@query("D36 B5", with_views(TXN, "SELECT card_id, " + ", ".join(
    f"coalesce({money(where=f'{HIST} AND month_lag >= {lag}')}, 0) / {abs(lag)} AS \"per_time_purchase_amount_sum_{lag}\", "
    f"({counted('purchase_amount', f'{HIST} AND month_lag >= {lag}')}) / {abs(lag)} AS \"per_time_purchase_amount_count_{lag}\"" for lag in MEAN_LAGS)
    + " FROM txn GROUP BY card_id"))
def per_lag_rates(spark, d):
    table = multi_agg(views.transactions(spark, d), ["card_id"], [("purchase_amount", ["sum", "count"])],
                      slices=lag_slices(history(), MEAN_LAGS))
    rated = ratios.per_lag_rates(table, "", ["purchase_amount_sum", "purchase_amount_count"], MEAN_LAGS)
    return rated.select("card_id", *[c for c in rated.columns if c.startswith("per_time")])


SPAN_SQL = "date_diff('day', CAST(min(purchase_date) AS DATE), CAST(max(purchase_date) AS DATE))"


@query("D37 D49", with_views(TXN, CLEAN, "SELECT card_id, count(*) / nullif(CAST(" + SPAN_SQL + " AS DOUBLE), 0) AS per_time_rows, " + ", ".join(
    f"CAST(count(*) FILTER (WHERE category_2 = {v}) AS DOUBLE) AS category_2_{v}_sum, "
    f"count(*) FILTER (WHERE category_2 = {v}) / nullif(CAST({SPAN_SQL} AS DOUBLE), 0) AS per_time_category_2_{v}_sum" for v in (1, 2, 3, 4, 6))
    + f" FROM tx WHERE {HIST} GROUP BY card_id"))
def per_day_rates(spark, d):
    rows = clean.indicators(staged_clean(spark, d).where(history()), "category_2", [1, 2, 3, 4, 6])
    names = [f"category_2_{v}" for v in (1, 2, 3, 4, 6)]
    table = multi_agg(rows, ["card_id"], [("card_id", ["size"]), ("purchase_date", ["min", "max"]), *[(n, ["sum"]) for n in names]])
    return combine.per_day(table, "purchase_date", {"card_id_size": "per_time_rows", **{
        f"{n}_sum": f"per_time_{n}_sum" for n in names}}).drop("card_id_size", "purchase_date_min", "purchase_date_max")


@query("D49", with_views(TXN, CLEAN, "SELECT card_id, " + ", ".join(
    f"count(*) FILTER (WHERE {HIST} AND month_lag >= {lag} AND category_3 = {v})::DOUBLE AS \"category_3_{v}_sum_{lag}\""
    for lag in MEAN_LAGS for v in (0, 1, 2)) + " FROM tx GROUP BY card_id"))
def indicator_sums_per_slice(spark, d):
    rows = clean.indicators(staged_clean(spark, d), "category_3", [0, 1, 2])
    return multi_agg(rows, ["card_id"], [(f"category_3_{v}", ["sum"]) for v in (0, 1, 2)], slices=lag_slices(history(), MEAN_LAGS))


def day_diff(a, b):
    return f"date_diff('day', CAST({b} AS DATE), CAST({a} AS DATE))"


SPANS = f"""spans AS (SELECT card_id, min(purchase_date) FILTER (WHERE {HIST}) AS hf, max(purchase_date) FILTER (WHERE {HIST}) AS hl,
  min(purchase_date) FILTER (WHERE {NEW}) AS nf, max(purchase_date) FILTER (WHERE {NEW}) AS nl FROM txn GROUP BY 1)"""


@query("D38", with_views(CARDS, TXN, SPANS, f"""
SELECT card_id, {day_diff('hf', "DATE '2001-02-28'")} AS hist_first_to_base_time, {day_diff('hl', "DATE '2001-02-28'")} AS hist_last_to_base_time,
  {day_diff('hl', 'hf')} AS hist_last_to_first_time, {day_diff('hf', 'first_active_month')} AS hist_first_to_active_time,
  {day_diff('hl', 'first_active_month')} AS hist_last_to_active_time,
  {day_diff('nf', "DATE '2001-02-28'")} AS new_first_to_base_time, {day_diff('nl', "DATE '2001-02-28'")} AS new_last_to_base_time,
  {day_diff('nl', 'nf')} AS new_last_to_first_time, {day_diff('nf', 'first_active_month')} AS new_first_to_active_time,
  {day_diff('nl', 'first_active_month')} AS new_last_to_active_time, {day_diff('nf', 'hl')} AS new_to_hist_time
FROM cards LEFT JOIN spans USING (card_id)"""))
def first_and_last_purchase_gaps(spark, d):
    return combine.purchase_spans(views.cards(spark, d), views.transactions(spark, d), "2001-02-28")


SUMMARY = "summary AS (SELECT card_id, " + ", ".join(
    f"{money(where=w)} AS {p}_amount_sum, {money_mean(where=w)} AS {p}_amount_mean, max(purchase_amount) FILTER (WHERE {w}) AS {p}_amount_max, "
    f"min(purchase_amount) FILTER (WHERE {w}) AS {p}_amount_min, count(*) FILTER (WHERE {w}) AS {p}_n, "
    f"CAST(sum(installments) FILTER (WHERE {w}) AS DOUBLE) AS {p}_inst_sum, avg(installments) FILTER (WHERE {w}) AS {p}_inst_mean, "
    f"max(installments) FILTER (WHERE {w}) AS {p}_inst_max, avg(month_diff) FILTER (WHERE {w}) AS {p}_diff_mean, "
    f"avg(month_lag) FILTER (WHERE {w}) AS {p}_lag_mean, count(DISTINCT dd) FILTER (WHERE {w}) AS {p}_days, "
    f"min(purchase_date) FILTER (WHERE {w}) AS {p}_first, max(purchase_date) FILTER (WHERE {w}) AS {p}_last"
    for p, w in (("hist", HIST), ("new", NEW))) + " FROM bf GROUP BY card_id)"

SUMMARY_SPEC = [("purchase_amount", ["sum", "mean", "max", "min"]), ("installments", ["sum", "mean", "max"]),
                ("month_diff", ["mean"]), ("month_lag", ["mean", "max", "min"]), ("card_id", ["size", "count"]),
                ("category_1", ["mean"]), ("purchase_date", ["min", "max"]), ("day", ["nunique"])]


def summary(spark, d):
    """History and new-period statistics of every card, new ones missing where a card has no new rows."""
    return combine.period_table(tables.stage(base_features(spark, d), "base_features"), "card_id", SUMMARY_SPEC)


@query("D39", with_views(TXN, BASE_FEATURES, SUMMARY, f"""
SELECT card_id, {floor_days_sql('hist_last', 'hist_first')} AS hist_purchase_date_diff,
  {floor_days_sql('hist_last', 'hist_first')} / nullif(hist_n, 0) AS hist_purchase_date_average,
  {floor_days_sql(AS_OF_SQL, 'hist_last')} AS hist_purchase_date_uptonow, {floor_days_sql(AS_OF_SQL, 'hist_first')} AS hist_purchase_date_uptomin
FROM summary"""))
def span_recency_tenure(spark, d):
    table = combine.span_features(summary(spark, d), "hist_", AS_OF)
    return table.select("card_id", *[f"hist_purchase_date_{s}" for s in ("diff", "average", "uptonow", "uptomin")])


@query("D40", with_views(CARDS, TXN, BASE_FEATURES, SUMMARY, "SELECT card_id, " + ", ".join(
    f"{floor_days_sql(f'{p}_{e}', 'first_active_month::TIMESTAMP')} AS {p}_{e}_buy" for p in ("hist", "new") for e in ("first", "last"))
    + " FROM cards LEFT JOIN summary USING (card_id)"))
def buys_against_active_month(spark, d):
    table = combine.active_month_gaps(aggregate.attach(views.cards(spark, d), summary(spark, d), ["card_id"]))
    return table.select("card_id", "hist_first_buy", "hist_last_buy", "new_first_buy", "new_last_buy")


@query("D41", with_views(TXN, BASE_FEATURES, SUMMARY, """
SELECT card_id, CASE WHEN new_n > 0 AND hist_n > 0 THEN new_n + hist_n END AS card_id_total,
  CASE WHEN new_n > 0 AND hist_n > 0 THEN new_n / CAST(hist_n AS DOUBLE) END AS card_id_cnt_ratio,
  new_amount_sum + hist_amount_sum AS purchase_amount_total, new_amount_mean + hist_amount_mean AS purchase_amount_mean,
  new_amount_max + hist_amount_max AS purchase_amount_max, new_amount_min + hist_amount_min AS purchase_amount_min,
  new_amount_sum / nullif(hist_amount_sum, 0) AS purchase_amount_ratio, new_diff_mean + hist_diff_mean AS month_diff_mean,
  new_diff_mean / nullif(hist_diff_mean, 0) AS month_diff_ratio, new_lag_mean + hist_lag_mean AS month_lag_mean,
  CASE WHEN new_n > 0 AND hist_n > 0 THEN coalesce(new_inst_sum, 0) + coalesce(hist_inst_sum, 0) END AS installments_total,
  new_inst_mean + hist_inst_mean AS installments_mean, new_inst_max + hist_inst_max AS installments_max,
  CASE WHEN new_n > 0 AND hist_n > 0 THEN coalesce(new_inst_sum, 0) / nullif(hist_inst_sum, 0) END AS installments_ratio,
  (new_amount_mean + hist_amount_mean) / nullif(new_inst_mean + hist_inst_mean, 0) AS price_mean,
  (new_amount_max + hist_amount_max) / nullif(new_inst_max + hist_inst_max, 0) AS price_max FROM summary"""))
def combined_totals_and_ratios(spark, d):
    table = combine.totals(summary(spark, d))
    names = ["card_id_total", "card_id_cnt_ratio", "purchase_amount_total", "purchase_amount_mean", "purchase_amount_max",
             "purchase_amount_min", "purchase_amount_ratio", "month_diff_mean", "month_diff_ratio", "month_lag_mean",
             "installments_total", "installments_mean", "installments_max", "installments_ratio", "price_mean", "price_max"]
    return table.select("card_id", *names)


@query("D42", with_views(TXN, BASE_FEATURES, SUMMARY, """v AS (SELECT card_id,
  CASE WHEN new_n > 0 THEN new_n END * new_amount_sum / nullif(new_diff_mean, 0) AS "new_CLV",
  CASE WHEN hist_n > 0 THEN hist_n END * hist_amount_sum / nullif(hist_diff_mean, 0) AS "hist_CLV" FROM summary)
SELECT *, "new_CLV" / nullif("hist_CLV", 0) AS "CLV_ratio" FROM v"""))
def lifetime_value(spark, d):
    return combine.lifetime_value(summary(spark, d)).select("card_id", "new_CLV", "hist_CLV", "CLV_ratio")


PAIRED = ["purchase_amount_sum", "purchase_amount_max", "month_lag_mean"]
PAIRED_SQL = {"purchase_amount_sum": "amount_sum", "purchase_amount_max": "amount_max", "month_lag_mean": "lag_mean"}


@query("D43", with_views(TXN, BASE_FEATURES, SUMMARY, "SELECT card_id, " + ", ".join(
    f"new_{s} + hist_{s} AS new_{c}_add_hist_{c}, new_{s} - hist_{s} AS new_{c}_sub_hist_{c}, "
    f"new_{s} / (abs(hist_{s}) + 0.01) AS new_{c}_div_hist_{c}" for c, s in PAIRED_SQL.items()) + " FROM summary"))
def pairwise_combinations(spark, d):
    table = combine.pair_columns(summary(spark, d), PAIRED)
    return table.select("card_id", *[c for c in table.columns if "_hist_" in c and c.startswith("new_")])


@query("D44", with_views(CARDS, TXN, BASE_FEATURES, SUMMARY, f"""
SELECT card_id, e - h AS hist_sleep_day, e - n AS new_sleep_day, (e - h) + (e - n) AS total_sleep_day, (e - h) - (e - n) AS diff_sleep_day
FROM (SELECT card_id, {floor_days_sql(AS_OF_SQL, 'first_active_month::TIMESTAMP')} AS e,
  CASE WHEN hist_n > 0 THEN hist_days END AS h, CASE WHEN new_n > 0 THEN new_days END AS n FROM cards LEFT JOIN summary USING (card_id))"""))
def inactivity_days(spark, d):
    cards = views.cards(spark, d).withColumn("elapsed_time", dates.tenure(F.col("first_active_month"), AS_OF))
    table = combine.inactivity(aggregate.attach(cards, summary(spark, d), ["card_id"]))
    return table.select("card_id", "hist_sleep_day", "new_sleep_day", "total_sleep_day", "diff_sleep_day")


@query("D45", with_views(TXN, BASE_FEATURES, SUMMARY, """
SELECT card_id, new_amount_sum + hist_amount_sum AS purchase_amount_total, new_amount_sum - hist_amount_sum AS purchase_amount_diff,
  (new_amount_sum - hist_amount_sum) / nullif(hist_amount_sum, 0) AS purchase_amount_rate FROM summary"""))
def spend_total_difference_rate(spark, d):
    table = combine.spend_change(summary(spark, d))
    return table.select("card_id", "purchase_amount_total", "purchase_amount_diff", "purchase_amount_rate")


@query("D47", with_views(CARDS, "SELECT outlier AS label, count(*) AS n FROM cards GROUP BY 1"))
def class_counts(spark, d):
    return metrics.class_counts(views.cards(spark, d), "outlier")


@query("D48", with_views(TXN, """
SELECT o_orderkey, l_linenumber, count(purchase_amount) OVER (PARTITION BY card_id, merchant_id) AS card_merchant_counts_totals,
  count(purchase_amount) OVER (PARTITION BY card_id) AS card_visit_counts FROM txn"""))
def visit_counts_on_rows(spark, d):
    rows = aggregate.visit_counts(views.transactions(spark, d))
    return rows.select("o_orderkey", "l_linenumber", "card_merchant_counts_totals", "card_visit_counts")


# The thirteen columns whose label codes are described.
CODES = ["city_C1", "C2_state", "C2_state_subsector", "subsector_city", "auth_C3", "merchant_id", "merchant_category_id", "subsector_id",
         "city_id", "state_id", "category_2", "category_3", "installments"]
PERIODS = {"_hist": HIST, "_new": NEW}


def code_statistics_sql(c: str, p: str, where: str) -> str:
    f = f"FILTER (WHERE {where})"
    return (f'{digits_sql(f"""avg("{c}") {f}""")} AS "{c}_mean{p}", max("{c}") {f} AS "{c}_max{p}", median("{c}") {f} AS "{c}_median{p}", '
            f'CAST(coalesce(sum("{c}") {f}, 0) AS DOUBLE) AS "{c}_sum{p}", {digits_sql(f"""stddev_samp("{c}") {f}""")} AS "{c}_std{p}", '
            f'count("{c}") {f} AS "{c}_count{p}"')


@query("D50", with_views(TXN, INTERACTIONS_SQL.replace("SELECT o_orderkey, l_linenumber", "SELECT *"), "coded AS (SELECT card_id, month_lag, " + ", ".join(
    f"""dense_rank() OVER (ORDER BY coalesce(CAST("{c}" AS VARCHAR), 'nan')) - 1 AS "{c}\"""" for c in CODES) + " FROM keyed)",
    "SELECT card_id, " + ", ".join(code_statistics_sql(c, p, w) for c in CODES for p, w in PERIODS.items()) + " FROM coded GROUP BY card_id"))
def encoded_category_statistics(spark, d):
    txn = views.transactions(spark, d)
    rows = tables.stage(txn.select("card_id", "month_lag", *[c.alias(n) for n, c in clean.interaction_keys().items()],
                                   *[c for c in CODES if c in txn.columns]), "codes")
    table = multi_agg(encode.label_encode(rows, CODES), ["card_id"],
                      [(c, ["mean", "max", "median", "sum", "std", "count"]) for c in CODES], slices={"_hist": history(), "_new": recent()})
    return table.select("card_id", *[digits(F.col(f"`{c}`")).alias(c) if "_mean_" in c or "_std_" in c else F.col(f"`{c}`")
                                     for c in table.columns if c != "card_id"])


SEASON = {"month": "month(purchase_date)", "hour": "hour(purchase_date)", "weekofyear": "weekofyear(purchase_date)",
          "weekday": "isodow(purchase_date) - 1", "day": "day(purchase_date)"}


@query("D51", with_views(EVENTS, "SELECT card_id, " + ", ".join(
    f"count(DISTINCT {e}) AS {c}_nunique, avg({e}) AS {c}_mean, min({e}) AS {c}_min, max({e}) AS {c}_max" for c, e in SEASON.items())
    + ", CAST(sum(CAST(isodow(purchase_date) >= 6 AS INTEGER)) AS DOUBLE) AS weekend_sum FROM ev GROUP BY card_id"))
def date_part_statistics(spark, d):
    rows = dates.date_parts(views.events(spark, d), "purchase_date", [*SEASON, "weekend"])
    spec = [(c, ["nunique", "mean", "min", "max"]) for c in SEASON] + [("weekend", ["sum"])]
    return multi_agg(rows, ["card_id"], spec)
