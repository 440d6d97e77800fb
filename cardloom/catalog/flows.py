"""Whole feature chains, from transactions to one row per card."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cardloom.catalog.base import CARDS, CLEAN_BASE, HIST, NEW, TXN, digits_sql, floor_days_sql, money, money_mean, query, with_views
from cardloom.catalog.aggregates import RATE_CARDS, rounded_rates
from cardloom.catalog.common import AMOUNT_CAP, digits
from cardloom.catalog.rows import FIXTURE_EVENTS, event_sql, holiday_calendar
from cardloom.operators import encode
from cardloom.plans import features, outliers
from cardloom.sources import tables, views

AS_OF, BASE_DATE = "2001-09-01", "2001-02-28"
AS_OF_SQL = f"'{AS_OF}'::TIMESTAMP"
SETTING = features.Setting(AS_OF, BASE_DATE, views.TXN_ORDER, FIXTURE_EVENTS, AMOUNT_CAP, -1)


def comparable(df: DataFrame) -> DataFrame:
    """Doubles to eight digits; skewness, which may cancel to nearly nothing, to six decimals."""
    def shown(name: str) -> Column:
        return F.round(name, 6) + 0.0 if name.endswith("_skew") else digits(F.col(name))
    return df.withColumns({f.name: shown(f.name) for f in df.schema if f.dataType.typeName() == "double" and f.name != "target"})


# --- the SQL of the baseline table ------------------------------------------------------------------------------

INTEGERS = {"subsector_id", "merchant_id", "merchant_category_id", "month", "hour", "weekofyear", "weekday", "day", "weekend",
            "installments", "month_lag", "month_diff", "card_id", *FIXTURE_EVENTS}


def statistic_sql(column: str, stat: str, where: str) -> str:
    f = f"FILTER (WHERE {where})"
    if stat in {"min", "max"}:
        made = f"{stat}({column}) {f}"
        return made if column in INTEGERS or column == "purchase_date" else digits_sql(made)
    if column == "purchase_amount" and stat in {"sum", "mean"}:
        return digits_sql(money(column, where) if stat == "sum" else money_mean(column, where))
    return {
        "size": f"nullif(count(*) {f}, 0)", "count": f"nullif(count({column}) {f}, 0)",
        "nunique": f"CASE WHEN count(*) {f} > 0 THEN count(DISTINCT {column}) {f} END",
        "sum": digits_sql(f"CASE WHEN count(*) {f} > 0 THEN coalesce(sum({column}) {f}, 0) END"),
        "mean": digits_sql(f"avg({column}) {f}"), "var": digits_sql(f"var_samp({column}) {f}"),
        "skew": f"round(CASE WHEN count({column}) {f} < 3 THEN NULL WHEN min({column}) {f} = max({column}) {f} THEN 0 "
                f"ELSE skewness({column}) {f} END, 6) + 0.0",
    }[stat]


ROWS_SQL = "br AS (SELECT *, " + ", ".join(f"{event_sql(day)} AS {name}" for name, day in FIXTURE_EVENTS.items()) + f""",
  month(purchase_date) AS month, day(purchase_date) AS day, hour(purchase_date) AS hour, weekofyear(purchase_date) AS weekofyear,
  isodow(purchase_date) - 1 AS weekday, CAST(isodow(purchase_date) >= 6 AS INTEGER) AS weekend,
  purchase_amount / nullif(installments, 0) AS price, purchase_amount * age AS duration, purchase_amount / nullif(age, 0) AS amount_month_ratio,
  age AS month_diff, avg(purchase_amount) OVER (PARTITION BY {HIST}, category_2) AS category_2_mean,
  avg(purchase_amount) OVER (PARTITION BY {HIST}, category_3) AS category_3_mean
FROM (SELECT *, CAST(floor({floor_days_sql(AS_OF_SQL, 'purchase_date')} / 30.0) AS INTEGER) + month_lag AS age FROM tx))"""

SPEC = features.BASELINE_SPEC + [(e, ["mean"]) for e in FIXTURE_EVENTS]
PERIOD_SQL = "period AS (SELECT card_id, " + ", ".join(
    f'{statistic_sql(c, s, w)} AS "{p}_{c}_{s}"' for p, w in (("hist", HIST), ("new", NEW)) for c, stats in SPEC for s in stats
) + " FROM br GROUP BY card_id)"

CODES = ["feature_1", "feature_2", "feature_3"]
CARD_SQL = f"""elapsed AS (SELECT *, {floor_days_sql(AS_OF_SQL, 'first_active_month::TIMESTAMP')} AS elapsed_time FROM cards),
card_part AS (SELECT card_id, target, outlier, is_test, first_active_month, quarter(first_active_month) AS quarter, elapsed_time, """ + ", ".join(
    f"elapsed_time * {c} AS days_feature{i}, {digits_sql(f'{c} / nullif(elapsed_time, 0)')} AS days_feature{i}_ratio, "
    f"avg(outlier) OVER (PARTITION BY {c}) AS r{i}" for i, c in enumerate(CODES, 1)) + """ FROM elapsed),
card_columns AS (SELECT * EXCLUDE (r1, r2, r3), """ + ", ".join([
    *[f"{digits_sql(f'r{i}')} AS {c}" for i, c in enumerate(CODES, 1)],
    f"{digits_sql('r1 + r2 + r3')} AS feature_sum", f"{digits_sql('(r1 + r2 + r3) / 3')} AS feature_mean",
    f"{digits_sql('greatest(r1, r2, r3)')} AS feature_max", f"{digits_sql('least(r1, r2, r3)')} AS feature_min",
    f"{digits_sql('(SELECT stddev_samp(r) FROM unnest([r1, r2, r3]) AS u(r))')} AS feature_var"]) + " FROM card_part)"


@query("A7 B25 C3 D12 D14 D39 D51", with_views(TXN, CLEAN_BASE, ROWS_SQL, PERIOD_SQL, CARDS, CARD_SQL, "SELECT * EXCLUDE (" + ", ".join(
    f"{p}_purchase_date_{e}" for p in ("hist", "new") for e in ("min", "max")) + "), " + ", ".join(
    f"{floor_days_sql(f'{p}_purchase_date_max', f'{p}_purchase_date_min')} AS {p}_purchase_date_diff, "
    f"{floor_days_sql(AS_OF_SQL, f'{p}_purchase_date_max')} AS {p}_purchase_date_uptonow, "
    f"{floor_days_sql(f'{p}_purchase_date_min', 'first_active_month::TIMESTAMP')} AS {p}_first_buy, "
    f"{floor_days_sql(f'{p}_purchase_date_max', 'first_active_month::TIMESTAMP')} AS {p}_last_buy, "
    + digits_sql(f"epoch_us({p}_purchase_date_min) / 1000000.0") + f" AS {p}_purchase_date_min, "
    + digits_sql(f"epoch_us({p}_purchase_date_max) / 1000000.0") + f" AS {p}_purchase_date_max"
    for p in ("hist", "new")) + " FROM card_columns FULL JOIN period USING (card_id)"))
def card_feature_table(spark, d):
    """The baseline table; combined totals, checked by their own queries, are left out of this comparison."""
    table = features.baseline_features(views.cards(spark, d), views.transactions(spark, d), SETTING)
    stats = [f"{p}_{c}_{s}" for p in ("hist", "new") for c, names in SPEC for s in names]
    spans = [f"{p}_{s}" for p in ("hist", "new") for s in ("purchase_date_diff", "purchase_date_uptonow", "first_buy", "last_buy")]
    card = ["card_id", "target", "outlier", "is_test", "first_active_month", "quarter", "elapsed_time", *CODES,
            *[f"days_feature{i}{s}" for i in (1, 2, 3) for s in ("", "_ratio")],
            *[f"feature_{s}" for s in ("sum", "mean", "max", "min", "var")]]
    return comparable(table.select(*card, *stats, *spans))


@query("D41 D42")
def baseline_table_with_totals(spark, d):
    return features.baseline_features(views.cards(spark, d), views.transactions(spark, d), SETTING)


@query("A7 C1 C9 D20 D35 E1 E6 E8")
def staged_card_features(spark, d):
    return features.staged_features(views.cards(spark, d), views.transactions(spark, d), views.merchants(spark, d),
                                    holiday_calendar(spark, d), SETTING)


@query("B10 B25 D12 D48 H9")
def large_card_features(spark, d):
    return features.large_features(views.transactions(spark, d, stepwise=True), SETTING)


@query("D14 D39 D43 D44 D45")
def outlier_feature_table(spark, d):
    return outliers.outlier_features(views.cards(spark, d), views.transactions(spark, d), SETTING)


RATE_SETS = encode.key_sets(outliers.RATE_ITEMS)
STRATIFIED = """folded AS (SELECT *, CASE WHEN is_test = 0 THEN CAST((row_number() OVER (PARTITION BY is_test, outlier
  ORDER BY ('0x' || substr(md5(card_id || ':4590'), 1, 8))::BIGINT, card_id) - 1) % 5 AS INTEGER) ELSE -1 END AS part FROM rated)"""


def learned_sql(keys):
    """Rates of training cards for each (key, fold) from other folds, and under part -1 from all of them."""
    k, name = ", ".join(keys), encode.rate_name(keys)
    return (f"(SELECT {k}, part, CASE WHEN sum(n) OVER w > n THEN round((sum(c) OVER w - c + 0.01) * 1000 / (sum(n) OVER w - n + 0.01), 6) END AS {name} "
            f"FROM (SELECT {k}, part, sum(outlier) AS c, count(outlier) AS n FROM folded WHERE part >= 0 GROUP BY {k}, part) WINDOW w AS (PARTITION BY {k}) "
            f"UNION ALL SELECT {k}, -1, round((sum(outlier) + 0.01) * 1000 / (count(outlier) + 0.01), 6) FROM folded WHERE part >= 0 GROUP BY {k}) USING ({k}, part)")


@query("D27 D28 D29 I17", with_views(TXN, CARDS, RATE_CARDS, STRATIFIED, "SELECT card_id, is_test, nullif(part, -1) AS fold, " + ", ".join(
    encode.rate_name(k) for k in RATE_SETS) + " FROM folded " + " ".join(f"LEFT JOIN {learned_sql(k)}" for k in RATE_SETS)))
def outlier_rate_table(spark, d):
    table = tables.stage(outliers.outlier_features(views.cards(spark, d), views.transactions(spark, d), SETTING), "outliers")
    return rounded_rates(outliers.rate_encoded(table, 5), RATE_SETS, "card_id", "is_test", "fold")
