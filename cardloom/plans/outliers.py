"""Outlier chain: aggregate features, rate encoding, boosted classifiers, token models, stacking, thresholds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from cardloom.functions import clean, dates
from cardloom.operators import combine, encode, folds, metrics, models, text
from cardloom.operators.aggregate import EXACT_SCALE, attach
from cardloom.operators.ratios import history, recent
from cardloom.operators.select import numeric_columns
from cardloom.plans.features import Setting, stored, with_buckets
from cardloom.sources.tables import stage

# Items of the rates, columns of means, counts and texts, and numbers of chosen tokens.
RATE_ITEMS = ["feature_1", "feature_2", "feature_3", "new_month_diff_mean", "hist_month_diff_mean", "hist_month_diff_max", "hist_month_diff_min"]
MEAN_COLUMNS = ["month", "hour", "weekofyear", "weekday", "year", "subsector_id", "merchant_id", "merchant_category_id",
                "category_1", "category_2", "category_3", "month_lag"]
# Of these, columns that have few combinations: the parts of a date, and the short codes.
MEAN_CELLS = [["month", "hour", "weekofyear", "weekday", "year", "month_lag"], ["subsector_id", "category_1", "category_2", "category_3"]]
COUNT_COLUMNS = ["month", "day", "hour", "weekofyear", "weekday", "year", "subsector_id", "merchant_id", "merchant_category_id"]
TEXT_COLUMNS = ["authorized_flag", "category_1", "installments", "category_3", "merchant_category_id", "merchant_id",
                "category_2", "state_id", "subsector_id"]
TOKEN_BUDGETS = (500, 500, 800)


def outlier_rows(txn: DataFrame, setting: Setting) -> DataFrame:
    rows = dates.date_parts(txn, "purchase_date", ["year", "month", "day", "hour", "weekofyear", "weekday", "weekend"])
    return rows.withColumns({
        "authorized_flag": clean.code_map(F.col("authorized_flag"), clean.FLAG_CODES),
        "category_1": clean.code_map(F.col("category_1"), clean.FLAG_CODES),
        "month_diff": dates.month_age(F.col("purchase_date"), setting.as_of, F.col("month_lag")),
    })


def with_group_means(rows: DataFrame, columns: Sequence[str], value: str = "purchase_amount") -> DataFrame:
    """Mean amount of each column's own value within the row's period, on each row.

    ``rows`` must be a stored table: every mean is taken from it, not from the growing join. Columns of ``MEAN_CELLS`` are summed
    by their combinations in one pass, exactly, and each mean is taken from these few sums. The means are stored
    together, so each join knows their measured size and few-valued columns do not shuffle the rows. Batches of
    statistics that do not use the means drop the joins.
    """
    wide = rows.withColumn("_period", history())
    groups = [g for g in ([c for c in columns if c in cells] for cells in MEAN_CELLS) if g]
    groups += [[c] for c in columns if not any(c in g for g in groups)]
    exact = F.col(value).cast(f"decimal(18,{EXACT_SCALE[value]})")
    means = []
    for group in groups:
        cells = stage(wide.where(F.col("_period").isNotNull()).groupBy("_period", *group).agg(
            F.sum(exact).alias("_s"), F.count(value).alias("_n")), "mean_cells")
        means += [cells.where(F.col(c).isNotNull()).groupBy("_period", F.lit(c).alias("_column"), F.col(c).alias("_value")).agg(
            F.try_divide(F.sum("_s").cast("double"), F.sum("_n")).alias("_mean")).withColumn("_value", F.col("_value").cast("string"))
            for c in group]
    means = stage(reduce(DataFrame.unionAll, means), "group_means")
    for c in columns:
        own = means.where(F.col("_column") == c).select("_period", "_value", F.col("_mean").alias(f"{c}_amount_mean"))
        wide = wide.withColumn("_value", F.col(c).cast("string")).join(own, ["_period", "_value"], "left").drop("_value")
    return wide.drop("_period")


def outlier_features(cards: DataFrame, txn: DataFrame, setting: Setting) -> DataFrame:
    """Per-card aggregates of both periods, date gaps, inactivity, spend change and all pairwise combinations.

    Rows are stored with the columns that are used, in buckets by card where no card is hot, so that no aggregation by card shuffles
    them. Parts of dates are made as they are read.
    """
    spec = [(f"{c}_amount_mean", ["mean"]) for c in MEAN_COLUMNS] + [(c, ["nunique"]) for c in COUNT_COLUMNS] + [
        ("purchase_amount", ["sum", "max", "min", "mean", "var"]), ("installments", ["sum", "max", "min", "mean", "var"]),
        ("purchase_date", ["max", "min"]), ("month_lag", ["max", "min", "mean", "var"]),
        ("month_diff", ["max", "min", "mean", "var"]), ("authorized_flag", ["sum", "mean"]), ("weekend", ["sum", "mean"]),
        ("category_1", ["sum", "mean"]), ("card_id", ["size"])]
    setting = with_buckets(txn, setting)
    needed = dict.fromkeys(["card_id", "month_lag", *MEAN_COLUMNS, "purchase_amount", *[c for c, _ in spec if not c.endswith("_amount_mean")]])
    kept = txn.select(*[c for c in txn.columns if c in needed])
    rows = with_group_means(outlier_rows(stored(kept, "outlier_rows", setting), setting), MEAN_COLUMNS)
    table = combine.period_table(rows, "card_id", spec, hot_rows=setting.hot_rows, dealt=bool(setting.buckets))
    for prefix in ("hist_", "new_"):
        table = combine.span_features(table, prefix, setting.as_of)
        # The mean of a card's own mean over its rows is that mean again: no join by card is needed.
        table = table.withColumn(f"{prefix}card_id_amount_mean_mean", F.col(f"{prefix}purchase_amount_mean"))
    cards = stored(cards, "cards", setting) if setting.buckets else cards
    table = attach(cards.withColumn("elapsed_time", dates.tenure(F.col("first_active_month"), setting.as_of)), table, ["card_id"])
    table = combine.spend_change(combine.inactivity(combine.active_month_gaps(table)))
    return combine.pair_columns(stage(table, "outlier_features"))


def rate_encoded(table: DataFrame, k: int = 5, seed: int = 4590) -> DataFrame:
    """Out-of-fold rates for training cards, full training rates for test cards, which have no fold.

    ``table`` is read several times, so it should be stored; only the folds are stored here.
    """
    train = folds.stratified_kfold(table.where("is_test = 0").select("card_id", "outlier"), "card_id", "outlier", k, seed)
    table = table.join(stage(train.select("card_id", "fold"), "folds"), "card_id", "left")
    return encode.attach_rates(table, table.where("is_test = 0"), RATE_ITEMS, "outlier", "card_id", fold="fold")


@dataclass
class OutlierResult:
    stacked: models.KFoldResult
    threshold: DataFrame
    auc: DataFrame
    regression: models.KFoldResult


def outlier_chain(cards: DataFrame, txn: DataFrame, setting: Setting, k: int = 5,
                  budgets: tuple[int, ...] = TOKEN_BUDGETS, **params) -> OutlierResult:
    """Classifier on dense features, one per token budget, a stacked model over them, and the final regression."""
    table = stage(rate_encoded(outlier_features(cards, txn, setting), k), "rates")
    train, test = table.where("is_test = 0"), table.where("is_test = 1")
    features = numeric_columns(table, ("card_id", "target", "outlier", "is_test", "fold"))
    first = [models.kfold_boosting(train, features, "outlier", "fold", k, "classification", test, **params)]
    for period, budget in zip((history(), recent(), F.lit(True)), budgets):
        counts = stage(text.sequence_token_counts(txn.where(period), "card_id", TEXT_COLUMNS), "tokens")
        chosen = text.select_top(text.chi_square(counts, train, "card_id", "outlier"), budget)
        vectors = stage(models.token_vectors(counts, chosen, "card_id", "tokens"), "token_vectors")
        size = chosen.count()
        first.append(models.kfold_boosting(
            models.with_vectors(train, vectors, "card_id", "tokens", size), features, "outlier", "fold", k, "classification",
            models.with_vectors(test, vectors, "card_id", "tokens", size), vectors=["tokens"], **params))
    names = [f"score_{i}" for i in range(len(first))]
    level = folds.stratified_kfold(models.stack([r.oof for r in first], label="outlier"), "card_id", "outlier", k, 2018)
    stacked = models.kfold_boosting(level, names, "outlier", "fold", k, "classification",
                                    models.stack([r.test for r in first]), **params)
    held_out = stage(stacked.oof, "stacked")
    regression = models.kfold_boosting(train.where("outlier = 0"), features, "target", "fold", k, "regression", test, **params)
    return OutlierResult(stacked, metrics.best_f1(held_out, "outlier", "prediction"),
                         metrics.roc_auc(held_out, "outlier", "prediction"), regression)
