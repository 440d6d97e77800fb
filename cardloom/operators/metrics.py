"""Evaluation metrics as aggregates; curves group equal scores first and run along a distributed sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cardloom.functions.clean import ratio
from cardloom.operators.ordering import running_totals

CLIP = 1e-15


def rmse(df: DataFrame, y: str, p: str, by: str | None = None) -> DataFrame:
    error = F.col(y) - F.col(p)
    return (df.groupBy(by) if by else df.groupBy()).agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def absolute_errors(df: DataFrame, y: str, p: str) -> DataFrame:
    """Mean absolute error, and mean absolute percentage error over rows with a non-zero truth."""
    error = F.abs(F.col(y) - F.col(p))
    return df.agg(F.avg(error).alias("mae"), F.avg(ratio(error, F.abs(F.col(y)))).alias("mape"))


def log_loss_term(y: Column, p: Column) -> Column:
    clipped = F.greatest(F.least(p, F.lit(1 - CLIP)), F.lit(CLIP))
    return -F.when(y == 1, F.ln(clipped)).otherwise(F.ln(1 - clipped))


def log_loss(df: DataFrame, y: str, p: str, by: str | None = None) -> DataFrame:
    return (df.groupBy(by) if by else df.groupBy()).agg(F.avg(log_loss_term(F.col(y), F.col(p))).alias("log_loss"))


def score_counts(df: DataFrame, y: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score."""
    return df.groupBy(F.col(score).alias("score")).agg(
        F.sum(F.col(y).cast("bigint")).alias("pos"), F.sum(1 - F.col(y).cast("bigint")).alias("neg"))


def roc_auc(df: DataFrame, y: str, score: str) -> DataFrame:
    """Area under the curve: positives above negatives, equal scores counting half."""
    ranked = running_totals(score_counts(df, y, score), ["score"], {"below": "neg"})
    wins = F.sum(F.col("pos") * (F.col("below") - F.col("neg") / 2))
    return ranked.agg(ratio(wins, F.sum("pos") * F.sum("neg")).alias("auc"))


def best_f1(df: DataFrame, y: str, score: str) -> DataFrame:
    """Threshold with the highest F1 when scores at or above it count as positive; the lowest such threshold."""
    ranked = running_totals(score_counts(df, y, score).withColumn("rows", F.col("pos") + F.col("neg")),
                            [F.desc("score")], {"tp": "pos", "called": "rows"})
    positives = ranked.agg(F.sum("pos")).scalar()
    f1 = ratio(2 * F.col("tp"), F.col("called") + positives)
    best = F.max(F.struct(f1.alias("f1"), (-F.col("score")).alias("neg_score")))
    return ranked.agg(best.alias("b")).select((-F.col("b.neg_score")).alias("threshold"), F.col("b.f1").alias("f1"))


def confusion(df: DataFrame, y: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(y).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, y: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, from the confusion counts."""
    counts = confusion(df, y, predicted)
    sides = F.array(F.struct(F.col("actual").alias("c"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("called")),
                    F.struct(F.col("predicted").alias("c"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("called")))
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    long = counts.select(hit.alias("hit"), F.explode(sides).alias("s")).select("hit", "s.*")
    table = long.groupBy(F.col("c").alias("class")).agg(
        (F.sum("hit") / 2).alias("hit"), F.sum("support").alias("support"), F.sum("called").alias("called"))
    return table.select("class",
                        F.coalesce(ratio(F.col("hit"), F.col("called")), F.lit(0.0)).alias("precision"),
                        F.coalesce(ratio(F.col("hit"), F.col("support")), F.lit(0.0)).alias("recall"),
                        F.coalesce(ratio(2 * F.col("hit"), F.col("called") + F.col("support")), F.lit(0.0)).alias("f1"),
                        "support")


def class_counts(df: DataFrame, y: str) -> DataFrame:
    """Rows per label value."""
    return df.groupBy(F.col(y).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def fold_mean(df: DataFrame, metric: str) -> DataFrame:
    """Mean of a per-fold metric."""
    return df.agg(F.avg(metric).alias(f"mean_{metric}"), F.count(metric).alias("folds"))
