"""Prepared inputs that several queries share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardloom.catalog.base import NUDGE
from cardloom.functions.clean import clean_transactions
from cardloom.sources import views

AMOUNT_CAP = 80000.0


def staged_clean(spark: SparkSession, d: str) -> DataFrame:
    """Transactions cleaned as the staged scripts do."""
    return clean_transactions(views.transactions(spark, d), 6.0, "B", -1, {-1: 1, 999: 0})


def base_clean(spark: SparkSession, d: str) -> DataFrame:
    """Transactions cleaned as the baseline does: sentinels go missing, amounts are capped."""
    return clean_transactions(views.transactions(spark, d), 1.0, "A", -1, {-1: None, 999: None}, AMOUNT_CAP)


def digits(column: Column) -> Column:
    """Eight significant digits: sums of doubles differ in the last bits with the order of the rows."""
    return F.when(column.isNotNull(), F.format_string("%.7e", column * F.lit(float(NUDGE))).cast("double"))
