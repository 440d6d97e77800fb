"""Differences to the previous purchase and outlier limits per group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from cardloom.functions.clean import ratio
from cardloom.functions.dates import day_seconds, floor_days
from cardloom.operators.aggregate import fill_with_mean, multi_agg
from cardloom.operators.ordering import NEVER_HOT, hot_keys, previous_in_group, running_totals
from cardloom.sources.tables import stage

Group = Sequence[str]
GAP_COLUMNS = ("purchase_time_diff_days", "purchase_time_diff_seconds")


def lag_ratio(df: DataFrame, group: Group, order: Sequence[str], value: str, name: str, **options) -> DataFrame:
    """Previous value (0 for the first row) over the current value."""
    rows = previous_in_group(df, group, order, {"_p": value}, **options)
    return rows.withColumn(name, ratio(F.coalesce("_p", F.lit(0.0)), F.col(value))).drop("_p")


def difference(df: DataFrame, group: Group, order: Sequence[str], value: str, name: str,
               first: float | None = 0.0, **options) -> DataFrame:
    """Current minus previous value; ``first`` stands in where there is no previous row."""
    rows = previous_in_group(df, group, order, {"_p": value}, **options)
    change = F.col(value) - F.col("_p")
    return rows.withColumn(name, change if first is None else F.coalesce(change, F.lit(first))).drop("_p")


def change_summary(df: DataFrame, key: str, groups: Mapping[str, Group], order: Sequence[str], value: str,
                   ratio_stats: Sequence[str] = ("max",), diff_stats: Sequence[str] = ("max", "median"),
                   hot_rows: int | None = None, dealt: bool = False) -> DataFrame:
    """Lag ratios and differences for several groupings, then one row of statistics per key.

    Every grouping must contain the key. Where no key is hot, rows are dealt out by key once: all windows and the
    statistics then find their rows in the same partition already and only sort. Give a stored table; ``dealt`` says that it
    lies by key already.
    """
    cold = dealt or hot_keys(df, [key], hot_rows) is None
    if cold:
        hot_rows = NEVER_HOT  # nor is any group inside a key
        needed = dict.fromkeys([key, *(c for group in groups.values() for c in group), *order, value])
        df = df.where(F.col(key).isNotNull()).select(*needed)
        df = df if dealt else df.repartition(F.col(key))
    spec = []
    for label, group in groups.items():
        df = previous_in_group(df, group, order, {"_p": value}, hot_rows)
        df = df.withColumns({
            f"{label}_shift_ratio": ratio(F.coalesce("_p", F.lit(0.0)), F.col(value)),
            f"{label}_diff": F.coalesce(F.col(value) - F.col("_p"), F.lit(0.0)),
        }).drop("_p")
        spec += [(f"{label}_shift_ratio", list(ratio_stats)), (f"{label}_diff", list(diff_stats))]
    return multi_agg(df, [key], spec, hot_rows=hot_rows, dealt=cold)


def purchase_gaps(df: DataFrame, group: Group, order: Sequence[str], ts: str, fill_mean: bool = True,
                  **options) -> DataFrame:
    """Floored days and leftover seconds since the previous purchase.

    First purchases take the mean of all other gaps when ``fill_mean`` is set.
    """
    rows = previous_in_group(df, group, order, {"_p": ts}, **options)
    rows = rows.withColumns({
        "purchase_time_diff_days": floor_days(F.col(ts), F.col("_p")),
        "purchase_time_diff_seconds": day_seconds(F.col(ts), F.col("_p")),
    }).drop("_p")
    return fill_with_mean(rows, *GAP_COLUMNS) if fill_mean else rows


def cumulative_share(df: DataFrame, value: str, name_column: str) -> DataFrame:
    """Share of the total and running share, largest first, ties by name."""
    totals = running_totals(df, [F.desc(value), name_column], {"_run": value})
    whole = df.agg(F.sum(value)).scalar()
    return (totals.withColumn(f"normalized_{value}", ratio(F.col(value), whole))
            .withColumn(f"cumulative_{value}", ratio(F.col("_run"), whole)).drop("_run"))


def outlier_flags(df: DataFrame, key: str, value: str, width: float = 2.04) -> DataFrame:
    """1 for values beyond mean ± width deviations of their group; the limits are joined, not windowed."""
    limits = stage(multi_agg(df, [key], [(value, ["mean", "std"])], prefix="_"), "limits")
    rows = df.join(limits, key, "left")
    mean, reach = F.col(f"_{value}_mean"), F.col(f"_{value}_std") * width
    return (rows.withColumn("upper_outlier", F.coalesce((F.col(value) > mean + reach).cast("int"), F.lit(0)))
            .withColumn("lower_outlier", F.coalesce((F.col(value) < mean - reach).cast("int"), F.lit(0)))
            .drop(f"_{value}_mean", f"_{value}_std"))


def cap_outliers(df: DataFrame, key: str, value: str, width: float = 2.04) -> DataFrame:
    """Replace upper (lower) outliers by the largest (smallest) value that is not one, per group.

    The flagged rows are stored: aggregated straight from the join they would have to share its partitioning by key, and
    the rows of one long key could not be split.
    """
    flagged = stage(outlier_flags(df, key, value, width), "flagged")
    ordinary = F.when((F.col("upper_outlier") == 0) & (F.col("lower_outlier") == 0), F.col(value))
    limits = flagged.groupBy(key).agg(F.max(ordinary).alias("_hi"), F.min(ordinary).alias("_lo"))
    return (flagged.join(limits, key, "left")
            .withColumn(f"{value}_capped", F.when(F.col("upper_outlier") == 1, F.col("_hi"))
                        .when(F.col("lower_outlier") == 1, F.col("_lo")).otherwise(F.col(value)))
            .drop("_hi", "_lo"))
