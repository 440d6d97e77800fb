"""New period against history, each family in one pass with conditional aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cardloom.functions.clean import ratio
from cardloom.operators.aggregate import EXACT_SCALE, exact_sum, multi_agg, statistic, two_level
from cardloom.sources.tables import stage


def history() -> Column:
    return F.col("month_lag") <= 0


def recent() -> Column:
    return F.col("month_lag") > 0


def authorised_history(flag: str) -> Column:
    return history() & (F.col("authorized_flag") == flag)


def since(lag: int) -> Column:
    return F.col("month_lag") >= lag


def lag_slices(base: Column, lags: Sequence[int]) -> dict[str, Column]:
    """Name suffix and condition of each cumulative lag slice."""
    return {f"_{lag}": base & since(lag) for lag in lags}


def history_cards(df: DataFrame, key: str = "card_id") -> DataFrame:
    return df.where(F.col(key).isNotNull() & history())


def _with_history(table: DataFrame) -> DataFrame:
    """Keep the keys that have history rows, as a left join from the history side would."""
    return table.where(F.col("_hist_rows") > 0).drop("_hist_rows")


def _history_rows() -> Column:
    return F.count(F.when(history(), F.lit(1))).alias("_hist_rows")


def distinct_ratios(df: DataFrame, key: str, columns: Sequence[str], dealt: bool = False) -> DataFrame:
    """Number of values in the new period over their number in history; a missing value counts as one.

    Cards without new rows get 0. The rows are stored and each column is grouped by value for itself, in tasks of its own:
    all columns in one aggregation would hold a group for each row and column at once. ``dealt`` says that the rows of a key
    already lie in one partition: they are not stored again, and the columns' counts are joined there.
    """
    if dealt:
        tables = []
        for c in columns:
            values = df.where(F.col(key).isNotNull()).groupBy(key, c).agg(F.bool_or(history()).alias("_h"), F.bool_or(recent()).alias("_r"))
            old, new = (F.count(F.when(F.col(flag), F.lit(1))) for flag in ("_h", "_r"))
            tables.append(values.groupBy(key).agg(*([] if tables else [old.alias("_hist_rows")]),
                                                  F.coalesce(ratio(new, old), F.lit(0.0)).alias(f"new_hist_{c}_counts_ratio")))
        return _with_history(reduce(lambda a, b: a.join(b, key), tables))
    rows = stage(df.where(F.col(key).isNotNull()).select(key, *columns, history().alias("_h"), recent().alias("_r")), "values")
    groups = reduce(DataFrame.unionAll, [
        rows.groupBy(key, c).agg(F.bool_or("_h").alias("_h"), F.bool_or("_r").alias("_r")).select(key, F.lit(i).alias("_column"), "_h", "_r")
        for i, c in enumerate(columns)])

    def number(i: int, flag: str) -> Column:
        return F.count(F.when((F.col("_column") == i) & F.col(flag), F.lit(1)))

    table = groups.groupBy(key).agg(
        F.count(F.when(F.col("_h"), F.lit(1))).alias("_hist_rows"),
        *[F.coalesce(ratio(number(i, "_r"), number(i, "_h")), F.lit(0.0)).alias(f"new_hist_{c}_counts_ratio")
          for i, c in enumerate(columns)])
    return _with_history(table)


def sum_ratios(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Sum in the new period over the sum in history, 0 where undefined."""
    def total(column: str, where: Column) -> Column:
        return exact_sum(F.when(where, F.col(column)), EXACT_SCALE.get(column))
    table = df.where(F.col(key).isNotNull()).groupBy(key).agg(_history_rows(), *[
        F.coalesce(ratio(total(c, recent()), total(c, history())), F.lit(0.0)).alias(f"new_hist_{c}_sum_ratio")
        for c in columns])
    return _with_history(table)


def lag_sum_ratios(df: DataFrame, key: str, value: str, lags: Sequence[int]) -> DataFrame:
    """New sum over the history sum since each lag, 0 where undefined."""
    scale = EXACT_SCALE.get(value)
    new = exact_sum(F.when(recent(), F.col(value)), scale)
    table = df.where(F.col(key).isNotNull()).groupBy(key).agg(_history_rows(), *[
        F.coalesce(ratio(new, exact_sum(F.when(history() & since(lag), F.col(value)), scale)), F.lit(0.0))
        .alias(f"new_hist_{value}_sum_ratio_{lag}") for lag in lags])
    return _with_history(table)


def two_level_ratios(df: DataFrame, key: str, inner: Sequence[str], value: str, outer: Sequence[str],
                     name: str, hot_rows: int | None = None, dealt: bool = False) -> DataFrame:
    """Statistics over per-group means, new over history, 0 where undefined."""
    table = two_level(df, key, inner, value, "mean", outer, name,
                      {"_hist": history(), "_new": recent()}, hot_rows, dealt)
    ratios = [F.coalesce(ratio(F.col(f"{name}_new_{s}"), F.col(f"{name}_hist_{s}")), F.lit(0.0))
              .alias(f"new_hist_{name}_{s}_ratio") for s in outer]
    return table.where(F.col(f"{name}_hist_{outer[0]}").isNotNull()).select(key, *ratios)


def peak_group_ratio(df: DataFrame, key: str, inner: str, value: str, name: str) -> DataFrame:
    """Largest group sum in history and in the new period, and their quotient (holiday spend)."""
    table = two_level(df, key, [inner], value, "sum", ["max"], name, {"_hist": history(), "_new": recent()})
    hist, new = F.col(f"{name}_hist_max"), F.col(f"{name}_new_max")
    return table.where(hist.isNotNull()).select(
        key, hist.alias(f"hist_{name}_max"), new.alias(f"new_{name}_max"),
        ratio(new, hist).alias(f"new_hist_{name}_max_ratio"))


def mean_to_current(df: DataFrame, key: str, value: str, hist_lags: Sequence[int], new_lags: Sequence[int],
                    hist_where: Column) -> DataFrame:
    """Mean of each lag window over the mean of the current month (lag 0)."""
    scale = EXACT_SCALE.get(value)
    current = statistic(F.col(value), "mean", scale, F.col("month_lag") == 0)
    windows = {**lag_slices(hist_where, hist_lags), **lag_slices(recent(), new_lags)}
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*[
        ratio(statistic(F.col(value), "mean", scale, where), current).alias(f"avg_purchase_ratio{suffix}")
        for suffix, where in windows.items()])


def per_lag_rates(df: DataFrame, prefix: str, columns: Sequence[str], lags: Sequence[int]) -> DataFrame:
    """Window sums and counts per month of window length."""
    made: Mapping[str, Column] = {
        f"{prefix}per_time_{c}_{lag}": F.col(f"{prefix}{c}_{lag}") / abs(lag) for c in columns for lag in lags}
    return df.withColumns(dict(made))


def purchase_span(df: DataFrame, key: str, ts: str, prefix: str, where: Column) -> DataFrame:
    """First and last purchase of one slice."""
    return df.groupBy(key).agg(F.min(F.when(where, F.col(ts))).alias(f"{prefix}first_purchase_date"),
                               F.max(F.when(where, F.col(ts))).alias(f"{prefix}last_purchase_date"))


def slice_statistics(df: DataFrame, key: str, spec, exact: Mapping[str, int] | None = None, **options) -> DataFrame:
    """The same statistics for history and new period, suffixed ``_hist`` and ``_new``."""
    return multi_agg(df, [key], spec, slices={"_hist": history(), "_new": recent()}, exact=exact, **options)
