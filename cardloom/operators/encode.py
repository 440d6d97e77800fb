"""Label codes, one-hot columns and label-rate encodings."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from cardloom.operators.ordering import position_in_group
from cardloom.operators.pivots import pivot_values, value_name
from cardloom.session import settle
from cardloom.sources.tables import stage

# Smoothing term and scale of the label rate.
SMOOTHING = 0.01
RATE_SCALE = 1000


def label_dictionary(df: DataFrame, columns: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """(column, value, code): dense codes in text order for all columns, a missing value being text ``nan``.

    Ranking runs over distinct values only, and by pieces where a column has very many of them. The values are
    stored, since every encoded column reads them.
    """
    entries = F.array(*[F.struct(F.lit(c).alias("column"),
                                 F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias("value"))
                        for c in columns])
    values = settle(df.select(F.explode(entries).alias("e")).select("e.*").distinct())
    ranked = position_in_group(values, ["column"], ["value"], "_rank", hot_rows)
    return stage(ranked.select("column", "value", (F.col("_rank") - 1).cast("int").alias("code")), "labels")


def label_encode(df: DataFrame, columns: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """Replace columns by their label codes."""
    dictionary = label_dictionary(df, columns, hot_rows)
    for c in columns:
        codes = dictionary.where(F.col("column") == c).select(F.col("value").alias("_v"), F.col("code").alias("_code"))
        df = (df.withColumn("_v", F.coalesce(F.col(c).cast("string"), F.lit("nan")))
              .join(codes, "_v", "left").withColumn(c, F.col("_code")).drop("_v", "_code"))
    return df


def one_hot(df: DataFrame, columns: Sequence[str] | None = None, null_level: bool = False,
            keep: bool = False) -> DataFrame:
    """0/1 columns for every value found; by default for all text columns."""
    columns = columns or [f.name for f in df.schema if f.dataType.typeName() == "string"]
    made: dict[str, Column] = {}
    for c in columns:
        made |= {value_name(c, v): F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)) for v in pivot_values(df, c)}
        if null_level:
            made[f"{c}_nan"] = F.col(c).isNull().cast("int")
    encoded = df.withColumns(made)
    return encoded if keep else encoded.drop(*columns)


def smoothed(clicks: Column, count: Column) -> Column:
    return (clicks + SMOOTHING) * RATE_SCALE / (count + SMOOTHING)


def rate_name(keys: Sequence[str]) -> str:
    return "_".join(keys) + "_ctr"


def key_sets(items: Sequence[str], pairs: bool = True) -> list[list[str]]:
    """Every single key, and every pair of keys."""
    return [[i] for i in items] + ([list(p) for p in combinations(items, 2)] if pairs else [])


def _text(df: DataFrame, column: str) -> Column:
    """A key's value as text; both zeros of a floating-point column are one value, as in a join."""
    kind = df.schema[column].dataType.typeName()
    return (F.col(column) + F.lit(0.0) if kind in ("double", "float") else F.col(column)).cast("string")


def _keyed(df: DataFrame, items: Sequence[str], pairs: bool, *keep: Column) -> DataFrame:
    """``keep`` with (``_set``, ``_a``, ``_b``): one row for every key set of ``df`` whose items are all known."""
    entries = []
    for i, keys in enumerate(key_sets(items, pairs)):
        first, second = _text(df, keys[0]), _text(df, keys[1]) if len(keys) > 1 else F.lit("")
        entries.append(F.when(first.isNotNull() & second.isNotNull(), F.struct(
            F.lit(i).alias("_set"), first.alias("_a"), second.alias("_b"))))
    return df.select(*keep, F.explode(F.array_compact(F.array(*entries))).alias("_e")).select(
        *[c for c in df.select(*keep).columns], "_e.*")


def rate_lookup(source: DataFrame, items: Sequence[str], label: str, fold: str | None = None, pairs: bool = True) -> DataFrame:
    """All smoothed rates in one long table: (``_set``, ``_a``, ``_b``) with ``_total``, the rate over all rows, and
    ``_outside``, a map from each fold the key occurs in to the rate of its rows outside that fold.

    The rows are read once. They combine by key before they are shuffled, whatever the number of key sets. A key whose
    rows all lie in one fold has no rate there.
    """
    folded = F.col(fold).cast("int") if fold else F.lit(None).cast("int")
    rows = _keyed(source, items, pairs, folded.alias("_fold"), F.col(label).alias("_label"))
    parts = rows.groupBy("_set", "_a", "_b", "_fold").agg(F.sum("_label").alias("_c"), F.count("_label").alias("_n"))
    keys = parts.groupBy("_set", "_a", "_b").agg(F.sum("_c").alias("_tc"), F.sum("_n").alias("_tn"),
                                                 F.collect_list(F.struct("_fold", "_c", "_n")).alias("_parts"))

    def outside(part: Column) -> Column:
        count = F.col("_tn") - part["_n"]
        rate = F.when(count > 0, smoothed(F.col("_tc") - F.coalesce(part["_c"], F.lit(0)), count))
        return F.struct(part["_fold"], rate)

    known = F.filter("_parts", lambda p: p["_fold"].isNotNull())
    return keys.select("_set", "_a", "_b", smoothed(F.col("_tc"), F.col("_tn")).alias("_total"),
                       F.map_from_entries(F.transform(known, outside)).alias("_outside"))


def attach_rates(df: DataFrame, source: DataFrame, items: Sequence[str], label: str, key: str, pairs: bool = True,
                 fold: str | None = None) -> DataFrame:
    """Label rates of single keys and key pairs, learned on ``source`` and joined to ``df``; ``key`` names a row of ``df``.

    Given ``fold``, rows with a fold get the rates learned outside it, rows without one the rates of all of ``source``.
    All key sets go through one join, as long rows of the items alone, and one aggregation by ``key`` sets them side by side.
    """
    lookup = stage(rate_lookup(source, items, label, fold, pairs), "rates")
    own = F.col(fold).cast("int") if fold else F.lit(None).cast("int")
    asked = _keyed(df, items, pairs, F.col(key), own.alias("_fold"))
    rate = F.when(F.map_contains_key("_outside", F.coalesce("_fold", F.lit(-1))), F.try_element_at("_outside", F.coalesce("_fold", F.lit(-1)))).otherwise(F.col("_total"))
    met = asked.join(lookup, ["_set", "_a", "_b"]).select(key, "_set", rate.alias("_rate"))
    wide = met.groupBy(key).agg(*[F.max(F.when(F.col("_set") == i, F.col("_rate"))).alias(rate_name(keys))
                                  for i, keys in enumerate(key_sets(items, pairs))])
    return df.join(wide, key, "left")


def attach_out_of_fold(df: DataFrame, items: Sequence[str], label: str, fold: str, key: str, pairs: bool = True) -> DataFrame:
    """Rates of every key set, each row's own fold left out."""
    return attach_rates(df, df, items, label, key, pairs, fold)


def mean_encode(df: DataFrame, columns: Sequence[str], label: str, suffix: str = "") -> DataFrame:
    """Replace each value by the mean label of all rows that share it."""
    for c in columns:
        means = stage(df.where(F.col(c).isNotNull()).groupBy(c).agg(F.avg(label).alias("_m")), "means")
        df = df.join(means, c, "left").withColumn(f"{c}{suffix}", F.col("_m")).drop("_m")
    return df
