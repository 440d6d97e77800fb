"""Join and set shapes of feature tables. No side is hinted: Spark sizes its joins at run time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def full_outer(keys: Sequence[str], *tables: DataFrame) -> DataFrame:
    """Full outer join with one coalesced key."""
    return reduce(lambda a, b: a.join(b, list(keys), "full_outer"), tables)


def membership(cards: DataFrame, rows: DataFrame, key: str, flags: Mapping[str, Column]) -> DataFrame:
    """0/1 flags telling whether a card has rows under each condition; one aggregation for all flags."""
    any_flag = reduce(lambda a, b: a | b, flags.values())
    seen = rows.where(any_flag & F.col(key).isNotNull()).groupBy(key).agg(
        *[F.max(F.when(c, 1).otherwise(0)).alias(n) for n, c in flags.items()])
    return cards.join(seen, key, "left").na.fill(0, list(flags))


def dimension(facts: DataFrame, table: DataFrame, key: str, columns: Sequence[str], dedupe: bool = False) -> DataFrame:
    """Left join of chosen dimension columns. Repeated keys fan out unless ``dedupe`` keeps their smallest row."""
    chosen = table.select(key, *columns)
    if dedupe:
        chosen = chosen.groupBy(key).agg(F.min(F.struct(*columns)).alias("_row")).select(key, "_row.*")
    return facts.join(chosen, key, "left")


def add_missing_columns(facts: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Join only the dimension columns that the facts do not have yet."""
    return dimension(facts, table, key, [c for c in table.columns if c not in facts.columns])


def side_by_side(key: str, *tables: DataFrame) -> DataFrame:
    """Column-wise concatenation of tables with one row per key."""
    return reduce(lambda a, b: a.join(b, key), tables)


def append(tables: Sequence[DataFrame]) -> DataFrame:
    """Row-wise concatenation by column name; absent columns become missing."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The columns that are not named, in their order."""
    dropped = set(names)
    return df.select(*[c for c in df.columns if c not in dropped])


def restore_order(df: DataFrame, index: str, keep: bool = False) -> DataFrame:
    """Sort back by an index column that recorded the original order."""
    ordered = df.sort(index)
    return ordered if keep else ordered.drop(index)


def frequency_report(df: DataFrame, column: str) -> DataFrame:
    """Values with their row counts, most frequent first."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value")
