"""Reproducible fold assignment from key hashes: no random stream, so a retried task agrees with itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cardloom.operators.ordering import position_in_group

HASH_RANGE = 2 ** 32


def key_hash(key: str, seed: int) -> Column:
    """A uniform integer below 2^32 from the key and a seed."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def kfold(df: DataFrame, key: str, k: int, seed: int, name: str = "fold") -> DataFrame:
    return df.withColumn(name, (key_hash(key, seed) % k).cast("int"))


def stratified_kfold(df: DataFrame, key: str, label: str, k: int, seed: int, name: str = "fold",
                     hot_rows: int | None = None) -> DataFrame:
    """Deal the shuffled rows of each label value round the folds, so shares differ by one row at most.

    A label value with very many rows is numbered by pieces, not in one task.
    """
    hashed = df.withColumn("_h", key_hash(key, seed))
    placed = position_in_group(hashed, [label], ["_h", key], "_pos", hot_rows)
    return placed.withColumn(name, ((F.col("_pos") - 1) % k).cast("int")).drop("_h", "_pos")


def validation_split(df: DataFrame, key: str, share: float, seed: int, name: str = "is_validation") -> DataFrame:
    return df.withColumn(name, key_hash(key, seed) < int(share * HASH_RANGE))
