"""Token counts in long form and token selection by chi-square mass."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: a token is a run of letters, digits and underscores, after lower-casing.
TOKEN_PATTERN = r"[\p{L}\p{N}_]+"


def tokens(column: str) -> Column:
    return F.regexp_extract_all(F.lower(column), F.lit(TOKEN_PATTERN), F.lit(0))


def token_counts(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, block, token, n): every token of every text column, no vocabulary limit."""
    blocks = F.array(*[F.struct(F.lit(c).alias("block"), tokens(c).alias("words")) for c in columns])
    words = df.select(key, F.explode(blocks).alias("b")).select(key, "b.block", F.explode("b.words").alias("token"))
    return words.groupBy(key, "block", "token").agg(F.count(F.lit(1)).alias("n"))


def sequence_token_counts(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Token counts of the text each card would have, straight from its rows: no text is assembled."""
    texts = df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in columns})
    return token_counts(texts, key, columns)


def chi_square(counts: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """(block, token, chi2): observed against expected token mass per class.

    The expected mass of a class is its share of the labelled rows times the token's total mass.
    """
    labels = labels.where(F.col(label).isNotNull()).select(key, F.col(label).alias("_y"))
    classes = labels.groupBy("_y").agg(F.count(F.lit(1)).alias("_n")).orderBy("_y").collect()  # one row per class
    rows = sum(c["_n"] for c in classes)
    total = F.sum("n")
    terms = []
    for c in classes:
        expected = total * F.lit(c["_n"] / rows)
        observed = F.sum(F.when(F.col("_y") == F.lit(c["_y"]), F.col("n")).otherwise(0))
        terms.append((observed - expected) * (observed - expected) / expected)
    return counts.join(labels, key).groupBy("block", "token").agg(reduce(lambda a, b: a + b, terms).alias("chi2"))


def select_top(scores: DataFrame, k: int, score: str = "chi2", ties: Sequence[str] = ("block", "token")) -> DataFrame:
    """The k best-scored rows, ties in name order."""
    return scores.orderBy(F.desc(score), *ties).limit(k)


def selected_counts(counts: DataFrame, chosen: DataFrame) -> DataFrame:
    """Only the counts of chosen tokens, which are at most k rows."""
    return counts.join(chosen.select("block", "token"), ["block", "token"])
