"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardloom.llm import bpe, chat, crosspolytope, importance, langid, linededup, packing, prefixtrie, recount, rules, simhash, turnrepair, urlfilter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predictions(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.digests(table(spark, sf_dir, "documents"))


def op5_edited_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recount.recount(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.with_control_strings(table(spark, sf_dir, "conversations"))
    return chat.read_back(chat.windows(turns))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=2)


def op9_cross_polytope_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosspolytope.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = turnrepair.damage(table(spark, sf_dir, "conversations"))
    return turnrepair.digests(turnrepair.repair(damaged, here="here"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), spark.createDataFrame(urlfilter.ENTRIES, urlfilter.RULES))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.prefix_nodes(*prefixtrie.rebuilt(prefixtrie.coded_turns(table(spark, sf_dir, "conversations"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_importance_resampling, op2_bpe_round_trip, op3_language_id, op4_line_dedup, op5_edited_token_counts, op6_chat_windows,
    op7_quality_rules, op8_simhash_components, op9_cross_polytope_search, op10_best_fit_packing, op11_turn_repair, op12_url_filter,
    op13_prefix_trie)}

SQL: dict[str, str] = {"op4_line_dedup": linededup.DIGEST_SQL, "op6_chat_windows": chat.DIGEST_SQL, "op12_url_filter": urlfilter.VERDICT_SQL,
                       "op13_prefix_trie": prefixtrie.NODES_SQL}
