"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Every stage works on all rows its predecessor kept and takes (spark, docs, folder of the tables). All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardloom.llm import langid, linededup, packing, rules, simhash
from cardloom.sources.tables import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned decision list reject go."""
    return rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or whose language is not certain enough, go."""
    return langid.keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines shared by many documents stay in one of them; ``text`` and ``n_chars`` follow."""
    cleaned = linededup.line_dedup(docs)
    changed = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return cleaned.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest doc_id."""
    return simhash.keep_one(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document, measured in tokens, lies in which training sequence."""
    return packing.pack_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules), ("language ID", language_id), ("line dedup", line_dedup),
    ("SimHash near-dedup", near_duplicates), ("best-fit packing", best_fit_packing),
]

ORACLE_SQL = None  # learned rules and models, and connected components, have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
