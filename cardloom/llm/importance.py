"""Quality by importance resampling.

Two generative models of hashed word n-grams (one and two words), one of the target texts and one of all texts, give each
document the log of the ratio of its probabilities. Adding Gumbel noise, drawn from a hash of the row, and keeping the
largest keys samples documents without replacement in proportion to that ratio.

Counts of the raw model cover all documents, each task sending one row for each bucket. The target model may be fitted on
a bounded number of labelled documents (``target_docs``), whose keys are then few enough to be broadcast. Scoring is
one pass without a shuffle; only keys are sorted to find the ranks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cardloom.llm.batches import arrow_fields, ddl, row_map, texts_as_bytes
from cardloom.operators.ordering import global_index
from cardloom.sources.tables import stage

BUCKETS, BLOCK = 10_000, 1 << 16


def ngrams(text: bytes | None) -> Iterator[np.ndarray]:
    """Buckets of the words and word pairs of a text, A-Z lower-cased, block by block."""
    words = (text or b"").lower().split()
    for at in range(0, len(words), BLOCK):
        part = words[at:at + BLOCK + 1]
        h = np.array([xxhash.xxh32_intdigest(w) for w in part], np.uint64)
        pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(32)
        yield np.concatenate([h[:BLOCK] % BUCKETS, pairs % BUCKETS]).astype(np.int64)


def good_keys(labels: DataFrame, key: str, good: Column, target_docs: int) -> DataFrame:
    """At most ``target_docs`` labelled keys for which ``good`` holds, chosen by hash."""
    found = labels.where(good & F.col(key).isNotNull()).select(F.col(key).alias("k")).distinct()
    return found.orderBy(F.xxhash64("k"), "k").limit(target_docs)


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Counts of each bucket over all rows, and over those with ``target``: two rows of ``BUCKETS``."""
    schema = pa.schema([("bucket", pa.int32()), ("raw", pa.int64()), ("target", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for t, target in zip(texts_as_bytes(batch.column(0)), batch.column(1).to_pylist()):
                for found in ngrams(t):
                    total[:1 + target] += np.bincount(found, minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS, dtype=np.int32)), *map(pa.array, total)], schema=schema)

    counts = np.zeros((2, BUCKETS))
    summed = texts.mapInArrow(run, "bucket int, raw long, target long").groupBy("bucket").agg(F.sum("raw"), F.sum("target"))
    for bucket, raw, target in summed.collect():  # one row for each bucket
        counts[:, bucket] = raw, target
    return counts


def log_ratios(counts: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """Log of target over raw probability of each bucket; 0 everywhere without target texts."""
    if not counts[1].sum():
        return np.zeros(BUCKETS)
    raw, target = (np.log(c + smoothing) - np.log(c.sum() + smoothing * BUCKETS) for c in counts)
    return target - raw


def log_weights(docs: DataFrame, ratios: np.ndarray, key: str, text: str) -> DataFrame:
    """``key``, ``version`` (a hash of the text), ``n_grams`` and ``log_weight`` of every row."""
    found = docs.select(key, F.xxhash64(text).alias("version"), text)
    kept = [key, "version"]
    schema = pa.schema([*arrow_fields(found, kept), ("n_grams", pa.int64()), ("log_weight", pa.float64())])

    def rows(batch: pa.RecordBatch):
        for k, v, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_as_bytes(batch.column(2))):
            n, total = 0, 0.0
            for found in ngrams(t):
                n, total = n + len(found), total + float(ratios[found].sum())
            yield k, v, n, total

    return found.mapInArrow(row_map(rows, schema), f"{ddl(found, kept)}, n_grams long, log_weight double")


def gumbel(seed: int, *columns: str) -> Column:
    """Standard Gumbel noise from a hash of columns: the same row always draws the same."""
    uniform = (F.pmod(F.xxhash64(*columns, F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return -F.log(-F.log(uniform))


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, target_docs: int = 20_000, seed: int = 42,
             key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_grams``, ``log_weight``, ``gumbel_key``, ``rank`` (from 0) and ``kept`` of every row.

    The target texts are those labelled good (quality 1) and not toxic. ``share`` of the rows are kept, by default the
    share of the labelled keys with a good label; without any label all are. ``labels`` has ``quality`` and ``toxic``. A null or blank text has no n-grams and weight 0.
    Rows with a null key are never targets, but are ranked; equal keys go in the order of ``key`` and text hash; repeated
    rows share their noise. Other columns are left out.
    """
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    targets = good_keys(labels, key, good, target_docs)
    texts = docs.select(F.col(key).alias("own"), F.col(text).alias("t"))
    marked = texts.join(F.broadcast(targets), F.col("own") == F.col("k"), "left").select("t", F.col("k").isNotNull().alias("target"))
    ratios = log_ratios(bucket_counts(marked))
    if share is None:
        share = labels.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.coalesce(good, F.lit(False))).alias("good")).agg(
            F.avg(F.col("good").cast("double"))).first()[0]
    weighed = log_weights(docs, ratios, key, text)
    keyed = stage(weighed.withColumn("gumbel_key", F.col("log_weight") + gumbel(seed, key, "version")), "weighed")
    keep = round((1.0 if share is None else share) * keyed.count())
    ranked = global_index(keyed, [F.desc("gumbel_key"), key, "version"], "rank")
    return ranked.select(key, "n_grams", "log_weight", "gumbel_key", "rank", (F.col("rank") < keep).alias("kept"))
