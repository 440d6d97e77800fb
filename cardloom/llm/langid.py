"""Language identification of whole texts.

Features are character n-grams inside words, hashed to buckets and weighted by TF-IDF. A multinomial logistic regression
is trained with follow-the-regularised-leader (FTRL-proximal) under an elastic-net penalty, which keeps most weights
exactly zero, and its probabilities are calibrated with one temperature.

Document frequencies come from all documents that may teach; the regression sees a sample of at most ``per_class``
documents of each language on average, chosen by hash, because its steps are sequential. Prediction is one pass over the
scan without a shuffle: a text's logits are means of its n-grams' weights, block by block, however long it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cardloom.llm.batches import arrow_fields, ddl, row_map, to_batch

BUCKETS, BLOCK = 1 << 16, 1 << 18  # n-gram buckets; code points of a text handled at once
UNKNOWN = "und"
MIX = tuple(map(np.uint32, (2654435761, 2246822519, 3266489917)))  # odd multipliers, one for each place of an n-gram
SPACE = np.uint32(32)


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of one to three characters inside the words of a text, block by block.

    A word is a run of letters between two spaces; n-grams may begin or end with a space but never span one."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le"), np.uint32)
    padded = np.full(len(codes) + 3, SPACE)
    padded[1:-2] = np.where(letters()[codes], codes, SPACE)
    for at in range(0, len(codes) + 1, BLOCK):
        part = padded[at:at + BLOCK + 2]
        one, two, three = part[:-2], part[1:-1], part[2:]
        first = one * MIX[0]
        pair = (first + two) * MIX[1]
        triple = (pair + three) * MIX[2]
        word, begins = two != SPACE, one != SPACE
        yield np.concatenate([first[begins] >> 16, pair[word | begins] >> 16, triple[word] >> 16])


def term_counts(text: str | None) -> np.ndarray:
    """How often the text has each bucket."""
    return sum((np.bincount(g, minlength=BUCKETS) for g in grams(text)), np.zeros(BUCKETS, np.int64))


@dataclass
class Model:
    """``weights`` already hold the inverse document frequencies; logits are means over a text's n-grams."""
    classes: list[str]
    weights: np.ndarray  # buckets x classes
    bias: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        total, n = np.zeros(len(self.classes)), 0
        for found in grams(text):
            total += self.weights[found].sum(axis=0, dtype=np.float64)
            n += len(found)
        if not n or not self.classes:
            return UNKNOWN, 0.0
        shares = softmax((total / n + self.bias) / self.temperature)
        best = int(shares.argmax())
        return self.classes[best], float(shares[best])


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def held_out(key: str) -> Column:
    """The documents that never teach: remainder 1 of crc32 of the key by three, and rows without a key."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", per_class: int = 1000,
          epochs: int = 2, scale: float = 20.0, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.002,
          l2: float = 0.001) -> Model:
    """A model from the rows that have a key, a label and a text with letters, and are not held out."""
    teaching = docs.where(~held_out(key) & F.col(label).isNotNull()).select(
        F.col(key).alias("k"), F.col(text).alias("t"), F.col(label).alias("y"))
    sizes = {r["y"]: r["n"] for r in teaching.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    classes = sorted(sizes)
    if not classes:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0)
    frequency = np.zeros(BUCKETS)
    for bucket, n in document_frequencies(teaching.select("t")).collect():
        frequency[bucket] = n
    weight = np.log((1 + sum(sizes.values())) / (1 + frequency)) + 1
    draw = F.pmod(F.xxhash64("k", "t"), F.lit(1 << 30)) / float(1 << 30)
    share = F.element_at(F.create_map(*[F.lit(x) for c in classes for x in (c, min(1.0, per_class / sizes[c]))]), F.col("y"))
    sample = teaching.where(draw < share).limit(4 * per_class * len(classes))
    order, rows = [], []
    for mark, y, idx, counts in sampled_counts(sample).collect():
        idx, counts = np.frombuffer(idx, np.int32), np.frombuffer(counts, np.int32)
        if len(idx):
            x = scale * counts / counts.sum() * weight[idx]
            order.append((mark, y, len(rows)))
            rows.append((np.append(idx, BUCKETS), np.append(x, 1.0), classes.index(y)))
    rows = [rows[i] for *_, i in sorted(order)]
    held = [r for i, r in enumerate(rows) if i % 5 == 0]
    w = ftrl([r for i, r in enumerate(rows) if i % 5], len(classes), epochs, alpha, beta, l1, l2)
    logits = np.array([x @ w[i] for i, x, _ in held]).reshape(-1, len(classes))
    return Model(classes, (scale * weight[:, None] * w[:-1]).astype(np.float32), w[-1],
                 temperature(logits, np.array([y for *_, y in held], int)))


def document_frequencies(texts: DataFrame) -> DataFrame:
    """(``bucket``, ``n``): in how many texts each bucket occurs; each task sends at most one row for each bucket."""
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, bool)
        for batch in batches:
            for t in batch.column(0):
                seen[:] = False
                for found in grams(t.as_py()):
                    seen[found] = True
                total += seen
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], schema=schema)

    return texts.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def sampled_counts(sample: DataFrame) -> DataFrame:
    """(``mark``, ``y``, buckets, counts) of the sampled rows, the arrays as bytes; ``mark`` orders them."""
    schema = pa.schema([("mark", pa.int64()), ("y", pa.string()), ("idx", pa.binary()), ("counts", pa.binary())])

    def rows(batch: pa.RecordBatch):
        for mark, y, t in zip(*[c.to_pylist() for c in batch.columns]):
            counts = term_counts(t)
            used = np.flatnonzero(counts)
            yield mark, y, used.astype(np.int32).tobytes(), counts[used].astype(np.int32).tobytes()

    return sample.select(F.xxhash64("k", "t", F.lit(7)).alias("mark"), "y", "t").mapInArrow(
        row_map(rows, schema), "mark long, y string, idx binary, counts binary")


def ftrl(rows: list, n_classes: int, epochs: int, alpha: float, beta: float, l1: float, l2: float) -> np.ndarray:
    """Weights (buckets + 1 for the bias) x classes."""
    z, n = np.zeros((BUCKETS + 1, n_classes)), np.zeros((BUCKETS + 1, n_classes))

    def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        shrunk = np.sign(zi) * np.maximum(np.abs(zi) - l1, 0)
        return -shrunk / ((beta + np.sqrt(ni)) / alpha + l2)

    for _ in range(epochs):
        for idx, x, y in rows:
            zi, ni = z[idx], n[idx]
            w = weights(zi, ni)
            error = softmax(x @ w)
            error[y] -= 1
            g = x[:, None] * error
            grown = ni + g * g
            z[idx], n[idx] = zi + g - (np.sqrt(grown) - np.sqrt(ni)) / alpha * w, grown
    return weights(z, n)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits under which the held-back rows are likeliest, to about one part in a hundred."""
    if not len(y):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 600))
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``lang_pred`` and ``score`` of every row; ``und`` and 0 for a text without letters, or a null text.

    Null keys and repeated rows are kept, other columns are left out. A model that learned nothing says ``und``.
    """
    found = docs.select(key, text)
    schema = pa.schema([*arrow_fields(found, [key]), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield to_batch([(k, *model.predict(t.as_py())) for k, t in zip(batch.column(0).to_pylist(), batch.column(1))], schema)

    return found.mapInArrow(run, f"{ddl(found, [key])}, lang_pred string, score double")


def predictions(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score``, with a model learned from the same table."""
    found = identify(docs, train(docs))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least_score: float = 0.5, key: str = "doc_id", text: str = "text",
                    label: str = "lang") -> DataFrame:
    """The rows, with all their columns, whose language is known with at least ``least_score``.

    If no row could teach (none has a label, or all that have one are held out), no language is known, and all rows
    whose text has letters stay."""
    model, at = train(docs, key, text, label), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model.classes:
                said = [model.predict(t.as_py()) for t in batch.column(at)]
                kept = [lang != UNKNOWN and score >= least_score for lang, score in said]
            else:
                kept = [any(len(found) for found in grams(t.as_py())) for t in batch.column(at)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
