"""Approximate nearest neighbours by cross-polytope hashing.

Stored vectors fall into bands of similar norm. Each band is scaled by its own largest norm onto the unit sphere with one
more coordinate, which turns the largest inner product into the smallest angle. A band with fewer vectors than a table has
buckets is not hashed: all queries meet all of it. Each table rotates them with three rounds of random signs and a fast Hadamard transform and assigns them to the
nearest signed axis. As the table grows, a second rotation of which only the first coordinates count cuts each axis's bucket
further, so that buckets grow in number and not in size. A stored vector enters one bucket of each table; a query probes the
buckets in the order of their joint distance from its own.

How many tables and probes are needed falls as the table grows, because the nearest of more vectors are nearer. Both are chosen
on a bounded sample of queries: their exact neighbours among all vectors are found in one pass, and the cheapest pair is taken
with which the sample's neighbours would have been found.

Stored vectors and queries of a bucket are dealt into blocks of bounded size, and every block of stored vectors meets
every block of queries of its bucket, so a bucket that holds a third of all vectors is spread over many tasks and nothing
in it is skipped. A task scores exactly, in double precision on the original vectors, and sends on each query's best k;
those of all blocks are merged by query. Queries that end with fewer rows than there are candidates for meet all stored
vectors in the same kind of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import FloatType

from cardloom.llm.batches import row_map
from cardloom.sources.tables import stage

ROUNDS = 3
STEP = 2 ** 0.5  # largest over smallest norm of a band
MOVED = 32  # a vector sent to a bucket costs about as much as this many scored pairs
CELLS = 1 << 22  # joint distances held at once
WHOLE = -1  # table and band of the vectors that are not hashed


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(``id``, ``v``, ``norm``): vectors of doubles without null or non-finite components and not all zero, with a key; each once.

    The largest component is a column before the norm is taken, or it would be looked for anew at each component."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col(key).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
            .where(finite & F.exists("v", lambda x: x != 0)).withColumn("top", F.array_max(F.transform("v", F.abs)))
            .dropDuplicates(["id", "v"]).select("id", "v", norm(F.col("v"), F.col("top")).alias("norm")))


def norm(v: Column, top: Column) -> Column:
    """Euclidean norm; divided by the largest component first, so that squares neither overflow nor vanish."""
    return top * F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + (x / top) * (x / top)))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, whose length is a power of two."""
    n, width, h = *x.shape, 1
    while h < width:
        pairs = x.reshape(n, width // (2 * h), 2, h)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        h *= 2
    return x / np.sqrt(width)


class Rotations:
    """The tables' pseudo-rotations for vectors of ``dimension``; each axis has ``fine`` buckets, a power of two."""

    def __init__(self, dimension: int, tables: int, fine: int = 1, seed: int = 42) -> None:
        self.dimension = dimension
        self.width = 1 << dimension.bit_length()  # room for the further coordinate
        self.fine = min(fine, 2 * self.width)
        self.buckets = 2 * self.width * self.fine
        signs = np.random.default_rng(seed).integers(0, 2, (tables, 2, ROUNDS, self.width))
        self.signs = 2.0 * signs - 1

    def sphere(self, vectors: np.ndarray, largest: np.ndarray | None) -> np.ndarray:
        """Unit vectors: stored ones by the ``largest`` norm of their bands, with the rest in one more place; queries,
        which have none, scaled to norm one."""
        out = np.zeros((len(vectors), self.width))
        if largest is None:
            vectors = vectors / np.abs(vectors).max(axis=1)[:, None]
            out[:, :self.dimension] = vectors / np.linalg.norm(vectors, axis=1)[:, None]
        else:
            out[:, :self.dimension] = vectors / largest[:, None]
            out[:, self.dimension] = np.sqrt(np.maximum(0, 1 - (out[:, :self.dimension] ** 2).sum(axis=1)))
        return out

    def turned(self, unit: np.ndarray, tables: int) -> Iterator[list[np.ndarray]]:
        """For each table the coordinates on the signed axes, and on those that cut them further, if any do."""
        for pair in self.signs[:tables]:
            parts = []
            for signs, kept in zip(pair, (self.width, self.fine // 2)):
                if kept:
                    x = unit
                    for s in signs:
                        x = hadamard(x * s)
                    parts.append(np.concatenate([x[:, :kept], -x[:, :kept]], axis=1))
            yield parts

    def codes(self, vectors: np.ndarray, largest: np.ndarray, tables: int) -> np.ndarray:
        """The bucket of each row in each table."""
        columns = [reduce(lambda code, x: code * self.fine + x.argmax(axis=1), parts[1:], parts[0].argmax(axis=1))
                   for parts in self.turned(self.sphere(vectors, largest), tables)]
        return np.stack(columns, axis=1)

    def orders(self, vectors: np.ndarray, tables: int, probes: int | None = None) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first row, table, the ``probes`` nearest buckets of these rows, nearest first), for a few rows at a time."""
        unit, step = self.sphere(vectors, None), max(1, CELLS // self.buckets)
        for at in range(0, len(unit), step):
            for tab, parts in enumerate(self.turned(unit[at:at + step], tables)):
                far = [(x.max(axis=1)[:, None] - x) ** 2 for x in parts]
                joint = far[0] if len(far) == 1 else (far[0][:, :, None] + far[1][:, None, :]).reshape(len(far[0]), -1)
                yield at, tab, np.argsort(joint, axis=1, kind="stable")[:, :probes]


def padded(arrays: list[list[float]], dimension: int) -> np.ndarray:
    """Rows of one length; a shorter vector has zeros at its end, which no inner product sees."""
    out = np.zeros((len(arrays), dimension))
    for i, a in enumerate(arrays):
        out[i, :len(a)] = a
    return out


def banded(good: DataFrame, least: int) -> tuple[DataFrame, bool]:
    """``good`` with its ``band`` and the ``largest`` norm in it, and whether a band is ``WHOLE``: the bands of fewer
    than ``least`` vectors, as one. A band is a stretch of norms, so there are some thousands of them at most."""
    top = good.agg(F.max("norm")).first()[0] or 1.0
    placed = good.withColumn("band", F.floor((F.log(F.lit(top)) - F.log("norm")) / float(np.log(STEP)) + 1e-9).cast("int"))
    bands = placed.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("largest")).collect()
    big = [r for r in bands if r["n"] >= least]
    edges = good.sparkSession.createDataFrame([(r["band"], r["largest"]) for r in big], "band int, largest double")
    out = placed.join(F.broadcast(edges), "band", "left").select(
        "id", "v", F.when(F.col("largest").isNull(), WHOLE).otherwise(F.col("band")).alias("band"), "largest")
    return out, len(big) < len(bands)


def packed(found: DataFrame, dimension: int, kind: type) -> DataFrame:
    """(``id``, ``v``) with the vector as bytes of ``kind``, which holds its components exactly."""
    schema = pa.schema([("id", pa.int64()), ("v", pa.binary())])

    def rows(batch: pa.RecordBatch):
        if batch.num_rows:
            yield from zip(batch.column(0).to_pylist(), [v.tobytes() for v in padded(batch.column(1).to_pylist(), dimension).astype(kind)])

    return found.select("id", "v").mapInArrow(row_map(rows, schema), "id long, v binary")


def stored_buckets(found: DataFrame, rotations: Rotations, tables: int, kind: type) -> DataFrame:
    """(``band``, ``tab``, ``axis``, ``id``, ``v``): one bucket of each table, or the one of ``WHOLE``."""
    schema = pa.schema([("band", pa.int32()), ("tab", pa.int32()), ("axis", pa.int32()), ("id", pa.int64()), ("v", pa.binary())])

    def rows(batch: pa.RecordBatch):
        if batch.num_rows:
            ids, vectors, bands, largest = [c.to_pylist() for c in batch.columns]
            vectors = padded(vectors, rotations.dimension)
            coded = [v.tobytes() for v in vectors.astype(kind)]
            for i, band in enumerate(bands):
                if band == WHOLE:
                    yield WHOLE, WHOLE, 0, ids[i], coded[i]
            hashed = [i for i, band in enumerate(bands) if band != WHOLE]
            if hashed:
                limits = np.array([largest[i] for i in hashed]) * (1 + 1e-12)
                for i, axes in zip(hashed, rotations.codes(vectors[hashed], limits, tables).tolist()):
                    for tab, axis in enumerate(axes):
                        yield bands[i], tab, axis, ids[i], coded[i]

    return found.select("id", "v", "band", "largest").mapInArrow(row_map(rows, schema), "band int, tab int, axis int, id long, v binary")


def asked_buckets(found: DataFrame, rotations: Rotations, tables: int, probes: int, whole: bool, kind: type) -> DataFrame:
    """(``tab``, ``axis``, ``id``, ``v``): the probed buckets, which are the same in all bands, and the one of ``WHOLE``."""
    schema = pa.schema([("tab", pa.int32()), ("axis", pa.int32()), ("id", pa.int64()), ("v", pa.binary())])

    def rows(batch: pa.RecordBatch):
        if batch.num_rows:
            ids, vectors = batch.column(0).to_pylist(), padded(batch.column(1).to_pylist(), rotations.dimension)
            coded = [v.tobytes() for v in vectors.astype(kind)]
            if whole:
                for i, v in zip(ids, coded):
                    yield WHOLE, 0, i, v
            for at, tab, axes in rotations.orders(vectors, tables, probes):
                for i, row in enumerate(axes.tolist(), start=at):
                    for axis in row:
                        yield tab, axis, ids[i], coded[i]

    return found.select("id", "v").mapInArrow(row_map(rows, schema), "tab int, axis int, id long, v binary")


GROUP = ["band", "tab", "axis", "d", "q"]


def dealt(placed: DataFrame, own: str, other: str) -> DataFrame:
    """Deal each bucket's rows into its blocks, and repeat them for each block of the other side.

    Rows of one key are dealt by their vectors too: one key may hold a large part of all rows."""
    mine = placed.withColumn(own, F.pmod(F.xxhash64("id", "v", F.lit(own)), F.col(f"n_{own}")).cast("int"))
    return mine.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"n_{other}") - 1))).select(*GROUP, "id", "v")


def best_of_block(k: int, dimension: int, kind: type):
    """Exact scores of a block's queries against its stored vectors; the best ``k`` other keys of each query."""
    def score(queries: pa.Table, stored: pa.Table) -> pa.Table:
        def matrix(t: pa.Table) -> np.ndarray:
            return np.frombuffer(b"".join(t["v"].to_pylist()), kind).astype(np.float64).reshape(-1, dimension)
        qs, vs = matrix(queries), matrix(stored)
        order = np.argsort(stored["id"].to_numpy(), kind="stable")
        ids, first = np.unique(stored["id"].to_numpy()[order], return_index=True)
        vs, out = vs[order], []
        for q, qid in zip(qs, queries["id"].to_pylist()) if len(ids) else ():
            products = (vs * q).sum(axis=1)  # the same sum for the same pair, wherever it stands
            if len(ids) < len(products):
                products = np.maximum.reduceat(products, first)
            best = np.lexsort((ids, -products))[:k + 1]
            out += [(qid, int(ids[i]), float(products[i])) for i in best if ids[i] != qid][:k]
        columns = zip(*out) if out else ([], [], [])
        return pa.table([pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))],
                        names=["query_id", "vec_id", "score"])
    return score


def met(asked: DataFrame, stored: DataFrame, k: int, dimension: int, kind: type) -> DataFrame:
    """(``query_id``, ``vec_id``, ``score``) of the best of each pair of blocks."""
    return (dealt(asked, "q", "d").groupBy(*GROUP).cogroup(dealt(stored, "d", "q").groupBy(*GROUP))
            .applyInArrow(best_of_block(k, dimension, kind), "query_id long, vec_id long, score double"))


def ranked(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def sample_codes(in_bands: DataFrame, asked: DataFrame, rotations: Rotations, tables: int, k: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """The sampled queries, and the buckets, in all tables, of the hashed ones among each sampled query's ``k`` nearest; ``asked`` is bounded.

    One pass over all vectors without a shuffle of them: a batch sends on its best ``k`` of each query.
    """
    sampled = [(r["id"], r["v"]) for r in asked.collect()]
    ids, queries = [i for i, _ in sampled], padded([list(v) for _, v in sampled], rotations.dimension)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, vectors, bands, largest = [c.to_pylist() for c in batch.columns]
            if not keys:
                continue
            matrix, keys = padded(vectors, rotations.dimension), np.array(keys)
            products, out = matrix @ queries.T, []
            limits = np.array([x or float("inf") for x in largest]) * (1 + 1e-12)
            for j, own in enumerate(ids):
                scores = np.where(keys == own, -np.inf, products[:, j])
                order = np.argsort(-scores, kind="stable")
                nearest = order[np.sort(np.unique(keys[order], return_index=True)[1])]  # the best row of each key
                out += [(own, int(i), float(scores[i])) for i in nearest[:k + 1] if keys[i] != own][:k]
            rows = sorted({i for _, i, _ in out})
            found = dict(zip(rows, rotations.codes(matrix[rows], limits[rows], tables).tolist())) if rows else {}
            columns = ([o for o, _, _ in out], [int(keys[i]) for _, i, _ in out], [x for _, _, x in out],
                       [None if bands[i] == WHOLE else found[i] for _, i, _ in out])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["query_id", "vec_id", "score", "codes"])

    types = (pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int32()))
    near = in_bands.select("id", "v", "band", "largest").mapInArrow(best, "query_id long, vec_id long, score double, codes array<int>")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = near.groupBy("query_id", "vec_id").agg(F.max_by("codes", "score").alias("codes"), F.max("score").alias("score"))
    kept = once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "codes").collect()
    places = {own: queries[j] for j, own in enumerate(ids)}
    found: dict[int, list] = {}
    for r in kept:
        if r["codes"] is not None:
            found.setdefault(r["query_id"], []).append(r["codes"])
    return {own: (places[own], np.array(codes)) for own, codes in found.items()}


def fitted(found: dict, rotations: Rotations, tables: int, goal: float, n_stored: int, n_asked: int) -> tuple[int, int]:
    """The cheapest number of tables and of probes with which the share ``goal`` of the sampled neighbours is found, and
    two standard errors more, as the sample may be small."""
    if not found:
        return 1, 1
    needs = []  # for each neighbour and table, how many probes reach its bucket
    for query, codes in found.values():
        of_table = np.empty(codes.shape, np.int64)
        for _, tab, (order,) in rotations.orders(query[None, :], tables):
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(1, len(order) + 1)
            of_table[:, tab] = rank[codes[:, tab]]
        needs.append(of_table)
    reached = np.sort(np.minimum.accumulate(np.concatenate(needs), axis=1), axis=0)
    share = min(1.0, goal + 2 * (goal * (1 - goal) / len(reached)) ** 0.5)
    probes = reached[int(np.ceil(share * len(reached))) - 1]

    def cost(t: int) -> float:
        asked = t * int(probes[t - 1]) * n_asked
        return t * n_stored + asked + asked * n_stored / rotations.buckets / MOVED
    best = min(range(1, tables + 1), key=cost)
    return best, int(probes[best - 1])


def search(vectors: DataFrame, is_query: Column, k: int = 20, tables: int = 24, probes: int | None = None, block: int = 2048,
           key: str = "vec_id", vector: str = "embedding", goal: float = 0.96, sample: int = 64, crowd: int = 2048) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the ``k`` found nearest of each query row.

    ``is_query`` is a condition on ``id``; the candidates are all rows but the query's own key. Ties go to the smaller
    key; of repeated keys the largest score counts once. A query gets ``k`` rows, or all candidates if they are fewer.
    Without ``probes``, both it and the number of tables, ``tables`` at most, are chosen so that the share ``goal`` of the nearest of
    ``sample`` queries is found; with ``probes`` both are as given. A bucket is cut while it would hold over ``crowd`` vectors.
    Tables of fewer vectors than a hash table has buckets are searched exactly. Rows with a null key, and vectors that are null, zero or hold
    null or non-finite components take no part; shorter vectors count as ending in zeros. Other columns are left out.
    """
    kind = np.float32 if isinstance(vectors.schema[vector].dataType.elementType, FloatType) else np.float64
    good = stage(usable(vectors, key, vector), "vectors")
    shape = good.agg(F.max(F.size("v")), F.count(F.lit(1)), F.count_if(is_query)).first()
    dimension, n_stored, n_asked = shape[0] or 1, shape[1], shape[2]
    width = 1 << dimension.bit_length()
    rotations = Rotations(dimension, tables, 1 << max(0, -(-n_stored // (2 * width * crowd)) - 1).bit_length())
    in_bands, whole = banded(good, 2 * width)
    if probes is None:
        some = good.where(is_query).groupBy("id").agg(F.min("v").alias("v")).orderBy(F.xxhash64("id"), "id").limit(sample)
        tables, probes = fitted(sample_codes(in_bands, some, rotations, tables, k), rotations, tables, goal, n_stored, n_asked)
    stored = stage(stored_buckets(in_bands, rotations, tables, kind), "stored")
    asked = stage(asked_buckets(good.where(is_query), rotations, tables, probes, whole, kind), "asked")

    def n_blocks(size: int) -> Column:
        return F.ceil(F.count(F.lit(1)) / size).cast("int")
    blocks = stage(stored.groupBy("band", "tab", "axis").agg(n_blocks(block).alias("n_d")).join(
        asked.groupBy("tab", "axis").agg(n_blocks(max(1, block // 8)).alias("n_q")), ["tab", "axis"]), "blocks")
    found = met(asked.join(blocks, ["tab", "axis"]), stored.join(blocks, ["band", "tab", "axis"]), k, dimension, kind)
    best = stage(ranked(found, k), "best")

    least = min(k, good.select("id").distinct().count() - 1)
    enough = best.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    poor = stage(good.where(is_query).join(enough, F.col("id") == F.col("query_id"), "left_anti"), "poor")
    n_poor = poor.count() if least > 0 else 0
    if not n_poor:
        return best
    counts = {"band": 0, "tab": 0, "axis": 0, "n_d": -(-n_stored // block), "n_q": -(-n_poor // max(1, block // 8))}
    one = {c: F.lit(n) for c, n in counts.items()}
    rest = met(packed(poor, dimension, kind).withColumns(one), packed(good, dimension, kind).withColumns(one), k, dimension, kind)
    return ranked(best.select("query_id", "vec_id", "score").unionByName(rest), k)
