"""Factorisation of the long key × category table.

Both factors are DataFrames: one row of numbers for each key, one for each category. The matrix stays as it is stored, a row
for each cell that occurs; its products with a factor are joins and grouped sums, which combine before they are shuffled. The
driver sees only matrices as wide as a factor, never one as long as the keys or the categories.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from cardloom.operators.folds import HASH_RANGE, key_hash
from cardloom.operators.ordering import global_index
from cardloom.session import remove_path, stage_path
from cardloom.sources.tables import stage

FLOOR = 1e-9  # the least loading of a non-negative factor
STRIP = 256  # rows that meet at a time
Frames = Iterator[pd.DataFrame]


@dataclass
class Factors:
    scores: DataFrame  # the key, then a column for each component
    loadings: DataFrame  # ``category`` and the same columns
    sizes: list[float]  # residual norm after each round, or singular values


# --- products -----------------------------------------------------------------------------------------------------------

def matrix(cells: DataFrame, key: str, category: str, value: str) -> DataFrame:
    """(``k``, ``c``, ``x``), held by key: the products of all rounds find the cells of a key in one place."""
    rows = cells.where(F.col(key).isNotNull() & F.col(category).isNotNull()).select(
        F.col(key).alias("k"), F.col(category).alias("c"), F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("x"))
    return rows.repartition(int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions")), "k").persist()


def product(a: DataFrame, factor: DataFrame, side: str, other: str, width: int) -> DataFrame:
    """(``other``, array ``g``): the matrix times a factor by category (``side`` ``c``), its transpose times one by key."""
    met = a.join(factor.select(side, "f"), side)
    return met.groupBy(other).agg(F.array(*[F.sum(F.col("x") * F.get("f", F.lit(i))) for i in range(width)]).alias("g"))


def small_product(table: DataFrame, left: str, right: str) -> np.ndarray:
    """leftᵀ right of two array columns. Tasks add up their own rows, so little is shuffled, whatever the table's length."""
    cells = table.select(F.col(left).alias("l"), F.col(right).alias("r")).mapInPandas(_crossed, "i int, j int, v double")
    found = cells.groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    made = np.zeros((found["i"].max() + 1, found["j"].max() + 1))
    made[found["i"], found["j"]] = found["v"]
    return made


def _rows(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list())


def _crossed(batches: Frames) -> Frames:
    total = None
    for batch in batches:
        made = _rows(batch["l"]).T @ _rows(batch["r"])
        total = made if total is None else total + made
    if total is not None:
        i, j = np.indices(total.shape, dtype="int32")
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "v": total.ravel()})


def _mapped(batches: Frames, make: Callable[[pd.DataFrame], np.ndarray], name: str, keep: list[str]) -> Frames:
    for batch in batches:
        if len(batch):
            yield batch[keep].assign(**{name: list(make(batch))})


def with_rows(table: DataFrame, make: Callable[[pd.DataFrame], np.ndarray], name: str, *keep: str) -> DataFrame:
    """``keep`` and an array column that ``make`` gives for batches of rows."""
    kept = [f"`{c}` {table.schema[c].dataType.simpleString()}" for c in keep]
    return table.mapInPandas(partial(_mapped, make=make, name=name, keep=list(keep)), ", ".join([*kept, f"`{name}` array<double>"]))


def _named(table: DataFrame, column: str, name: str, array: str, prefix: str, width: int) -> DataFrame:
    return table.select(F.col(column).alias(name), *[F.get(array, F.lit(i)).alias(f"{prefix}_{i}") for i in range(width)])


# --- non-negative factors -----------------------------------------------------------------------------------------------

def first_guess(column: str, seed: int, components: int, scale: float) -> Column:
    """Uniform numbers from a hash, so that a retried task, and SQL, draw the same."""
    return F.array(*[key_hash(column, seed + i) / F.lit(float(HASH_RANGE)) * F.lit(scale) + F.lit(FLOOR) for i in range(components)])


def _better(old: np.ndarray, f: np.ndarray, g: np.ndarray, gram: np.ndarray, sweeps: int, ahead: float) -> np.ndarray:
    """Rows of one factor, each component in turn at its best given the others and the other factor, and beside them rows
    that go ``ahead`` of this step by a share of it."""
    for _ in range(sweeps):
        for i in range(len(gram)):
            f[:, i] = np.maximum(f[:, i] + (g[:, i] - f @ gram[:, i]) / max(gram[i, i], FLOOR), FLOOR)
    return np.hstack([f, np.maximum(f + ahead * (f - old), FLOOR)])


def _improved(batch: pd.DataFrame, gram: np.ndarray, sweeps: int, ahead: float) -> np.ndarray:
    return _better(_rows(batch["n"]), _rows(batch["f"]), _rows(batch["g"]), gram, sweeps, ahead)


# --- rows that carry their cells ----------------------------------------------------------------------------------------

FEW = 2048  # categories up to this number: a key's cells lie in its row, and tasks are given the categories' factor


def packed(a: DataFrame, codes: DataFrame) -> DataFrame:
    """(``k``, ``j``, ``x``): each key with the numbers and values of its cells, at most one for each category."""
    cells = a.join(F.broadcast(codes), "c").groupBy("k", "j").agg(F.sum("x").alias("x"))
    row = F.collect_list(F.struct("j", "x")).alias("l")
    return cells.groupBy("k").agg(row).select("k", F.col("l.j").alias("j"), F.col("l.x").alias("x"))


def _cells(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all cells of a batch: the row, the category's number and the value."""
    owner = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column("j")).to_numpy(zero_copy_only=False))
    return owner, *(batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in "jx")


def _factor(batch: pa.RecordBatch, column: str, width: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _keys_improved(batches: Iterator[pa.RecordBatch], other: np.ndarray, gram: np.ndarray, sweeps: int, ahead: float) -> Iterator[pa.RecordBatch]:
    """As ``_improved``, for rows with their cells, which stay beside them. ``other`` is the categories' factor."""
    r = len(gram)
    for batch in batches:
        if batch.num_rows:
            owner, j, x = _cells(batch)
            g = np.stack([np.bincount(owner, x * other[j, i], batch.num_rows) for i in range(r)], axis=1)
            made = _better(_factor(batch, "n", r), _factor(batch, "f", r).copy(), g, gram, sweeps, ahead)
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(made) + 1, dtype="int32") * r), pa.array(np.ravel(part)))
                     for part in (made[:, :r], made[:, r:])]
            yield pa.RecordBatch.from_arrays([batch.column("k"), *lists, batch.column("j"), batch.column("x")], ["k", "n", "f", "j", "x"])


def _category_sums(batches: Iterator[pa.RecordBatch], m: int, r: int) -> Iterator[pa.RecordBatch]:
    """The matrix's transpose times the keys' factor, a row for each category; under the numbers from ``m`` on, the factor's Gram matrix."""
    total = np.zeros((m + r, r))
    for batch in batches:
        if batch.num_rows:
            (owner, j, x), f = _cells(batch), _factor(batch, "f", r)
            total[:m] += np.stack([np.bincount(j, x * f[owner, i], m) for i in range(r)], axis=1)
            total[m:] += f.T @ f
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(m + r, dtype="int32")), pa.array(list(total), pa.list_(pa.float64()))], ["j", "g"])


AHEAD, FASTER, SLOWER = 0.5, 1.05, 1.5


def nmf(cells: DataFrame, key: str, category: str, value: str, components: int = 10, rounds: int = 200, tolerance: float = 1e-4,
        sweeps: int = 4, seed: int = 42, prefix: str = "nmf", few: int = FEW) -> Factors:
    """Non-negative factors by alternating least squares, a component at a time, with extrapolated steps.

    A round improves the keys' factor, then the categories', each from rows that run ahead of its last step (``f`` beside the
    factor ``n``). A round that makes the residual larger is taken back and goes on from the factors themselves, running less
    far ahead; so of both factors two generations are kept, and older ones are removed. Rounds end when the residual norm falls
    by less than ``tolerance`` of its first value, or after ``rounds``. Keys and categories without a name are left out;
    missing values count as zero.

    With at most ``few`` categories a key's cells lie in its row, and a round is two passes over those rows that shuffle only sums
    by category; with more, cells and factors meet in joins.
    """
    spark, r = cells.sparkSession, components
    a = matrix(cells, key, category, value)
    mass, square, n, m = a.agg(F.sum("x"), F.sum(F.col("x") * F.col("x")), F.count_distinct("k"), F.count_distinct("c")).first()
    scale = float(np.sqrt((mass or 0.0) / max(n * m, 1) / r))
    paths: dict[int, list[str]] = {}

    def stored(table: DataFrame, column: str, generation: int) -> DataFrame:
        path = stage_path(spark, "nmf")
        paths.setdefault(generation, []).append(path)
        split = [F.slice("nf", 1 + i * r, r).alias(c) for i, c in enumerate("nf")] if "nf" in table.columns else ["n", "f"]
        return stage(table.select(column, *split, *[c for c in table.columns if c in ("g", "j", "x")]), "nmf", path)

    def guessed(rows: DataFrame, column: str, first_seed: int) -> DataFrame:
        guess = first_guess(column, first_seed, r, scale)
        return stored(rows.withColumn("nf", F.concat(guess, guess)), column, 0)

    in_rows = 0 < m <= few
    keys = a.select("k").distinct()
    if in_rows:
        codes = stage(global_index(a.select("c").distinct(), ["c"], "j").select("c", F.col("j").cast("int").alias("j")), "codes")
        keys = packed(a, codes)
    w, h = guessed(keys, "k", seed), guessed(a.select("c").distinct(), "c", seed + r)
    if in_rows:
        a.unpersist()

    def key_step(**how: float) -> DataFrame:
        if not in_rows:
            return with_rows(w.join(product(a, h, "c", "k", r), "k"), partial(_improved, gram=hh, **how), "nf", "k")
        found = h.join(codes, "c").select("j", "f").toPandas().sort_values("j")  # at most ``few`` rows
        return w.select(*"knfjx").mapInArrow(partial(_keys_improved, other=_rows(found["f"]), gram=hh, **how), w.select(*"knfjx").schema)

    def category_sums() -> tuple[np.ndarray, DataFrame]:
        """The Gram matrix of the keys' new factor, and its products with the categories' cells."""
        if not in_rows:
            return small_product(new_w, "f", "f"), product(a, new_w, "k", "c", r)
        parts = new_w.select(*"fjx").mapInArrow(partial(_category_sums, m=m, r=r), "j int, g array<double>")
        sums = stage(parts.groupBy("j").agg(F.array(*[F.sum(F.get("g", F.lit(i))) for i in range(r)]).alias("g")), "sums")
        return _rows(sums.where(F.col("j") >= m).orderBy("j").toPandas()["g"]), sums.join(codes, "j").select("c", "g")

    residuals: list[float] = []
    ahead, good = AHEAD, 0  # ``good`` is the last generation that was not taken back
    if n:
        hh = plain_hh = small_product(h, "f", "f")
    for now in range(1, rounds + 1 if n else 1):
        step = partial(_improved, sweeps=sweeps, ahead=ahead)
        new_w = stored(key_step(sweeps=sweeps, ahead=ahead), "k", now)
        ww, met = category_sums()
        new_h = stored(with_rows(h.select("c", "n", "f").join(met, "c"), partial(step, gram=ww), "nf", "c", "g"), "c", now)
        sums = small_product(new_h.withColumns({"nf": F.concat("n", "f"), "nfg": F.concat("n", "f", "g")}), "nf", "nfg")
        residual = float(np.sqrt(max(square - 2 * np.trace(sums[:r, 2 * r:]) + np.sum(ww * sums[:r, :r]), 0.0)))
        if residuals and residual > residuals[-1]:
            ahead /= SLOWER
            w, h, hh = w.withColumn("f", F.col("n")), h.withColumn("f", F.col("n")), plain_hh
            gone = now
        else:
            ahead, gone, good = min(1.0, ahead * FASTER), good, now
            w, h, hh, plain_hh = new_w, new_h, sums[r:, r:2 * r], sums[:r, :r]
            residuals.append(residual)
        for path in paths.pop(gone):
            remove_path(spark, path)
        if gone != now and len(residuals) > 1 and residuals[-2] - residuals[-1] < tolerance * residuals[0]:
            break
    a.unpersist()
    return Factors(_named(w, "k", key, "n", prefix, r), _named(h, "c", "category", "n", prefix, r), residuals)


# --- singular vectors ---------------------------------------------------------------------------------------------------

def _triangle(batches: Frames) -> Frames:
    """R of a QR decomposition of all rows of a task."""
    r = None
    for batch in batches:
        if len(batch):
            rows = _rows(batch["z"])
            r = np.linalg.qr(rows if r is None else np.vstack([r, rows]), mode="r")
    if r is not None:
        yield pd.DataFrame({"z": list(r)})


def tall_triangle(table: DataFrame) -> np.ndarray:
    """R of a QR decomposition of the array column ``z`` of a long table: by tasks, by groups of tasks, then at the end."""
    parts = table.select("z").mapInPandas(_triangle, "z array<double>")
    fewer = max(int(np.sqrt(parts.rdd.getNumPartitions())), 1)
    rows = parts.coalesce(fewer).mapInPandas(_triangle, "z array<double>").toPandas()
    return np.linalg.qr(_rows(rows["z"]), mode="r")


def _without(batch: pd.DataFrame, weights: np.ndarray) -> np.ndarray:
    return _rows(batch["g"]) - _rows(batch["v"]) @ weights


def _extended(batch: pd.DataFrame, weights: np.ndarray, turn: np.ndarray) -> np.ndarray:
    return np.hstack([_rows(batch["v"]), _without(batch, weights) @ turn])


def _turned(batch: pd.DataFrame, turn: np.ndarray, column: str) -> np.ndarray:
    return _rows(batch[column]) @ turn


def _normal(r: np.ndarray, floor: float) -> np.ndarray:
    """What turns rows with triangle ``r`` into orthonormal columns; directions below ``floor`` are left out."""
    _, s, vt = np.linalg.svd(r)
    return vt[s > floor].T / s[s > floor]


class StoredBasis:
    """A Krylov basis as a table, with a row for each category; cells and factors meet in joins."""

    def __init__(self, a: DataFrame, block: int, seed: int) -> None:
        self.a, self.start = a, stage(_start(a, block, seed), "krylov")

    def begin(self) -> int:
        turn = _normal(tall_triangle(self.start), 1e-12)
        self.state = stage(with_rows(self.start, partial(_turned, turn=turn, column="z"), "v", "c"), "krylov")
        return turn.shape[1]

    def step(self, p: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the matrix's transpose times it times the newest block: the part along the basis, and the triangle of the rest."""
        newest = self.state.select("c", F.slice("v", p - last + 1, last).alias("f"))
        y = product(self.a, newest, "c", "k", last).withColumnRenamed("g", "f")
        self.met = stage(self.state.join(product(self.a, y, "k", "c", last), "c"), "krylov")
        weights = small_product(self.met, "v", "g")
        cleaned = with_rows(self.met, partial(_without, weights=weights), "g", "c", "v")
        self.weights = weights + small_product(cleaned, "v", "g")
        return self.weights, tall_triangle(with_rows(self.met, partial(_without, weights=self.weights), "z"))

    def grow(self, turn: np.ndarray) -> None:
        self.state = stage(with_rows(self.met, partial(_extended, weights=self.weights, turn=turn), "v", "c"), "krylov")

    def restart(self, turn: np.ndarray) -> None:
        self.state = stage(with_rows(self.state, partial(_turned, turn=turn, column="v"), "v", "c"), "krylov")

    def results(self, turn: np.ndarray) -> tuple[DataFrame, DataFrame]:
        """(``k``, ``g``) and (``c``, ``f``)."""
        loadings = stage(with_rows(self.state, partial(_turned, turn=turn, column="v"), "f", "c"), "loadings")
        scores = stage(product(self.a, loadings, "c", "k", turn.shape[1]), "scores")
        self.a.unpersist()
        return scores, loadings


class HeldBasis:
    """The same basis on the driver, for few categories: a round is one pass over rows that carry their cells."""

    def __init__(self, a: DataFrame, block: int, seed: int) -> None:
        start = _start(a, block, seed).withColumn("j", F.row_number().over(Window.orderBy("c")) - 1)  # few rows
        self.codes = stage(start, "codes")
        self.rows = stage(packed(a, self.codes.select("c", "j")), "rows")
        a.unpersist()

    def begin(self) -> int:
        start = _rows(self.codes.select("j", "z").toPandas().sort_values("j")["z"])
        self.v = start @ _normal(np.linalg.qr(start, mode="r"), 1e-12)
        return self.v.shape[1]

    def step(self, p: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        m = len(self.v)
        sums = self.rows.select("j", "x").mapInArrow(partial(_there_and_back, f=self.v[:, p - last:p].copy()), "j int, g array<double>")
        found = sums.groupBy("j").agg(F.array(*[F.sum(F.get("g", F.lit(i))) for i in range(last)]).alias("g")).toPandas()
        g = np.zeros((m, last))
        g[found["j"]] = _rows(found["g"])
        weights = self.v.T @ g
        weights += self.v.T @ (g - self.v @ weights)
        self.rest = g - self.v @ weights
        return weights, np.linalg.qr(self.rest, mode="r")

    def grow(self, turn: np.ndarray) -> None:
        self.v = np.hstack([self.v, self.rest @ turn])

    def restart(self, turn: np.ndarray) -> None:
        self.v = self.v @ turn

    def results(self, turn: np.ndarray) -> tuple[DataFrame, DataFrame]:
        f, key = self.v @ turn, f"`k` {self.rows.schema['k'].dataType.simpleString()}"
        listed = pa.table({"j": pa.array(np.arange(len(f), dtype="int32")), "f": _lists(f)})
        loadings = self.codes.select("c", "j").join(F.broadcast(self.rows.sparkSession.createDataFrame(listed)), "j").select("c", "f")
        return self.rows.mapInArrow(partial(_scored, f=f), f"{key}, `g` array<double>"), loadings


def _start(a: DataFrame, block: int, seed: int) -> DataFrame:
    return a.select("c").distinct().select("c", F.transform(first_guess("c", seed, block, 1.0), lambda x: x - 0.5).alias("z"))


def _lists(rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype="int32") * rows.shape[1]), pa.array(np.ravel(rows)))


FULL = 1 / 16  # strips with a greater share of cells are multiplied as dense ones


def _strips(batch: pa.RecordBatch, m: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int, bool]]:
    """Owners, numbers and values of the cells of at most ``STRIP`` rows at a time, the number of these rows, and whether they are full."""
    for at in range(0, batch.num_rows, STRIP):
        strip = batch.slice(at, STRIP)
        owner, j, x = _cells(strip)
        yield owner, j, x, strip.num_rows, len(x) > FULL * strip.num_rows * m


def _times(f: np.ndarray, owner: np.ndarray, j: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    """Rows with these cells times a factor by category."""
    return np.stack([np.bincount(owner, x * f[j, i], n) for i in range(f.shape[1])], axis=1)


def _there_and_back(batches: Iterator[pa.RecordBatch], f: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The transpose of a task's rows times these rows times ``f``, a row for each category."""
    m, total = len(f), np.zeros(f.shape)
    for batch in batches:
        for owner, j, x, n, full in _strips(batch, m):
            if full:
                a = np.zeros((n, m))
                a[owner, j] = x
                total += a.T @ (a @ f)
            else:
                y = _times(f, owner, j, x, n)
                total += np.stack([np.bincount(j, x * y[owner, i], m) for i in range(f.shape[1])], axis=1)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(m, dtype="int32")), _lists(total)], ["j", "g"])


def _scored(batches: Iterator[pa.RecordBatch], f: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Each key's cells times ``f``."""
    for batch in batches:
        if batch.num_rows:
            made = np.vstack([_times(f, owner, j, x, n) for owner, j, x, n, _ in _strips(batch, len(f))])
            yield pa.RecordBatch.from_arrays([batch.column("k"), _lists(made)], ["k", "g"])


HELD = 16_384 * 320  # numbers of a basis that the driver may hold, 42 MB


def svd(cells: DataFrame, key: str, category: str, value: str, components: int = 10, prefix: str = "svd",
        tolerance: float = 1e-9, rounds: int = 60, widest: int = 320, seed: int = 42, held: int = 0) -> Factors:
    """Scores of the first right singular vectors, by a block Krylov method with random start; signs are free.

    The basis has a row for each category. A round multiplies its newest block by the matrix and its transpose, takes out
    what the basis already has (twice, for rounding errors), and adds what is left, made orthonormal by a tall-skinny QR. It
    ends when the wanted vectors have a residual below ``tolerance`` of the largest eigenvalue, when the basis has all
    directions, or after ``rounds``. A basis of ``widest`` columns starts again from its best vectors.

    A basis of at most ``held`` numbers (``HELD`` fits) lies on the driver, and a round is one pass over rows that carry their cells. A
    larger one stays a table, and the driver sees widest × widest numbers at most.
    """
    a = matrix(cells, key, category, value)
    m = a.select("c").distinct().count()
    components = min(components, m)
    if m == 0:
        a.unpersist()
        return Factors(_named(a.select("k").where("false").withColumn("f", F.array().cast("array<double>")), "k", key, "f", prefix, 0),
                       _named(a.select("c").where("false").withColumn("f", F.array().cast("array<double>")), "c", "category", "f", prefix, 0), [])
    block = min(components + 10, m)
    basis = (HeldBasis if m * max(block, widest) <= held else StoredBasis)(a, block, seed)
    widths = [basis.begin()]
    projected = np.zeros((0, 0))
    for _ in range(rounds):
        p, last = sum(widths), widths[-1]
        weights, rest = basis.step(p, last)
        grown = np.zeros((p, p))
        grown[:len(projected), :len(projected)] = projected
        grown[:, p - last:] = weights
        grown[p - last:, :] = weights.T
        projected = (grown + grown.T) / 2
        values, vectors = np.linalg.eigh(projected)
        values, vectors = values[::-1], vectors[:, ::-1]
        left = np.linalg.norm(rest @ vectors[p - last:, :components], axis=0).max()
        turn = _normal(rest, 1e-11 * max(values[0], 1e-300))
        if left <= tolerance * values[0] or turn.shape[1] == 0 or p >= m:
            break
        if p + turn.shape[1] > widest:
            basis.restart(vectors[:, :block])
            widths, projected = [min(block, p)], np.zeros((0, 0))
        else:
            basis.grow(turn)
            widths.append(turn.shape[1])
    scores, loadings = basis.results(vectors[:, :components])
    return Factors(_named(scores, "k", key, "g", prefix, components), _named(loadings, "c", "category", "f", prefix, components),
                   [float(x) for x in np.sqrt(np.maximum(values[:components], 0.0))])


# --- inner products of categories ---------------------------------------------------------------------------------------

TILE = 256  # columns of a tile


def _tiles(batches: Frames) -> Frames:
    """Inner products of the category columns, tile by tile, added up over the rows of a task."""
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for at in range(0, len(batch), STRIP):
            lists, values = batch["j"].iloc[at:at + STRIP].to_list(), batch["x"].iloc[at:at + STRIP].to_list()
            owner = np.repeat(np.arange(len(lists)), [len(j) for j in lists])
            j, x, strips = np.concatenate(lists), np.concatenate(values), {}
            for t in np.unique(j // TILE).tolist():
                here, strip = j // TILE == t, np.zeros((len(lists), TILE))
                strip[owner[here], j[here] % TILE] = x[here]
                strips[t] = strip
            for s in strips:
                for t in strips:
                    if s <= t:
                        made = strips[s].T @ strips[t]
                        sums[s, t] = made if (s, t) not in sums else sums[s, t] + made
            if len(sums) > 512:  # a quarter of a gigabyte
                yield _long_tiles(sums)
                sums = {}
    if sums:
        yield _long_tiles(sums)


def _long_tiles(sums: dict[tuple[int, int], np.ndarray]) -> pd.DataFrame:
    parts = []
    for (s, t), tile in sums.items():
        i, j = np.nonzero(tile)
        parts.append(pd.DataFrame({"i": s * TILE + i, "j": t * TILE + j, "v": tile[i, j]}))
    return pd.concat(parts)


def gram(cells: DataFrame, key: str, category: str, value: str) -> DataFrame:
    """(``category_a``, ``category_b``, ``product``): inner products of all categories that share a key.

    Rows of the matrix go through tasks as they are, sparse; a task adds up tiles of categories × categories, and only
    their sums are shuffled. The result stays long: no category list and no matrix comes to the driver."""
    a = matrix(cells, key, category, value)
    codes = stage(global_index(a.select("c").distinct(), ["c"], "j"), "codes")
    rows = a.join(codes, "c").groupBy("k").agg(F.collect_list(F.struct("j", "x")).alias("l")).select(F.col("l.j").alias("j"), F.col("l.x").alias("x"))
    upper = stage(rows.mapInPandas(_tiles, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("product")), "tiles")
    a.unpersist()
    both = upper.unionByName(upper.where((F.floor(F.col("i") / TILE) < F.floor(F.col("j") / TILE))).select(
        F.col("j").alias("i"), F.col("i").alias("j"), "product"))
    return (both.join(codes.select(F.col("c").alias("category_a"), F.col("j").alias("i")), "i")
            .join(codes.select(F.col("c").alias("category_b"), "j"), "j").select("category_a", "category_b", "product"))
