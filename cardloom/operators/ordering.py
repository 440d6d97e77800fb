"""Order-dependent work that stays balanced when one key owns a large share of the rows.

Ordinary groups use a plain window. A window puts a whole group into one task, so the rows of *hot* keys
(more rows than a task should hold) take another route: one global sort by key and order, which range
partitioning cuts into even pieces wherever a group is long, then work inside each piece, then a carry from
piece to piece. The carries number as many as the pieces, never as the rows.
"""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardloom.session import settle
from cardloom.sources.tables import stage

HOT_ROWS = 1_000_000
NEVER_HOT = sys.maxsize  # for callers that know no group is long: skips the detection
_PIECE, _POS = "_piece", "_pos"


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int | None = None) -> DataFrame | None:
    """Keys whose group is too long for one task, or ``None`` when there are none.

    Every key above the limit qualifies, however many there are. They are stored once, so Spark knows their size and
    broadcasts them only when they are few.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    if hot_rows == NEVER_HOT:
        return None
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = stage(counts.where(F.col("_n") > hot_rows).select(*keys), "hot_keys", freed=True)
    return None if hot.isEmpty() else hot


def same_keys(keys: Sequence[str], left: str, right: str) -> Column:
    """Null-safe equality of two aliased sides on all keys."""
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return condition


def split_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary keys, rows of hot keys."""
    condition = same_keys(keys, "l", "r")
    left, right = df.alias("l"), hot.alias("r")
    return left.join(right, condition, "left_anti"), left.join(right, condition, "left_semi")


def sorted_pieces(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Sort globally and number the rows by (piece, position in piece); materialised, hence stable.

    Rows that are equal in ``order`` are told apart by their place in ``df``, so that any number of repeats spreads over the
    pieces. ``df`` is a scan or stored, or has no such rows: a retried task must find the same places."""
    numbered = (df.withColumn("_tie", F.monotonically_increasing_id()).sort(*order, "_tie").drop("_tie")
                .withColumn("_id", F.monotonically_increasing_id()))
    return (settle(numbered)
            .withColumn(_PIECE, F.shiftright("_id", 33))
            .withColumn(_POS, F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("_id"))


def _carry(pieces: DataFrame, aggregates: Mapping[str, Column]) -> DataFrame:
    """Per-piece aggregates; one row per piece, so a single-task window over them is small."""
    return pieces.groupBy(_PIECE).agg(*[c.alias(n) for n, c in aggregates.items()])


def _attach_carry(pieces: DataFrame, carry: DataFrame) -> DataFrame:
    """One carry row per sort piece: the piece count is a Spark setting, not a function of the data."""
    return pieces.join(F.broadcast(carry), _PIECE, "left")


def global_index(df: DataFrame, order: Sequence[str | Column], name: str = "index") -> DataFrame:
    """Zero-based position of each row in a total order, without a single-task window over the rows."""
    pieces = sorted_pieces(df, order)
    before = Window.orderBy(_PIECE).rowsBetween(Window.unboundedPreceding, -1)
    carry = _carry(pieces, {"_rows": F.count(F.lit(1))}).select(
        _PIECE, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    return (_attach_carry(pieces, carry)
            .withColumn(name, F.col("_offset") + F.col(_POS)).drop("_offset", _PIECE, _POS))


def running_totals(df: DataFrame, order: Sequence[str | Column], totals: Mapping[str, str]) -> DataFrame:
    """Inclusive running sums of columns along a total order; ``totals`` maps new name to source column."""
    pieces = sorted_pieces(df, order)
    before = Window.orderBy(_PIECE).rowsBetween(Window.unboundedPreceding, -1)
    sums = _carry(pieces, {f"_s_{n}": F.sum(c) for n, c in totals.items()})
    carry = sums.select(_PIECE, *[F.coalesce(F.sum(f"_s_{n}").over(before), F.lit(0)).alias(f"_o_{n}")
                                  for n in totals])
    inside = Window.partitionBy(_PIECE).orderBy(_POS).rowsBetween(Window.unboundedPreceding, 0)
    return (_attach_carry(pieces, carry)
            .withColumns({n: F.col(f"_o_{n}") + F.sum(c).over(inside) for n, c in totals.items()})
            .drop(_PIECE, _POS, *[f"_o_{n}" for n in totals]))


def previous_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                      columns: Mapping[str, str], hot_rows: int | None = None,
                      hot: DataFrame | None = None) -> DataFrame:
    """Value of the previous row of the same group; ``columns`` maps new name to source column.

    The first row of a group has no previous value. Pass ``hot`` to reuse one detection for many calls.
    """
    hot = hot if hot is not None else hot_keys(df, keys, hot_rows)
    window = Window.partitionBy(*keys).orderBy(*order)

    def plain(rows: DataFrame) -> DataFrame:
        return rows.withColumns({n: F.lag(c).over(window) for n, c in columns.items()})

    if hot is None:
        return plain(df)
    cold, heavy = split_hot(df, keys, hot)
    return plain(cold).unionByName(_previous_by_pieces(heavy, keys, order, columns))


def _previous_by_pieces(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                        columns: Mapping[str, str]) -> DataFrame:
    pieces = sorted_pieces(df, [*keys, *order])
    inside = Window.partitionBy(_PIECE).orderBy(_POS)
    record = F.struct(*[F.col(k).alias(f"k_{k}") for k in keys],
                      *[F.col(c).alias(f"v_{n}") for n, c in columns.items()])
    last = _carry(pieces, {"_last": F.max_by(record, _POS)})
    carry = last.select(_PIECE, F.lag("_last").over(Window.orderBy(_PIECE)).alias("_carried"))
    linked = _attach_carry(pieces, carry).withColumn(
        "_prev", F.coalesce(F.lag(record).over(inside), F.col("_carried")))
    same = F.col("_prev").isNotNull()
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_prev.k_{k}"))
    return (linked.withColumns({n: F.when(same, F.col(f"_prev.v_{n}")) for n in columns})
            .drop("_prev", "_carried", _PIECE, _POS))


def position_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "position",
                      hot_rows: int | None = None, hot: DataFrame | None = None) -> DataFrame:
    """One-based position of a row in its ordered group."""
    hot = hot if hot is not None else hot_keys(df, keys, hot_rows)
    window = Window.partitionBy(*keys).orderBy(*order)
    if hot is None:
        return df.withColumn(name, F.row_number().over(window).cast("bigint"))
    cold, heavy = split_hot(df, keys, hot)
    indexed = global_index(heavy, [*keys, *order], "_g")
    starts = indexed.groupBy(*keys).agg(F.min("_g").alias("_start"))  # one row per hot key
    placed = (indexed.alias("l").join(starts.alias("r"), same_keys(keys, "l", "r"))
              .select("l.*", F.col("r._start").alias("_start"))
              .withColumn(name, F.col("_g") - F.col("_start") + 1).drop("_g", "_start"))
    return cold.withColumn(name, F.row_number().over(window).cast("bigint")).unionByName(placed)


def hot_medians(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Exact interpolated medians of long groups by rank, one row per key, columns ``_median_{column}``.

    Values are counted first, so repeats collapse before the sort; the running count then locates the two
    middle ranks without holding a group anywhere.
    """
    long = (df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_v")) for c in columns])).alias("_e"))
        .select(*keys, "_e._col", "_e._v").where(F.col("_v").isNotNull()))
    group = [*keys, "_col"]
    freq = long.groupBy(*group, "_v").agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_totals(freq, [*group, "_v"], {"_cum": "_n"})
    totals = ranked.groupBy(*group).agg(F.sum("_n").alias("_total"),
                                        F.min(F.col("_cum") - F.col("_n")).alias("_base"))
    placed = (ranked.alias("l").join(totals.alias("r"), same_keys(group, "l", "r"))
              .select("l.*", "r._total", "r._base"))
    start, stop = F.col("_cum") - F.col("_n") - F.col("_base"), F.col("_cum") - F.col("_base")
    low, high = F.floor((F.col("_total") - 1) / 2), F.floor(F.col("_total") / 2)
    middle = placed.groupBy(*group).agg(
        F.max(F.when((start <= low) & (low < stop), F.col("_v"))).alias("_lo"),
        F.max(F.when((start <= high) & (high < stop), F.col("_v"))).alias("_hi"))
    value = (F.col("_lo") + F.col("_hi")) / 2
    return middle.groupBy(*keys).agg(*[F.max(F.when(F.col("_col") == c, value)).alias(f"_median_{c}")
                                       for c in columns])
