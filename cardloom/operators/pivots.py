"""Long-to-wide sums, combined before every shuffle."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cardloom.functions.clean import ratio
from cardloom.operators.aggregate import EXACT_SCALE, exact_sum


def pivot_values(df: DataFrame, column: str) -> list:
    """The sorted distinct values of a pivot column. Each becomes a column, so a wide table suits few values only;
    ``category_matrix`` keeps any number of them long."""
    return sorted(r[0] for r in df.where(F.col(column).isNotNull()).select(column).distinct().collect())


def value_name(column: str, value: object) -> str:
    """Column name of one pivot value; whole floats read as integers and no name carries a dot."""
    text = str(int(value)) if isinstance(value, float) and value.is_integer() else str(value)
    return f"{column}_{text}".replace(".", "_")


def sum_pivot(df: DataFrame, key: str, column: str, value: str, values: Sequence | None = None,
              name: Callable[[object], str] | None = None, count: bool = False, total: str | None = None,
              active: str | None = None, dealt: bool = False) -> DataFrame:
    """Sum (or count) of ``value`` per key with one zero-filled column per pivot value.

    Cells are summed in long form first, so a row updates one sum however many columns there are; the wide step
    then only places finished cells. A key's cells, one for each value at most, are brought together before it, or every
    task would hold a wide row of nearly every key; ``dealt`` says that a key's rows lie together already. ``total`` names a column for the sum of all cells, ``active`` one for their
    number (how many different periods a key is active in).
    """
    values = pivot_values(df, column) if values is None else values
    name = name or (lambda v: value_name(column, v))
    scale = EXACT_SCALE.get(value)
    amount = F.col(value) if scale is None else F.col(value).cast(f"decimal(18,{scale})")
    rows = df.where(F.col(key).isNotNull() & F.col(column).isNotNull())
    cells = rows.groupBy(key, column).agg((F.count(value) if count else F.sum(amount)).alias("_cell"))

    def placed(v: object) -> Column:
        cell = F.sum(F.when(F.col(column) == F.lit(v), F.col("_cell")))
        return F.coalesce(cell, F.lit(0)) if count else F.coalesce(cell.cast("double"), F.lit(0.0))

    extra = [F.sum("_cell").cast("double").alias(total)] if total else []
    extra += [F.count(F.lit(1)).alias(active)] if active else []
    return (cells if dealt else cells.repartition(F.col(key))).groupBy(key).agg(*[placed(v).alias(name(v)) for v in values], *extra)


def share_pivot(df: DataFrame, key: str, column: str, value: str, values: Sequence | None = None,
                prefix: str = "", dealt: bool = False) -> DataFrame:
    """Sums per pivot value and their shares of the key's total."""
    values = pivot_values(df, column) if values is None else values
    names = [f"{prefix}{value_name(column, v)}" for v in values]
    wide = sum_pivot(df, key, column, value, values, lambda v: f"{prefix}{value_name(column, v)}", total="_total", dealt=dealt)
    return wide.withColumns({f"{n}_ratio": ratio(F.col(n), F.col("_total")) for n in names}).drop("_total")


def category_matrix(df: DataFrame, key: str, category: str, value: str) -> DataFrame:
    """Card × category sums and counts, kept long: one row per pair that occurs."""
    rows = df.where(F.col(key).isNotNull() & F.col(category).isNotNull())
    return rows.groupBy(key, F.col(category).alias("category")).agg(
        exact_sum(F.col(value), EXACT_SCALE.get(value)).alias("amount"), F.count(value).alias("n"))


def month_columns(df: DataFrame, key: str, month: str, value: str, months: Sequence[int]) -> DataFrame:
    """One column per listed month; a month without rows stays missing."""
    return df.groupBy(key).agg(*[F.max(F.when(F.col(month) == m, F.col(value))).alias(f"{value}_{m}")
                                 for m in months])


def trend_ratios(df: DataFrame, value: str, trends: Sequence[tuple[Sequence[int], Sequence[int]]]) -> DataFrame:
    """Recent months over older months; each trend lists both month sets."""
    def total(months: Sequence[int]) -> Column:
        return sum((F.col(f"{value}_{m}") for m in months[1:]), F.col(f"{value}_{months[0]}"))
    return df.withColumns({f"{value}_ratio_{i}": ratio(total(new), total(old))
                           for i, (new, old) in enumerate(trends, start=1)})
