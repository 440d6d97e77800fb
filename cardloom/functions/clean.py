"""Column expressions that clean and encode single rows. All stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# The affine scale that undoes the published normalisation of purchase amounts.
AMOUNT_SCALE = 0.00150265118
AMOUNT_SHIFT = 497.06
AMOUNT_DIGITS = 2

# Code maps of the flag columns.
FLAG_CODES = {"Y": 1, "N": 0}
CATEGORY_3_CODES = {"A": 0, "B": 1, "C": 2}

# Fixed value: the mark that stands for an infinite quotient under the "mark" policy.
INFINITE_MARK = -9999


def below(column: Column, limit: float) -> Column:
    """1 when the value lies under ``limit``, else 0 (a missing value is not under it)."""
    return F.coalesce((column < limit).cast("int"), F.lit(0))


def replace_values(column: Column, mapping: Mapping[object, object]) -> Column:
    """Swap sentinel values; a ``None`` target makes the value missing."""
    return reduce(lambda rest, pair: F.when(column == F.lit(pair[0]), F.lit(pair[1])).otherwise(rest),
                  mapping.items(), column)


def code_map(column: Column, codes: Mapping[str, int]) -> Column:
    """Integer code of a listed value; anything else becomes missing."""
    return reduce(lambda rest, pair: F.when(column == F.lit(pair[0]), F.lit(pair[1])).otherwise(rest),
                  codes.items(), F.lit(None).cast("int"))


def clamp_above(column: Column, limit: float) -> Column:
    """The smaller of value and limit, where a missing value stays missing."""
    return F.when(column > limit, F.lit(limit)).otherwise(column)


def rescale(column: Column, scale: float = AMOUNT_SCALE, shift: float = AMOUNT_SHIFT,
            digits: int = AMOUNT_DIGITS) -> Column:
    """Undo an affine normalisation and round half to even."""
    return F.bround(column / F.lit(scale) + F.lit(shift), digits)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is missing where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def finite_ratio(numerator: Column, denominator: Column, policy: str = "zero") -> Column:
    """Quotient with a fill policy for what division by zero would make infinite.

    ``zero``: infinite -> 0, missing stays missing. ``missing``: infinite and missing -> 0 in the end.
    ``mark``: infinite -> -9999, then missing -> 0.
    """
    infinite = (denominator == 0) & (numerator != 0)
    quotient = ratio(numerator, denominator)
    if policy == "zero":
        return F.when(infinite, F.lit(0.0)).otherwise(quotient)
    if policy == "missing":
        return F.coalesce(quotient, F.lit(0.0))
    if policy == "mark":
        return F.when(infinite, F.lit(float(INFINITE_MARK))).otherwise(F.coalesce(quotient, F.lit(0.0)))
    raise ValueError(f"unknown policy {policy}")


def indicators(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """One 0/1 column per listed value."""
    return df.withColumns({f"{column}_{v}": F.coalesce((F.col(column) == F.lit(v)).cast("int"), F.lit(0))
                           for v in values})


def interaction(*columns: Column) -> Column:
    """Join the text forms of several columns with ``_``; a missing part reads ``nan``."""
    return F.concat_ws("_", *[F.coalesce(c.cast("string"), F.lit("nan")) for c in columns])


def negative_flag(column: Column) -> Column:
    return F.coalesce((column < 0).cast("int"), F.lit(0))


def interaction_keys() -> dict[str, Column]:
    """The five interaction keys of the transaction table."""
    c = F.col
    abroad = negative_flag(c("city_id"))
    return {
        "city_C1": interaction(abroad, c("category_1")),
        "C2_state": interaction(c("category_2"), c("state_id")),
        "C2_state_subsector": interaction(c("category_2"), c("state_id"), c("subsector_id")),
        "subsector_city": interaction(c("subsector_id"), abroad),
        "auth_C3": interaction(c("authorized_flag"), c("category_3")),
    }


def row_statistics(columns: Sequence[str]) -> dict[str, Column]:
    """Sum, mean, max, min and sample deviation across columns of one row.

    The sum and mean need every part; max, min and deviation skip missing parts, as row-wise reducers do.
    """
    parts = [F.col(c).cast("double") for c in columns]
    total = reduce(lambda a, b: a + b, parts)
    present = [F.when(p.isNotNull(), 1).otherwise(0) for p in parts]
    count = reduce(lambda a, b: a + b, present)
    mean = F.try_divide(reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0.0)) for p in parts]), count)
    squares = reduce(lambda a, b: a + b, [F.coalesce((p - mean) * (p - mean), F.lit(0.0)) for p in parts])
    return {
        "feature_sum": total,
        "feature_mean": total / len(parts),
        "feature_max": F.greatest(*parts),
        "feature_min": F.least(*parts),
        "feature_var": F.when(count > 1, F.sqrt(squares / (count - 1))),
    }


def clean_transactions(df: DataFrame, category_2: float, category_3: str, merchant: object,
                       installments: Mapping[int, object], cap: float | None = None) -> DataFrame:
    """Fill, replace, clamp and encode the raw transaction columns in one projection."""
    amount = F.col("purchase_amount")
    return df.withColumns({
        "category_2": F.coalesce("category_2", F.lit(category_2)),
        "category_3": code_map(F.coalesce("category_3", F.lit(category_3)), CATEGORY_3_CODES),
        "merchant_id": F.coalesce("merchant_id", F.lit(merchant)),
        "installments": replace_values(F.col("installments"), installments),
        "purchase_amount": amount if cap is None else clamp_above(amount, cap),
        "authorized_flag": code_map(F.col("authorized_flag"), FLAG_CODES),
        "category_1": code_map(F.col("category_1"), FLAG_CODES),
    })


def visit_scaled(df: DataFrame, value: str, visits: str, label: str) -> DataFrame:
    """A value per visit, per root of visits, and times log1p of visits."""
    v, n = F.col(value), F.col(visits)
    return df.withColumns({
        f"{value}_per_{label}": ratio(v, n),
        f"{value}_per_sqrt_{label}": ratio(v, F.sqrt(n)),
        f"{value}_log1p_{label}": v * F.log1p(n),
    })
