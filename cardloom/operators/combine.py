"""Features made from history and new-period columns of one card row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from cardloom.functions.clean import ratio
from cardloom.functions.dates import BASE_DATE, floor_days, timestamp
from cardloom.operators.aggregate import Spec, attach, multi_agg
from cardloom.operators.joins import full_outer
from cardloom.operators.ratios import history, recent

PERIODS = ("hist", "new")

# Fixed value: guard of the systematic quotient new / (|hist| + guard).
PAIR_GUARD = 0.01


def period_table(rows: DataFrame, key: str, spec: Spec, **options) -> DataFrame:
    """``hist_*`` and ``new_*`` statistics per key; a period without rows leaves all its columns missing.

    The two periods share no row, so each is filtered and aggregated for itself (the filter reaches the scan)
    and the results, partitioned by the same key, meet in a full outer join.
    """
    parts = {"hist_": history(), "new_": recent()}
    return full_outer([key], *[multi_agg(rows.where(where), [key], spec, prefix, **options) for prefix, where in parts.items()])


def span_features(df: DataFrame, prefix: str, as_of: str, ts: str = "purchase_date", size: str = "card_id_size") -> DataFrame:
    """Days between first and last purchase, per purchase, and days from either to ``as_of``."""
    first, last = F.col(f"{prefix}{ts}_min"), F.col(f"{prefix}{ts}_max")
    diff = floor_days(last, first)
    return df.withColumns({
        f"{prefix}{ts}_diff": diff,
        f"{prefix}{ts}_average": ratio(diff, F.col(f"{prefix}{size}")),
        f"{prefix}{ts}_uptonow": floor_days(timestamp(as_of), last),
        f"{prefix}{ts}_uptomin": floor_days(timestamp(as_of), first),
    })


def active_month_gaps(df: DataFrame, ts: str = "purchase_date") -> DataFrame:
    """Days from the first active month to the first and last purchase of each period."""
    month = F.col("first_active_month")
    return df.withColumns({f"{p}_{name}_buy": floor_days(F.col(f"{p}_{ts}_{end}"), month)
                           for p in PERIODS for name, end in (("first", "min"), ("last", "max"))})


def purchase_spans(cards: DataFrame, rows: DataFrame, base: str = BASE_DATE) -> DataFrame:
    """Calendar-day gaps among first and last purchases, the base date and the first active month."""
    ends = rows.groupBy("card_id").agg(*[
        f(F.when(where, F.col("purchase_date"))).cast("date").alias(f"_{p}_{e}")
        for p, where in (("hist", history()), ("new", recent())) for e, f in (("first", F.min), ("last", F.max))])
    table = attach(cards.select("card_id", "first_active_month"), ends, ["card_id"])
    origin, month = F.lit(base).cast("date"), F.col("first_active_month")
    made = {}
    for p in PERIODS:
        for e in ("first", "last"):
            made[f"{p}_{e}_to_base_time"] = F.datediff(f"_{p}_{e}", origin)
            made[f"{p}_{e}_to_active_time"] = F.datediff(f"_{p}_{e}", month)
        made[f"{p}_last_to_first_time"] = F.datediff(f"_{p}_last", f"_{p}_first")
    made["new_to_hist_time"] = F.datediff("_new_first", "_hist_last")
    return table.select("card_id", *[c.alias(n) for n, c in made.items()])


def per_day(df: DataFrame, ts: str, columns: Mapping[str, str]) -> DataFrame:
    """Counts and sums per day between first and last purchase."""
    days = F.datediff(F.col(f"{ts}_max").cast("date"), F.col(f"{ts}_min").cast("date"))
    return df.withColumns({new: ratio(F.col(old), days) for old, new in columns.items()})


# Fixed values. Which combined columns exist: column stem -> statistics that are added, and stems whose sums are divided.
ADDED = {"purchase_amount": ("mean", "max", "min"), "month_diff": ("mean",), "month_lag": ("mean", "max", "min"),
         "category_1": ("mean",), "installments": ("mean", "max"), "duration": ("mean", "min", "max"),
         "amount_month_ratio": ("mean", "min", "max")}
DIVIDED = {"purchase_amount_ratio": "purchase_amount_sum", "installments_ratio": "installments_sum",
           "month_diff_ratio": "month_diff_mean", "card_id_cnt_ratio": "card_id_count"}
TOTALS = {"card_id_total": "card_id_size", "card_id_cnt_total": "card_id_count",
          "purchase_amount_total": "purchase_amount_sum", "installments_total": "installments_sum"}
PRICES = {"price_total": ("purchase_amount_total", "installments_total"),
          "price_mean": ("purchase_amount_mean", "installments_mean"),
          "price_max": ("purchase_amount_max", "installments_max")}


def totals(df: DataFrame) -> DataFrame:
    """Sums and quotients of matching history and new-period columns, for every pair the table has."""
    def pair(stem: str):
        return F.col(f"new_{stem}"), F.col(f"hist_{stem}")

    def present(stem: str) -> bool:
        return {f"new_{stem}", f"hist_{stem}"} <= set(df.columns)

    stems = {f"{c}_{s}": f"{c}_{s}" for c, stats in ADDED.items() for s in stats} | TOTALS
    made = {name: sum(pair(stem)[1:], pair(stem)[0]) for name, stem in stems.items() if present(stem)}
    made |= {name: ratio(*pair(stem)) for name, stem in DIVIDED.items() if present(stem)}
    made |= {name: ratio(made[a], made[b]) for name, (a, b) in PRICES.items() if a in made and b in made}
    return df.withColumns(made)


def lifetime_value(df: DataFrame) -> DataFrame:
    """Count times spend over mean age per period, and new over history."""
    value = {p: ratio(F.col(f"{p}_card_id_count") * F.col(f"{p}_purchase_amount_sum"), F.col(f"{p}_month_diff_mean"))
             for p in PERIODS}
    return df.withColumns({"new_CLV": value["new"], "hist_CLV": value["hist"], "CLV_ratio": ratio(value["new"], value["hist"])})


def pair_columns(df: DataFrame, stems: Sequence[str] | None = None) -> DataFrame:
    """Sum, difference and guarded quotient for every column that both periods have."""
    if stems is None:
        numeric = {f.name for f in df.schema if f.dataType.typeName() not in {"string", "timestamp_ntz", "timestamp", "date"}}
        stems = [c[4:] for c in df.columns if c.startswith("new_") and {c, f"hist_{c[4:]}"} <= numeric]
    made = {}
    for s in stems:
        new, hist = F.col(f"new_{s}"), F.col(f"hist_{s}")
        made |= {f"new_{s}_add_hist_{s}": new + hist, f"new_{s}_sub_hist_{s}": new - hist,
                 f"new_{s}_div_hist_{s}": ratio(new, F.abs(hist) + PAIR_GUARD)}
    return df.select("*", *[c.alias(n) for n, c in made.items()])


def inactivity(df: DataFrame, elapsed: str = "elapsed_time") -> DataFrame:
    """Elapsed days without a purchase on that day of month, per period, summed and compared."""
    hist, new = (F.col(elapsed) - F.col(f"{p}_day_nunique") for p in PERIODS)
    return df.withColumns({"hist_sleep_day": hist, "new_sleep_day": new, "total_sleep_day": hist + new, "diff_sleep_day": hist - new})


def spend_change(df: DataFrame) -> DataFrame:
    new, hist = F.col("new_purchase_amount_sum"), F.col("hist_purchase_amount_sum")
    return df.withColumns({"purchase_amount_total": new + hist, "purchase_amount_diff": new - hist,
                           "purchase_amount_rate": ratio(new - hist, hist)})
