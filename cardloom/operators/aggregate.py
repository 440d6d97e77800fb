"""Spec-driven grouped statistics: one aggregation for many columns, statistics and slices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardloom.operators.ordering import NEVER_HOT, hot_keys, hot_medians, split_hot
from cardloom.sources.tables import stage

Spec = Sequence[tuple[str, Sequence[str]]]

# Exact cents: sums of these columns run in decimal, so their result does not depend on the order in which
# tasks finish or are retried.
EXACT_SCALE = {"purchase_amount": 2}


def exact_sum(column: Column, scale: int | None) -> Column:
    if scale is None:
        return F.sum(column).cast("double")
    return F.sum(column.cast(f"decimal(18,{scale})")).cast("double")


def corrected_skewness(column: Column) -> Column:
    """Bias-corrected sample skewness: missing below three values, 0 for a constant group."""
    n = F.count(column).cast("double")
    corrected = F.try_divide(F.skewness(column) * F.sqrt(n * (n - 1)), n - 2)
    return F.when(n < 3, F.lit(None)).when(F.min(column) == F.max(column), F.lit(0.0)).otherwise(corrected)


def statistic(column: Column, stat: str, scale: int | None = None, where: Column | None = None) -> Column:
    """One aggregate expression. ``size`` counts rows, ``count`` non-missing values, ``sum`` of nothing is 0."""
    value = column if where is None else F.when(where, column)
    if stat == "size":
        return F.count(F.lit(1)) if where is None else F.count(F.when(where, F.lit(1)))
    if stat == "count":
        return F.count(value)
    if stat == "nunique":
        return F.count_distinct(value)
    if stat == "nunique_approx":
        return F.approx_count_distinct(value)
    if stat == "sum":
        return F.coalesce(exact_sum(value, scale), F.lit(0.0))
    if stat == "mean":
        return F.avg(value) if scale is None else F.try_divide(exact_sum(value, scale), F.count(value))
    if stat == "skew":
        return corrected_skewness(value)
    simple = {"min": F.min, "max": F.max, "var": F.var_samp, "std": F.stddev_samp, "median": F.median}
    return simple[stat](value)


@dataclass(frozen=True, eq=False)
class Part:
    """One output column of an aggregation."""

    name: str
    column: str
    stat: str
    where: Column | None


def flatten(spec: Spec, prefix: str, suffix: str = "") -> list[tuple[str, str, str]]:
    """(output name, column, statistic) triples; a name that appears twice is an error."""
    triples = [(f"{prefix}{c}_{s}{suffix}", c, s) for c, stats in spec for s in stats]
    names = [t[0] for t in triples]
    repeated = {n for n in names if names.count(n) > 1}
    if repeated:
        raise ValueError(f"repeated output columns: {sorted(repeated)}")
    return triples


def value_groups(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                 aggregates: Mapping[str, Column]) -> tuple[DataFrame, dict[str, Column]]:
    """Aggregates per (key, value) for several columns at once, and the row condition of each column's part.

    Grouping sets read the table once; equal values combine before the shuffle.
    """
    columns = list(columns)
    groups = df.groupingSets([[*keys, c] for c in columns], *keys, *columns).agg(
        F.grouping_id().alias("_set"), *[a.alias(n) for n, a in aggregates.items()])
    every = 2 ** len(columns) - 1
    return groups, {c: F.col("_set") == F.lit(every - 2 ** (len(columns) - 1 - i)) for i, c in enumerate(columns)}


def _distinct_counts(df: DataFrame, keys: Sequence[str], parts: Sequence[Part]) -> DataFrame:
    """Exact distinct counts of many columns and slices: one row per value first, then a plain count."""
    flags = {f"_w{i}": p.where for i, p in enumerate(parts)}
    groups, chosen = value_groups(df, keys, dict.fromkeys(p.column for p in parts), {
        n: F.lit(True) if where is None else F.coalesce(F.bool_or(where), F.lit(False)) for n, where in flags.items()})
    return groups.groupBy(*keys).agg(*[
        F.count(F.when(chosen[p.column] & F.col(f"_w{i}"), F.col(p.column))).alias(p.name) for i, p in enumerate(parts)])


def _middle(values: Column, n: Column) -> Column:
    """Interpolated median of the first ``n`` values of a sorted array, missing if there are none."""
    last = n.cast("int") - 1
    return F.get(values, F.shiftright(last, 1)) * 0.5 + F.get(values, F.shiftright(last + 1, 1)) * 0.5


def _comparable(df: DataFrame, column: str, where: Column | None) -> Column:
    """A column's values in a slice; both zeros of a floating-point column are one value, as in a grouping."""
    value = F.col(column) + F.lit(0.0) if df.schema[column].dataType.typeName() in ("double", "float") else F.col(column)
    return value if where is None else F.when(where, value)


def _gathered(df: DataFrame, keys: Sequence[str], parts: Sequence[Part], dealt: bool, plain: Sequence[Column] = ()) -> DataFrame:
    """Exact medians and distinct counts of ordinary groups from their values, with ``plain`` aggregates beside them.

    Raw values are shuffled, once for all columns, instead of a buffer for each median or a row for each value.
    """
    rows = df if dealt else df.repartition(*[F.col(k) for k in keys])
    medians = {f"_m{i}": p for i, p in enumerate(p for p in parts if p.stat == "median")}
    distinct = [F.size(F.collect_set(_comparable(df, p.column, p.where))).cast("long").alias(p.name) for p in parts if p.stat != "median"]
    if not medians:
        return rows.groupBy(*keys).agg(*distinct, *plain)
    row = F.struct(*[_comparable(df, p.column, p.where).cast("double").alias(m) for m, p in medians.items()])
    table = rows.withColumn("_row", row).groupBy(*keys).agg(
        F.collect_list("_row").alias("_rows"), *[F.count(f"_row.{m}").alias(f"_n{m}") for m in medians], *distinct, *plain)
    table = table.withColumns({m: F.sort_array(f"_rows.{m}", asc=False) for m in medians})  # missing values come last
    kept = [c for c in table.columns if c not in medians and not c.startswith("_n_m") and c != "_rows"]
    return table.select(*[F.col(f"`{c}`") for c in kept], *[_middle(F.col(m), F.col(f"_n{m}")).alias(p.name) for m, p in medians.items()])


def _medians(df: DataFrame, keys: Sequence[str], parts: Sequence[Part], hot: DataFrame) -> DataFrame:
    """Exact medians where some keys are hot: the values of an ordinary group in one row, distributed ranks for hot groups."""
    cold, heavy = split_hot(df, keys, hot)
    heavy = heavy.select(*keys, *[(F.col(p.column) if p.where is None else F.when(p.where, F.col(p.column))).alias(p.name)
                                  for p in parts])
    ranked = hot.join(hot_medians(heavy, keys, [p.name for p in parts]), list(keys), "left")
    return _gathered(cold, keys, parts, False).unionByName(
        ranked.withColumnsRenamed({f"_median_{p.name}": p.name for p in parts}))


def multi_agg(df: DataFrame, keys: Sequence[str], spec: Spec, prefix: str = "",
              slices: Mapping[str, Column] | None = None, exact: Mapping[str, int] | None = None,
              batch: int = 30, hot_rows: int | None = None, hot: DataFrame | None = None, dealt: bool = False) -> DataFrame:
    """Grouped statistics named ``{prefix}{column}_{stat}{slice}``, all slices in the same pass.

    ``slices`` maps a name suffix to a row condition: overlapping slices become conditional aggregates, so none
    of them reads the table for itself. Long lists are cut into ``batch``-sized aggregations, because one very
    wide aggregation leaves compiled code; their results are partitioned by the same key and join without
    another shuffle. Give a stored table, since each batch scans its own columns of it. Distinct counts and
    medians run apart, so that they do not slow the others down; where no key is hot, together. Rows with a missing key form no group. ``dealt`` says
    that the rows of a key already lie in one partition; short lists then need one aggregation in all.
    """
    exact = EXACT_SCALE if exact is None else exact
    df = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    parts = [Part(name, c, s, where) for suffix, where in (slices or {"": None}).items()
             for name, c, s in flatten(spec, prefix, suffix)]
    distinct = [p for p in parts if p.stat == "nunique" and p.column not in keys]
    medians = [p for p in parts if p.stat == "median"]
    plain = [p for p in parts if p not in distinct and p not in medians]
    if medians:
        hot = hot if hot is not None else hot_keys(df, keys, hot_rows)
    gathered = [p for p in parts if p in distinct or p in medians] if hot is None and (medians or hot_rows == NEVER_HOT) else []
    made = [statistic(F.col(p.column), p.stat, exact.get(p.column), p.where).alias(p.name) for p in plain]
    if dealt and gathered and len(made) <= batch:
        return _gathered(df, keys, gathered, True, made).select(*keys, *[p.name for p in parts])
    tables = [df.groupBy(*keys).agg(*made[i:i + batch]) for i in range(0, len(made), batch)]
    if gathered:
        tables.append(_gathered(df, keys, gathered, dealt))
    else:
        if distinct:
            tables.append(_distinct_counts(df, keys, distinct))
        tables += [_medians(df, keys, medians[i:i + batch], hot) for i in range(0, len(medians), batch)]
    return reduce(lambda a, b: a.join(b, list(keys)), tables).select(*keys, *[p.name for p in parts])


def attach(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left enrichment join; Spark chooses broadcast or shuffle from the sizes."""
    return left.join(right, list(keys), "left")


def attach_all(left: DataFrame, tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Fold left joins on one key; the tables share the partitioning of that key."""
    return reduce(lambda acc, t: attach(acc, t, keys), tables, left)


def group_stat_attach(cards: DataFrame, rows: DataFrame, keys: Sequence[str], value: str, stat: str,
                      name: str, **options) -> DataFrame:
    """Attach one grouped statistic to a card list."""
    table = multi_agg(rows, keys, [(value, [stat])], **options)
    return attach(cards, table.withColumnRenamed(f"{value}_{stat}", name), keys)


group_mean_attach = partial(group_stat_attach, stat="mean")
group_std_attach = partial(group_stat_attach, stat="std")
group_max_attach = partial(group_stat_attach, stat="max")
group_median_attach = partial(group_stat_attach, stat="median")
group_min_attach = partial(group_stat_attach, stat="min")
group_sum_attach = partial(group_stat_attach, stat="sum")
group_count_attach = partial(group_stat_attach, stat="count")

PROFILE = ("mode", "nunique", "mode_ratio", "nunique_ratio")


def category_profile(rows: DataFrame, keys: Sequence[str], columns: Sequence[str],
                     stats: Sequence[str] = PROFILE, prefix: str = "") -> DataFrame:
    """Most frequent value, number of values, and both relative to the rows, for many columns at once.

    A missing value counts as a value. Ties go to the smallest value, a missing one first. All columns share two
    aggregations: counts per (key, value), then one row per key.
    """
    rows = rows.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    counts, chosen = value_groups(rows, keys, columns, {"_n": F.count(F.lit(1))})
    out = []
    for c in columns:
        size = F.sum(F.when(chosen[c], F.col("_n")))
        distinct = F.count(F.when(chosen[c], F.lit(1)))
        best = F.min(F.when(chosen[c], F.struct((-F.col("_n")).alias("n"), F.col(c).alias("v"))))
        made = {"mode": best.getField("v"), "nunique": distinct,
                "mode_ratio": -best.getField("n") / size, "nunique_ratio": distinct / size}
        out += [made[s].alias(f"{prefix}{c}_{s}") for s in stats]
    return counts.groupBy(*keys).agg(*out)


def dealt_profile(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], slices: Mapping[str, Column],
                  stats: Sequence[str] = PROFILE) -> DataFrame:
    """``category_profile`` of several slices, named by their prefix, where the rows of a key already lie in one partition.

    Each column is counted by value for itself, all slices in the same pass, so that no row is multiplied and none is shuffled. A key
    without rows in a slice has missing values there.
    """
    rows = rows.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    tables = []
    for c in columns:
        counts = rows.groupBy(*keys, c).agg(*[F.count(F.when(where, F.lit(1))).alias(f"_n{i}") for i, where in enumerate(slices.values())])
        out = []
        for i, prefix in enumerate(slices):
            n = F.col(f"_n{i}")
            size, distinct = F.sum(n), F.count(F.when(n > 0, F.lit(1)))
            best = F.min(F.when(n > 0, F.struct((-n).alias("n"), F.col(c).alias("v"))))
            made = {"mode": best.getField("v"), "nunique": F.when(distinct > 0, distinct),
                    "mode_ratio": F.try_divide(-best.getField("n"), size), "nunique_ratio": F.try_divide(distinct, size)}
            out += [made[s].alias(f"{prefix}{c}_{s}") for s in stats]
        tables.append(counts.groupBy(*keys).agg(*out))
    return reduce(lambda a, b: a.join(b, list(keys)), tables)


def profile_attach(cards: DataFrame, rows: DataFrame, keys: Sequence[str], value: str, name: str,
                   stat: str) -> DataFrame:
    table = category_profile(rows, keys, [value], [stat])
    return attach(cards, table.withColumnRenamed(f"{value}_{stat}", name), keys)


group_mode_attach = partial(profile_attach, stat="mode")
group_nunique_attach = partial(profile_attach, stat="nunique")
group_mode_ratio_attach = partial(profile_attach, stat="mode_ratio")
group_nunique_ratio_attach = partial(profile_attach, stat="nunique_ratio")


def group_transform(df: DataFrame, keys: Sequence[str], value: str, stats: Mapping[str, str],
                    source: DataFrame | None = None) -> DataFrame:
    """Give every row the statistics of its group; ``stats`` maps new name to statistic.

    An aggregate joined back, not a window: it combines before the shuffle and a hot group stays spread out. The
    aggregate is stored first, so that Spark joins it by its measured size: few groups are broadcast.
    ``source`` takes the statistics from another table, such as the history slice.
    """
    table = multi_agg(source if source is not None else df, keys, [(value, list(stats.values()))])
    renamed = table.withColumnsRenamed({f"{value}_{s}": n for n, s in stats.items()})
    return attach(df, stage(renamed, "group_statistics"), keys)


def visit_counts(df: DataFrame, value: str = "purchase_amount", hot_rows: int | None = None, dealt: bool = False) -> DataFrame:
    """Rows per (card, merchant) and per card, on each row.

    Where no card is hot, rows are dealt out by card and counted in windows, one shuffle in all, or none where they are ``dealt``
    already. Otherwise the counts are joined back; that of a card is the sum of its pair counts, so both come from one pass over the rows.
    """
    card, merchant = F.col("card_id"), F.col("merchant_id")
    if dealt or hot_keys(df, ["card_id"], hot_rows) is None:
        def number(*group: str) -> Column:
            return F.count(value).over(Window.partitionBy(*group))

        return (df if dealt else df.repartition(card)).withColumns({
            "card_merchant_counts_totals": F.when(card.isNotNull() & merchant.isNotNull(), number("card_id", "merchant_id")),
            "card_visit_counts": F.when(card.isNotNull(), number("card_id"))})
    pairs = stage(df.groupBy("card_id", "merchant_id").agg(F.count(value).alias("card_merchant_counts_totals")), "visits")
    per_card = pairs.groupBy("card_id").agg(F.sum("card_merchant_counts_totals").alias("card_visit_counts"))
    return df.join(pairs, ["card_id", "merchant_id"], "left").join(per_card, "card_id", "left")


def two_level(df: DataFrame, key: str, inner: Sequence[str], value: str, stat: str, outer: Sequence[str],
              name: str, slices: Mapping[str, Column] | None = None, hot_rows: int | None = None, dealt: bool = False) -> DataFrame:
    """Statistic per (key, inner keys), then statistics of those per key, for all slices in one pass."""
    slices = slices or {"": None}
    exact = EXACT_SCALE.get(value)

    def inner_statistic(where: Column | None) -> Column:
        # A slice without rows must stay missing, or its empty sum would enter the outer statistics as 0.
        rows = F.count(F.lit(1)) if where is None else F.count(F.when(where, F.lit(1)))
        return F.when(rows > 0, statistic(F.col(value), stat, exact, where))

    inner_table = df.groupBy(key, *inner).agg(*[inner_statistic(where).alias(f"{name}{suffix}")
                                                for suffix, where in slices.items()])
    present = [(f"{name}{suffix}", list(outer)) for suffix in slices]
    return multi_agg(inner_table, [key], present, exact={}, hot_rows=hot_rows, dealt=dealt)


def relative_to_group(df: DataFrame, key: str, inner: Sequence[str], value: str, reference: str,
                      stats: Sequence[str], name: str, hot_rows: int | None = None, dealt: bool = False) -> DataFrame:
    """Each row over its own group's statistic, then statistics of that quotient per key.

    Where the rows of a key already lie in one partition, a largest, smallest or mean value comes from a window there.
    """
    if dealt and reference in ("max", "min", "mean"):
        rows = df.withColumn("_ref", _beside(value, reference, [key, *inner]))
    else:
        rows = group_transform(df, [key, *inner], value, {"_ref": reference})
    rows = rows.withColumn(name, F.try_divide(F.col(value).cast("double"), F.col("_ref").cast("double")))
    return multi_agg(rows, [key], [(name, list(stats))], hot_rows=hot_rows, dealt=dealt)


def _beside(value: str, stat: str, keys: Sequence[str]) -> Column:
    """Statistic of the row's own group on each row, as ``group_transform`` gives it: missing where a key is."""
    group, scale = Window.partitionBy(*keys), EXACT_SCALE.get(value)
    if stat == "mean" and scale is not None:
        made = F.try_divide(F.sum(F.col(value).cast(f"decimal(18,{scale})")).over(group).cast("double"), F.count(value).over(group))
    else:
        made = statistic(F.col(value), stat).over(group)
    return F.when(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]), made)


def group_mean_summary(df: DataFrame, key: str, inner: Sequence[str], value: str, stats: Sequence[str],
                       name: str, source: DataFrame | None = None, hot_rows: int | None = None) -> DataFrame:
    """Mean of (key, inner) given to every row, then statistics per key; ``source`` may be another slice.

    All rows of a group have the same mean, so it is taken once, weighted by their number: only groups are shuffled, and
    joined only where the means come from ``source``. Statistics without a weighted form, and keys with very many groups, go by the rows.
    """
    weighted = {"max": F.max(name), "min": F.min(name), "median": F.percentile(name, F.lit(0.5), F.col("_rows"))}
    counts = df.where(F.col(key).isNotNull()).groupBy(key, *inner).agg(F.count(F.lit(1)).alias("_rows"))
    if not set(stats) <= set(weighted) or ("median" in stats and hot_keys(counts, [key], hot_rows) is not None):
        rows = group_transform(df, [key, *inner], value, {name: "mean"}, source)
        return multi_agg(rows, [key], [(name, list(stats))], hot_rows=hot_rows)
    if source is None:
        known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in inner])
        groups = df.where(F.col(key).isNotNull()).groupBy(key, *inner).agg(
            F.count(F.lit(1)).alias("_rows"), F.when(known, statistic(F.col(value), "mean", EXACT_SCALE.get(value))).alias(name))
    else:
        means = multi_agg(source, [key, *inner], [(value, ["mean"])])
        groups = attach(counts, means.withColumnRenamed(f"{value}_mean", name), [key, *inner])
    return groups.groupBy(key).agg(*[weighted[s].alias(f"{name}_{s}") for s in stats])


def repurchase_ratio(df: DataFrame, key: str, inner: Sequence[str], value: str, name: str) -> DataFrame:
    """Largest share of a key's rows that falls on one repeatedly visited inner group (0 if none repeats)."""
    visits = df.groupBy(key, *inner).agg(F.count(value).alias("_n"))
    repeated = F.max(F.when(F.col("_n") > 1, F.col("_n")).otherwise(0))
    return visits.groupBy(key).agg(F.try_divide(repeated.cast("double"), F.sum("_n").cast("double")).alias(name))


def frequency(df: DataFrame, key: str, count_name: str, share_name: str) -> DataFrame:
    """Rows per key and their share of all rows; the total is summed from the per-key counts."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(count_name))
    total = df.agg(F.count(F.lit(1)).alias("_n")).scalar()
    return counts.withColumn(share_name, F.col(count_name) / total)


def fill_with_mode(df: DataFrame, column: str) -> DataFrame:
    """Fill missing values with the most frequent present value (smallest on ties)."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    mode = counts.agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col(column).alias("v"))).getField("v"))
    return df.withColumn(column, F.coalesce(column, mode.scalar()))


def fill_with_mean(df: DataFrame, *columns: str) -> DataFrame:
    """Fill missing values with the mean of the present ones; one pass finds the means of all columns."""
    means = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(means[c])) for c in columns})


def fill_from_row(df: DataFrame, column: str, key: str, chosen: object) -> DataFrame:
    """Fill missing values with the value that one chosen row has."""
    value = df.where(F.col(key) == F.lit(chosen)).agg(F.max(column)).scalar()
    return df.withColumn(column, F.coalesce(column, value))


def drop_low_variance(df: DataFrame, limit: float = 0.01, keep: Sequence[str] = ()) -> DataFrame:
    """Drop numeric columns whose sample deviation is below ``limit`` (one pass over all of them)."""
    numeric = [f.name for f in df.schema if f.name not in keep and f.dataType.typeName() in
               {"byte", "short", "integer", "long", "float", "double", "decimal"}]
    spread = df.agg(*[F.stddev_samp(c).alias(c) for c in numeric]).first()
    return df.drop(*[c for c in numeric if spread[c] is not None and spread[c] < limit])
