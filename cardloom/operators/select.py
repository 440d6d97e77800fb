"""Feature selection: correlation, missing share, single values, importance, and a class that collects drops."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, functions as F

from cardloom.operators.encode import one_hot
from cardloom.operators.models import boosted_importance
from cardloom.operators.windows import cumulative_share

NUMERIC = {"byte", "short", "integer", "long", "float", "double", "decimal"}


def numeric_columns(df: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if f.dataType.typeName() in NUMERIC and f.name not in skip]


def narrow_types(df: DataFrame, floats: bool = True) -> DataFrame:
    """Cast numeric columns to the smallest type that holds their range (one min/max pass)."""
    names = numeric_columns(df)
    if not names:
        return df
    ends = df.agg(*[F.min(c).alias(f"lo_{c}") for c in names], *[F.max(c).alias(f"hi_{c}") for c in names]).first()
    casts = {}
    for c in names:
        kind, lo, hi = df.schema[c].dataType.typeName(), ends[f"lo_{c}"], ends[f"hi_{c}"]
        if kind in {"byte", "short", "integer", "long"} and lo is not None:
            fits = [t for t, bits in (("byte", 7), ("short", 15), ("int", 31), ("bigint", 63))
                    if lo > -2 ** bits and hi < 2 ** bits - 1]
            casts[c] = F.col(c).cast(fits[0] if fits else "bigint")
        elif kind == "double" and floats and lo is not None and max(abs(lo), abs(hi)) < float(np.finfo(np.float32).max):
            casts[c] = F.col(c).cast("float")
    return df.withColumns(casts)


def halve_types(df: DataFrame) -> DataFrame:
    """64-bit numbers to 32 bits, unconditionally."""
    target = {"long": "int", "double": "float"}
    return df.withColumns({f.name: F.col(f.name).cast(target[f.dataType.typeName()])
                           for f in df.schema if f.dataType.typeName() in target})


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Pearson correlation over pairwise complete rows, from one Gram matrix of all columns.

    Each row contributes its centred values (missing as 0), presence marks and squares; their inner products
    hold every pairwise sum. The result is columns × columns; a pair without spread is NaN.
    """
    columns, m = list(columns), len(columns)
    facts = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)],
                   *[(F.min(c) < F.max(c)).alias(f"v{i}") for i, c in enumerate(columns)]).first()
    varies = np.array([bool(facts[f"v{i}"]) for i in range(m)])
    centred = [F.coalesce(F.col(c).cast("double") - F.lit(facts[f"m{i}"]), F.lit(0.0)) for i, c in enumerate(columns)]
    marks = [F.col(c).isNotNull().cast("double") for c in columns]
    rows = df.select(F.array(*centred, *marks, *[x * x for x in centred]).alias("a"))
    vectors = MLUtils.convertVectorColumnsFromML(rows.select(array_to_vector(F.col("a")).alias("v")), "v")
    g = RowMatrix(vectors).computeGramianMatrix().toArray()
    products, sums, squares, n = g[:m, :m], g[:m, m:2 * m], g[2 * m:, m:2 * m], g[m:2 * m, m:2 * m]
    with np.errstate(invalid="ignore", divide="ignore"):
        cov = products - sums * sums.T / n
        var = squares - sums * sums / n
        corr = cov / np.sqrt(var * var.T)
        flat = (var <= 1e-12 * np.diag(squares)[:, None]) | ~varies[:, None]
    corr[flat | flat.T] = np.nan
    return np.clip(corr, -1.0, 1.0)


def correlation_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlation matrix in long form (feature_a, feature_b, corr); missing where a column has no spread."""
    matrix = correlation_matrix(df, columns)
    return df.sparkSession.createDataFrame(
        [(a, b, None if np.isnan(matrix[i, j]) else float(matrix[i, j]))
         for i, a in enumerate(columns) for j, b in enumerate(columns)],
        schema="feature_a string, feature_b string, corr double")


def least_correlated(matrix: np.ndarray, columns: Sequence[str]) -> list[tuple[str, str]]:
    """For each column, the column it correlates with least (first one on ties)."""
    pairs = []
    for j, c in enumerate(columns):
        if not np.all(np.isnan(matrix[:, j])):
            pairs.append((c, columns[int(np.nanargmin(matrix[:, j]))]))
    return pairs


def interactions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sum, difference, product and quotient of every column and its least correlated partner."""
    made = {}
    for i, (a, b) in enumerate(least_correlated(correlation_matrix(df, columns), columns), start=1):
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        made |= {f"inter_sum_{i}": x + y, f"inter_sub_{i}": x - y, f"inter_mult_{i}": x * y,
                 f"inter_div_{i}": F.try_divide(x, y)}
    return df.select("*", *[c.alias(n) for n, c in made.items()])


def missing_fractions(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, missing_fraction), most missing first, from one aggregate row."""
    columns = columns or df.columns
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "feature", "missing_fraction").orderBy(F.desc("missing_fraction"), "feature")


def unique_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, nunique), missing ignored; values travel long, so no column multiplies the others' work."""
    columns = columns or df.columns
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("v")) for c in columns])
    values = df.select(F.explode(entries).alias("e")).select("e.*").distinct()
    return values.groupBy("feature").agg(F.count("v").alias("nunique")).orderBy("nunique", "feature")


def single_valued(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Columns with exactly one non-missing value: smallest equals largest, no distinct count needed."""
    columns = columns or df.columns
    row = df.agg(*[(F.min(c) == F.max(c)).alias(c) for c in columns]).first()
    return [c for c in columns if row[c]]


def collinear_pairs(matrix: np.ndarray, columns: Sequence[str], limit: float) -> list[tuple[str, str, float]]:
    """(dropped, partner, correlation) for every earlier column a column is too close to."""
    return [(columns[j], columns[i], float(matrix[i, j]))
            for j in range(len(columns)) for i in range(j) if abs(matrix[i, j]) > limit]


def top_features(importance: DataFrame, n: int) -> DataFrame:
    """The n features with the largest mean importance over folds."""
    return (importance.groupBy("feature").agg(F.avg("importance").alias("importance"))
            .orderBy(F.desc("importance"), "feature").limit(n))


def zero_importance(importance: DataFrame) -> DataFrame:
    """Features whose mean importance is zero."""
    return importance.where(F.col("importance") == 0)


def low_importance(shares: DataFrame, cumulative: float) -> DataFrame:
    """Features beyond the running share that the more important ones already reach."""
    return shares.where(F.col("cumulative_importance") > cumulative)


class FeatureSelector:
    """Five removal methods over one feature table, and the table without what they found."""

    METHODS = ("missing", "single_unique", "collinear", "zero_importance", "low_importance")

    def __init__(self, data: DataFrame, label: str | None = None, key: str = "card_id"):
        self.data, self.label, self.key = data, label, key
        self.features = [c for c in data.columns if c not in (label, key)]
        self.encoded: DataFrame | None = None
        self.one_hot_features: list[str] | None = None
        self.found: dict[str, list[str]] = {}
        self.tables: dict[str, DataFrame] = {}

    def identify_missing(self, limit: float) -> list[str]:
        table = missing_fractions(self.data, self.features)
        rows = table.where(F.col("missing_fraction") > limit)
        self.tables["missing"] = rows
        return self._record("missing", [r["feature"] for r in rows.collect()])

    def identify_single_unique(self) -> list[str]:
        return self._record("single_unique", single_valued(self.data, self.features))

    def identify_collinear(self, limit: float, encode: bool = False) -> list[str]:
        data = self._encode() if encode else self.data
        columns = numeric_columns(data, (self.key, self.label))
        pairs = collinear_pairs(correlation_matrix(data, columns), columns, limit)
        self.tables["collinear"] = data.sparkSession.createDataFrame(
            pairs, "drop_feature string, corr_feature string, corr_value double")
        dropped = {p[0] for p in pairs}
        return self._record("collinear", [c for c in columns if c in dropped])

    def identify_zero_importance(self, task: str, runs: int = 10, early_stopping: bool = True, **params) -> list[str]:
        if self.label is None:
            raise ValueError("importance needs a label column")
        data = self._encode()
        importance = boosted_importance(data, numeric_columns(data, (self.key, self.label)), self.label, self.key,
                                        task, runs, early_stopping, **params)
        self.tables["importance"] = cumulative_share(importance, "importance", "feature")
        return self._record("zero_importance", sorted(r["feature"] for r in zero_importance(importance).collect()))

    def identify_low_importance(self, cumulative: float) -> list[str]:
        if "importance" not in self.tables:
            raise NotImplementedError("run identify_zero_importance first")
        low = low_importance(self.tables["importance"], cumulative)
        return self._record("low_importance", sorted(r["feature"] for r in low.collect()))

    def identify_all(self, params: Mapping[str, object]) -> list[str]:
        needed = ("missing_threshold", "correlation_threshold", "task", "cumulative_importance")
        absent = [p for p in needed if p not in params]
        if absent:
            raise ValueError(f"missing parameters: {absent}")
        self.identify_missing(params["missing_threshold"])
        self.identify_single_unique()
        self.identify_collinear(params["correlation_threshold"])
        self.identify_zero_importance(params["task"], **params.get("boosting", {}))
        self.identify_low_importance(params["cumulative_importance"])
        return self.check_removal()

    def check_removal(self, keep_one_hot: bool = True) -> list[str]:
        """Everything found so far, with all one-hot columns when they are not to be kept."""
        names = {c for columns in self.found.values() for c in columns}
        if not keep_one_hot:
            names |= set(self.one_hot_features or ())
        return sorted(names)

    def remove(self, methods: str | Sequence[str] = "all", keep_one_hot: bool = True) -> DataFrame:
        """The data without the columns that the named methods found."""
        chosen = list(self.found) if methods == "all" else list(methods)
        not_run = [m for m in chosen if m not in self.found]
        if not_run:
            raise NotImplementedError(f"methods that have not been run: {not_run}")
        names = {c for m in chosen for c in self.found[m]}
        if not keep_one_hot:
            names |= set(self.one_hot_features or ())
        data = self.encoded if self.encoded is not None else self.data
        return data.drop(*names)

    def _encode(self) -> DataFrame:
        if self.encoded is None:
            self.encoded = one_hot(self.data, keep=True)
            self.one_hot_features = [c for c in self.encoded.columns if c not in self.data.columns]
        return self.encoded

    def _record(self, method: str, names: list[str]) -> list[str]:
        self.found[method] = names
        return names
