"""Cross-validated gradient-boosted trees on Spark ML: out-of-fold scores, averaged test scores, importance."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardloom.operators.folds import validation_split
from cardloom.sources.tables import stage

MISSING = -9999.0
STOPPING = 0.15  # share of the training rows that decides when to stop


@dataclass
class KFoldResult:
    """``oof``: one held-out prediction per training row. ``test``: mean of the fold models' predictions."""

    oof: DataFrame
    importance: DataFrame
    test: DataFrame | None = None
    models: list = field(default_factory=list)


def assemble(df: DataFrame, features: Sequence[str], keep: Sequence[str], vectors: Sequence[str] = ()) -> DataFrame:
    """One vector column from numeric columns (missing gets a value of its own) and ready vectors."""
    filled = df.select(*keep, *vectors, *[F.coalesce(F.col(c).cast("double"), F.lit(MISSING)).alias(c)
                                          for c in features])
    return VectorAssembler(inputCols=[*features, *vectors], outputCol="features").transform(filled).select(
        *keep, "features")


def _estimator(task: str, label: str, params: dict):
    kind = {"regression": GBTRegressor, "classification": GBTClassifier}[task]
    return kind(featuresCol="features", labelCol=label, predictionCol="prediction", **params)


def _score(model, df: DataFrame, task: str, name: str) -> DataFrame:
    """Add the prediction, or the probability of class 1, as one plain column."""
    scored = model.transform(df)
    if task == "classification":
        positive = vector_to_array("probability")[1]
        return scored.drop("prediction").withColumn(name, positive).drop("rawPrediction", "probability")
    return scored.withColumnRenamed("prediction", name)


def kfold_boosting(train: DataFrame, features: Sequence[str], label: str, fold: str, k: int, task: str,
                   test: DataFrame | None = None, key: str = "card_id", early_stopping: bool = True,
                   vectors: Sequence[str] = (), **params) -> KFoldResult:
    """Fit one model per fold on the other folds and score the held-out rows.

    With early stopping ``STOPPING`` of the other folds' rows, by hash, decide how many trees are kept; the held-out fold only
    reports. Assembled vectors are staged once, so the k fits do not recompute the features.
    """
    data = stage(assemble(train, features, [key, label, fold], vectors), "train")
    names = [*features] if not vectors else None
    held_out, models, shares = [], [], []
    for f in range(k):
        held = F.col(fold) == f
        if early_stopping:
            estimator = _estimator(task, label, {"validationIndicatorCol": "_stops", **params})
            model = estimator.fit(validation_split(data.where(~held), key, STOPPING, f, "_stops"))
        else:
            model = _estimator(task, label, params).fit(data.where(~held))
        models.append(model)
        held_out.append(_score(model, data.where(held), task, "prediction").drop("features"))
        if names:
            shares += [(n, float(x), f) for n, x in zip(names, model.featureImportances.toArray())]
    oof = reduce(DataFrame.unionByName, held_out)
    spark = train.sparkSession
    importance = spark.createDataFrame(shares, "feature string, importance double, fold int")
    averaged = None
    if test is not None:
        scored = stage(assemble(test, features, [key], vectors), "test")
        for f, model in enumerate(models):
            scored = _score(model, scored, task, f"_p{f}")
        averaged = scored.select(key, _mean_of(k).alias("prediction"))
    return KFoldResult(oof, importance, averaged, models)


def hard_labels(oof: DataFrame, limit: float = 0.5) -> DataFrame:
    """0/1 predictions from probabilities."""
    return oof.withColumn("predicted", (F.col("prediction") > limit).cast("int"))


def importance_report(importance: DataFrame) -> DataFrame:
    """Mean importance over folds, its log, and its share of the total."""
    mean = importance.groupBy("feature").agg(F.avg("importance").alias("importance"))
    total = mean.agg(F.sum("importance")).scalar()
    return mean.withColumn("log_importance", F.log1p("importance")).withColumn(
        "share", F.try_divide(F.col("importance"), total))


def boosted_importance(df: DataFrame, features: Sequence[str], label: str, key: str, task: str, runs: int,
                       early_stopping: bool = True, **params) -> DataFrame:
    """(feature, importance) averaged over several runs, each with its own 15 % validation rows."""
    data = stage(assemble(df.where(F.col(label).isNotNull()), features, [key, label]), "importance")
    totals = [0.0] * len(features)
    for run in range(runs):
        options = {"seed": run, **params}
        if early_stopping:
            fitted = _estimator(task, label, {"validationIndicatorCol": "_held", **options}).fit(
                validation_split(data, key, 0.15, run, "_held"))
        else:
            fitted = _estimator(task, label, options).fit(data)
        totals = [t + float(x) / runs for t, x in zip(totals, fitted.featureImportances.toArray())]
    return df.sparkSession.createDataFrame(list(zip(features, totals)), "feature string, importance double")


def token_vectors(counts: DataFrame, chosen: DataFrame, key: str, name: str = "tokens") -> DataFrame:
    """One count vector per key over the chosen tokens, ready for the assembler.

    A key holds at most one cell per chosen token, so its cells fit one map.
    """
    listed = [(r["block"], r["token"], i) for i, r in enumerate(chosen.select("block", "token").collect())]  # k rows
    index = counts.sparkSession.createDataFrame(listed, "block string, token string, _i int")
    cells = counts.join(index, ["block", "token"]).groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct("_i", F.col("n").cast("double")))).alias("_m"))
    places = F.sequence(F.lit(0), F.lit(len(listed) - 1))
    dense = F.transform(places, lambda i: F.coalesce(F.try_element_at(F.col("_m"), i), F.lit(0.0)))
    return cells.select(key, array_to_vector(dense).alias(name))


def checksum(model) -> str:
    """Digest of a tree model's splits and leaves."""
    return hashlib.sha256(model.toDebugString.split("\n", 1)[1].encode()).hexdigest()


def save_models(models: Sequence, path: str, task: str = "regression", features: Sequence[str] = (), parameters: Mapping = {}) -> None:
    """Store one fitted model per fold, and beside them a manifest: task, features, parameters and checksum of each."""
    for f, model in enumerate(models):
        model.write().overwrite().save(f"{path}/fold_{f}")
    rows = [(f, task, list(features), {k: str(v) for k, v in parameters.items()}, m.getNumTrees, checksum(m)) for f, m in enumerate(models)]
    SparkSession.active().createDataFrame(
        rows, "fold int, task string, features array<string>, parameters map<string,string>, trees int, checksum string"
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/manifest")


def load_models(path: str, folds: int, task: str) -> list:
    """The stored models, each checked against the manifest."""
    kind = {"regression": GBTRegressionModel, "classification": GBTClassificationModel}[task]
    wanted = {r["fold"]: r["checksum"] for r in read_manifest(SparkSession.active(), path).collect()}
    loaded = [kind.load(f"{path}/fold_{f}") for f in range(folds)]
    for f, model in enumerate(loaded):
        if checksum(model) != wanted[f]:
            raise ValueError(f"the stored model of fold {f} is not the one in the manifest")
    return loaded


def fold_scores(df: DataFrame, features: Sequence[str], models: Sequence, task: str, key: str = "card_id") -> DataFrame:
    """(``key``, ``fold``, ``prediction``): each model's score of every row."""
    scored = stage(assemble(df, features, [key]), "scored")
    for f, model in enumerate(models):
        scored = _score(model, scored, task, f"_p{f}")
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("fold"), F.col(f"_p{f}").alias("prediction")) for f in range(len(models))]))
    return scored.select(key, each.alias("_e")).select(key, "_e.*")


def average_scores(df: DataFrame, features: Sequence[str], models: Sequence, task: str, key: str = "card_id") -> DataFrame:
    """Mean prediction of several models per row."""
    scored = stage(assemble(df, features, [key]), "scored")
    for f, model in enumerate(models):
        scored = _score(model, scored, task, f"_p{f}")
    return scored.select(key, _mean_of(len(models)).alias("prediction"))


def _mean_of(k: int) -> Column:
    return sum((F.col(f"_p{f}") for f in range(1, k)), F.col("_p0")) / k


def with_vectors(df: DataFrame, vectors: DataFrame, key: str, name: str, size: int) -> DataFrame:
    """Attach token vectors; a row without tokens gets the all-zero vector."""
    zeros = array_to_vector(F.array_repeat(F.lit(0.0), size))
    return df.join(vectors, key, "left").withColumn(name, F.coalesce(name, zeros))


def stack(tables: Sequence[DataFrame], key: str = "card_id", label: str | None = None) -> DataFrame:
    """Out-of-fold scores of several models side by side, as inputs of a second-level model."""
    renamed = [t.select(key, F.col("prediction").alias(f"score_{i}")) for i, t in enumerate(tables)]
    joined = reduce(lambda a, b: a.join(b, key), renamed)
    return joined if label is None else joined.join(tables[0].select(key, label), key)
