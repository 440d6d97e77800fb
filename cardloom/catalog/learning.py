"""Sequences, text, factorisation, selection, folds, models and metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from cardloom.catalog.base import CARDS, CLEAN, EVENTS, HIST, TXN, TXN_ORDER_SQL, query, register, with_views
from cardloom.catalog.common import staged_clean
from cardloom.functions import dates
from cardloom.operators import aggregate, factor, folds, metrics, models, pivots, select, sequences, text, windows
from cardloom.operators.ratios import history
from cardloom.session import stage_path
from cardloom.sources import tables, views

BOOSTING = {"maxIter": 5, "maxDepth": 3, "seed": 7}

# --- sequences and text -----------------------------------------------------------------------------------------

TEXT_COLUMNS = ["merchant_category_id", "installments", "category_1", "category_2", "category_3", "city_id", "state_id", "subsector_id",
                "merchant_id", "authorized_flag", "month_lag"]
NAN = "coalesce(CAST({0} AS VARCHAR), 'nan')"


def placed_sql(source: str, where: str = "TRUE") -> str:
    """Rows with the number of their chunk, by the rule of ``sequence_chunks``."""
    return (f"placed AS (SELECT *, (row_number() OVER (PARTITION BY card_id ORDER BY {TXN_ORDER_SQL}) - 1) // {sequences.CHUNK} AS chunk "
            f"FROM {source} WHERE {where})")


@query("I0", with_views(TXN, placed_sql("txn", HIST), "SELECT card_id, chunk, " + ", ".join(
    f"string_agg({NAN.format(c)}, ' ' ORDER BY {TXN_ORDER_SQL}) AS {c}_text" for c in TEXT_COLUMNS)
    + " FROM placed GROUP BY card_id, chunk"))
def text_per_card(spark, d):
    rows = views.transactions(spark, d).where(history())
    return sequences.text_columns(rows, "card_id", TEXT_COLUMNS, views.TXN_ORDER)


@query("I0 I3", with_views(EVENTS, """placed AS (
SELECT *, (row_number() OVER (PARTITION BY card_id ORDER BY purchase_date, event_id) - 1) // 16 AS chunk FROM ev)
SELECT card_id, chunk, string_agg(merchant_category_id, ' ' ORDER BY purchase_date, event_id) AS merchant_category_id_text
FROM placed GROUP BY card_id, chunk"""))
def text_in_bounded_chunks(spark, d):
    return sequences.text_columns(views.events(spark, d), "card_id", ["merchant_category_id"], views.EVENT_ORDER, size=16)


@query("I3", with_views(TXN, placed_sql("txn"), f"""
SELECT card_id, chunk, array_to_string(list(CAST(merchant_id AS VARCHAR) ORDER BY {TXN_ORDER_SQL}), ',') AS merchants,
  count(*) AS length FROM placed GROUP BY card_id, chunk"""))
def merchant_sequence(spark, d):
    chunks = sequences.sequence_chunks(views.transactions(spark, d), "card_id", ["merchant_id"], views.TXN_ORDER)
    return chunks.select("card_id", "chunk", F.array_join("merchant_id", ",").alias("merchants"),
                         F.size("merchant_id").cast("bigint").alias("length"))


@query("I3", with_views(TXN, """counts AS (SELECT card_id, month(purchase_date) AS m, count(purchase_amount) AS n FROM txn GROUP BY 1, 2)
SELECT card_id, string_agg(CAST(n AS VARCHAR), ' ' ORDER BY m) AS words FROM counts GROUP BY card_id"""))
def monthly_count_words(spark, d):
    rows = views.transactions(spark, d).withColumn("month", F.month("purchase_date"))
    words = sequences.period_count_words(rows, "card_id", "month", "purchase_amount", "words")
    return words.withColumn("words", F.array_join("words", " "))


TOKENS = r"""tokens AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS token FROM documents)"""


@query("I1", f"WITH {TOKENS} SELECT doc_id, 'text' AS block, token, count(*) AS n FROM tokens GROUP BY doc_id, token")
def token_counts(spark, d):
    documents = tables.spread(views.table(spark, d, "documents").select("doc_id", "text"))
    return text.token_counts(documents, "doc_id", ["text"])


@query("I1", with_views(TXN, r"""words AS (
SELECT card_id, 'merchant_category_id' AS block, unnest(regexp_extract_all(lower(merchant_category_id), '[\p{L}\p{N}_]+')) AS token FROM txn
UNION ALL SELECT card_id, 'category_2', unnest(regexp_extract_all(coalesce(CAST(category_2 AS VARCHAR), 'nan'), '[\p{L}\p{N}_]+')) FROM txn)
SELECT card_id, block, token, count(*) AS n FROM words GROUP BY 1, 2, 3"""))
def sequence_token_counts(spark, d):
    return text.sequence_token_counts(views.transactions(spark, d), "card_id", ["merchant_category_id", "category_2"])


CHI2 = TOKENS + """, mass AS (
SELECT token, CAST(sum(CASE WHEN quality = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS o0, CAST(sum(quality) AS DOUBLE) AS o1, count(*) AS n
FROM tokens JOIN labels USING (doc_id) GROUP BY token),
prior AS (SELECT sum(CASE WHEN quality = 0 THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE) AS p0, sum(quality) / CAST(count(*) AS DOUBLE) AS p1
          FROM documents JOIN labels USING (doc_id)),
scores AS (SELECT token, (o0 - n * p0) * (o0 - n * p0) / (n * p0) + (o1 - n * p1) * (o1 - n * p1) / (n * p1) AS chi2 FROM mass, prior)"""


def chi2_scores(spark, d):
    documents = views.labelled_documents(spark, d)
    return text.chi_square(text.token_counts(documents, "doc_id", ["text"]), documents, "doc_id", "quality")


@query("I2", f"WITH {CHI2} SELECT token, round(chi2, 6) AS chi2 FROM scores")
def chi_square_scores(spark, d):
    return chi2_scores(spark, d).select("token", F.round("chi2", 6).alias("chi2"))


@query("F5 I2", f"WITH {CHI2} SELECT token, round(chi2, 6) AS chi2 FROM scores ORDER BY round(chi2, 6) DESC, token LIMIT 500")
def chi_square_top_tokens(spark, d):
    scores = chi2_scores(spark, d).withColumn("chi2", F.round("chi2", 6))
    return text.select_top(scores, 500).select("token", "chi2")


@query("I4")
def sequence_embedding(spark, d):
    return sequences.embed_sequences(views.transactions(spark, d), "card_id", ["merchant_id", "merchant_category_id"], views.TXN_ORDER)


WORD_COLUMNS = [*TEXT_COLUMNS, "month", "day", "weekofyear", "weekday"]


def dated(rows):
    return dates.date_parts(rows, "purchase_date", ["month", "day", "weekofyear", "weekday"])


@query("I3 I4", with_views(TXN, "dated AS (SELECT *, month(purchase_date) AS month, day(purchase_date) AS day, weekofyear(purchase_date) AS weekofyear, "
                           "isodow(purchase_date) - 1 AS weekday FROM txn)",
                           f"placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY card_id ORDER BY {TXN_ORDER_SQL}) AS at FROM dated)",
                           "pairs AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {NAN.format(f'l.{c}')} AS a, {NAN.format(f'r.{c}')} AS b FROM placed l JOIN placed r ON l.card_id = r.card_id "
    "AND abs(l.at - r.at) BETWEEN 1 AND 3" for c in WORD_COLUMNS) + ")", 'SELECT "column", a, b, count(*) AS n FROM pairs GROUP BY ALL'))
def sequence_cooccurrence(spark, d):
    return sequences.cooccurrence(views.transactions(spark, d, stepwise=True), "card_id", WORD_COLUMNS, views.TXN_ORDER, derive=dated)


@query("I4")
def sequence_vectors(spark, d):
    return sequences.association_vectors(tables.stage(dated(views.transactions(spark, d)), "dated"), "card_id", WORD_COLUMNS, views.TXN_ORDER)


@query("I4")
def monthly_count_embedding(spark, d):
    rows = views.transactions(spark, d).withColumn("month", F.month("purchase_date"))
    return sequences.embed_period_counts(rows, "card_id", "month", "purchase_amount", "purchase_sequence")


@query("I5")
def feature_tuple_embedding(spark, d):
    return sequences.embed_feature_tuples(views.cards(spark, d))


# --- factorisation ----------------------------------------------------------------------------------------------------

MATRICES = ("city_id", "merchant_category_id")


def count_and_sum_matrix(spark, d, category):
    return tables.stage(pivots.category_matrix(views.transactions(spark, d), "card_id", category, "purchase_amount"), "cells")


def cells_sql(category):
    return f"cells AS (SELECT card_id, {category} AS category, count(purchase_amount) AS n FROM txn GROUP BY 1, 2)"


@query("I7", with_views(TXN, cells_sql("city_id"), """
SELECT a AS category_a, b AS category_b, CAST(sum(x * y) AS DOUBLE) AS product FROM
  (SELECT l.category AS a, r.category AS b, l.n AS x, r.n AS y FROM cells l JOIN cells r USING (card_id)) GROUP BY a, b"""))
def category_gram_matrix(spark, d):
    return factor.gram(count_and_sum_matrix(spark, d, "city_id"), "card_id", "category", "n")


def energy(category):
    """Squared length of each card's scores when all singular vectors are taken: that of its own counts."""
    def run(spark, d):
        scores = factor.svd(count_and_sum_matrix(spark, d, category), "card_id", "category", "n", components=1_000_000).scores
        total = sum((F.col(c) * F.col(c) for c in scores.columns[2:]), F.col(scores.columns[1]) * F.col(scores.columns[1]))
        return scores.select("card_id", F.round(total, 4).alias("energy"))
    return run


ENERGY_SQL = "SELECT card_id, CAST(sum(n * n) AS DOUBLE) AS energy FROM cells GROUP BY card_id"
register("svd_row_energy", "I7", energy("city_id"), with_views(TXN, cells_sql("city_id"), ENERGY_SQL))
register("svd_row_energy_merchant_category", "I7", energy("merchant_category_id"), with_views(TXN, cells_sql("merchant_category_id"), ENERGY_SQL))


@query("I7")
def svd_sum_scores(spark, d):
    return factor.svd(count_and_sum_matrix(spark, d, "city_id"), "card_id", "category", "amount", prefix="svd_city").scores


@query("I7")
def svd_sum_scores_merchant_category(spark, d):
    return factor.svd(count_and_sum_matrix(spark, d, "merchant_category_id"), "card_id", "category", "amount", prefix="svd_category").scores


@query("I6")
def nmf_count_scores(spark, d):
    return factor.nmf(count_and_sum_matrix(spark, d, "city_id"), "card_id", "category", "n", prefix="nmf_city").scores


@query("I6")
def nmf_count_scores_merchant_category(spark, d):
    return factor.nmf(count_and_sum_matrix(spark, d, "merchant_category_id"), "card_id", "category", "n", prefix="nmf_category").scores


def guess_sql(column, seed, components):
    return ", ".join(f"('0x' || substr(md5(CAST({column} AS VARCHAR) || ':{seed + i}'), 1, 8))::BIGINT / 4294967296.0 * s + 1e-9 AS f{i}" for i in range(components))


def sweep_sql(name, source, components):
    """One factor improved, a component at a time, from columns f, gains g and the other factor's products p."""
    parts, now = [], [f"f{i}" for i in range(components)]
    for i in range(components):
        others = " + ".join(f"{now[k]} * p{min(i, k)}_{max(i, k)}" for k in range(components))
        parts.append(f"{name}_{i} AS MATERIALIZED (SELECT *, greatest(f{i} + (g{i} - ({others})) / greatest(p{i}_{i}, 1e-9), 1e-9) AS s{i} FROM {source})")
        now[i], source = f"s{i}", f"{name}_{i}"
    return parts


def nmf_sql(category, rounds, components, seed=42):
    """The rounds of the non-negative factorisation, one sweep each, spelled out: factors n, and f, which run ahead."""
    r = range(components)
    same = ", ".join(f"f{i} AS n{i}" for i in r)
    parts = [TXN, cells_sql(category),
             f"scale AS (SELECT sqrt(sum(n) / (count(DISTINCT card_id) * count(DISTINCT category)) / {components}) AS s FROM cells)",
             f"w0 AS (SELECT *, {same} FROM (SELECT card_id AS k, {guess_sql('card_id', seed, components)} FROM (SELECT DISTINCT card_id FROM cells), scale))",
             f"h0 AS (SELECT *, {same} FROM (SELECT category AS k, {guess_sql('category', seed + components, components)} FROM (SELECT DISTINCT category FROM cells), scale))"]
    for n in range(1, rounds + 1):
        ahead = factor.AHEAD * factor.FASTER ** (n - 1)
        for own, side, other, by in ((f"w{n}", f"w{n - 1}", f"h{n - 1}", ("card_id", "category")), (f"h{n}", f"h{n - 1}", f"w{n}", ("category", "card_id"))):
            parts += [f"p_{own} AS MATERIALIZED (SELECT " + ", ".join(f"sum(f{i} * f{j}) AS p{i}_{j}" for i in r for j in r if i <= j) + f" FROM {other})",
                      f"g_{own} AS MATERIALIZED (SELECT {by[0]} AS k, " + ", ".join(f"sum(n * f{i}) AS g{i}" for i in r) + f" FROM cells JOIN {other} ON k = {by[1]} GROUP BY 1)",
                      *sweep_sql(f"s_{own}", f"(SELECT * FROM {side} JOIN g_{own} USING (k), p_{own})", components),
                      f"{own} AS MATERIALIZED (SELECT k, " + ", ".join(f"s{i} AS n{i}, greatest(s{i} + CAST({ahead} AS DOUBLE) * (s{i} - n{i}), 1e-9) AS f{i}" for i in r)
                      + f" FROM s_{own}_{components - 1})"]
    return with_views(*parts, "SELECT k AS card_id, " + ", ".join(f"round(n{i}, 5) AS nmf_{i}" for i in r) + f" FROM w{rounds}")


def first_rounds(category, components=10):
    def run(spark, d):
        scores = factor.nmf(count_and_sum_matrix(spark, d, category), "card_id", "category", "n", components=components, rounds=2, sweeps=1).scores
        return scores.select("card_id", *[F.round(c, 5).alias(c) for c in scores.columns[1:]])
    return run


for _category in MATRICES:
    register(f"nmf_first_rounds_{_category}", "I6", first_rounds(_category), nmf_sql(_category, 2, 10))


# --- correlation and selection ------------------------------------------------------------------------------------------

FEATURES = """feats AS (SELECT card_id, count(*) AS visits, max(l_linenumber) AS top_line, min(month_lag) AS oldest,
  CAST(sum(installments) AS DOUBLE) AS inst, 2 * count(*) + 1 AS visits_copy, 7 AS constant,
  CASE WHEN count(*) > 45 THEN avg(category_2) END AS mostly_missing FROM txn GROUP BY card_id)"""
CORRELATED = ["visits", "top_line", "oldest", "inst", "visits_copy", "constant", "mostly_missing"]


def card_features(spark, d):
    """Per-card features with a planted copy, constant and mostly missing column."""
    rows = F.count(F.lit(1))
    table = views.transactions(spark, d).groupBy("card_id").agg(
        rows.alias("visits"), F.max("l_linenumber").alias("top_line"), F.min("month_lag").alias("oldest"),
        F.sum("installments").cast("double").alias("inst"), (2 * rows + 1).alias("visits_copy"), F.lit(7).alias("constant"),
        F.when(rows > 45, F.avg("category_2")).alias("mostly_missing"))
    return tables.stage(table, "card_features")


def corr_sql(a: str, b: str) -> str:
    if "constant" in (a, b):
        return "CAST(NULL AS DOUBLE)"
    made = f"(SELECT round(corr({a}, {b}), 6) FROM feats)"
    return f"CASE WHEN isnan({made}) THEN NULL ELSE {made} END"


CORR = "corr_table AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {corr_sql(a, b)} AS corr" for a in CORRELATED for b in CORRELATED) + ")"


@query("I8", with_views(TXN, FEATURES, CORR, "SELECT * FROM corr_table"))
def correlation_matrix(spark, d):
    table = select.correlation_table(card_features(spark, d), CORRELATED)
    return table.withColumn("corr", F.round("corr", 6))


PARTNERED = ["visits", "top_line", "oldest", "inst"]


def partner_sql(column: str) -> str:
    return (f"(SELECT arg_min(feature_b, corr) FROM corr_table WHERE feature_a = '{column}' "
            f"AND feature_b IN ({', '.join(repr(p) for p in PARTNERED)}))")


def partner_value(column: str) -> str:
    return f"CASE {partner_sql(column)} " + " ".join(f"WHEN '{p}' THEN CAST({p} AS DOUBLE)" for p in PARTNERED) + " END"


@query("I9", with_views(TXN, FEATURES, CORR, "SELECT card_id, " + ", ".join(
    f"{c} + {partner_value(c)} AS inter_sum_{i}, {c} - {partner_value(c)} AS inter_sub_{i}, "
    f"{c} * {partner_value(c)} AS inter_mult_{i}, {c} / nullif({partner_value(c)}, 0) AS inter_div_{i}"
    for i, c in enumerate(PARTNERED, 1)) + " FROM feats"))
def least_correlated_interactions(spark, d):
    table = select.interactions(card_features(spark, d), PARTNERED)
    return table.select("card_id", *[c for c in table.columns if c.startswith("inter_")])


@query("I10 F6", with_views(TXN, FEATURES, " UNION ALL ".join(
    f"SELECT '{c}' AS feature, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS missing_fraction FROM feats" for c in CORRELATED)))
def missing_fractions(spark, d):
    return select.missing_fractions(card_features(spark, d), CORRELATED)


@query("I11 F6", with_views(TXN, FEATURES, " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS nunique FROM feats" for c in CORRELATED)))
def unique_value_counts(spark, d):
    return select.unique_counts(card_features(spark, d), CORRELATED)


@query("I11", with_views(TXN, FEATURES, "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature FROM feats HAVING count(DISTINCT {c}) = 1" for c in CORRELATED) + ")"))
def single_valued_columns(spark, d):
    names = select.single_valued(card_features(spark, d), CORRELATED)
    return spark.createDataFrame([(n,) for n in names], "feature string")


@query("I12", with_views(TXN, FEATURES, CORR, "SELECT feature_a AS drop_feature, feature_b AS corr_feature, corr AS corr_value FROM corr_table "
                         "WHERE abs(corr) > 0.6 AND (" + " OR ".join(
    f"(feature_a = '{a}' AND feature_b = '{b}')" for i, a in enumerate(CORRELATED) for b in CORRELATED[:i]) + ")"))
def collinear_pairs(spark, d):
    selector = select.FeatureSelector(card_features(spark, d))
    selector.identify_collinear(0.6)
    return selector.tables["collinear"].withColumn("corr_value", F.round("corr_value", 6))


def selectable(spark, d):
    return aggregate.attach(views.cards(spark, d).select("card_id", "target"), card_features(spark, d), ["card_id"]).where(
        F.col("target").isNotNull())


@query("I13")
def zero_importance_columns(spark, d):
    selector = select.FeatureSelector(selectable(spark, d), label="target")
    selector.identify_zero_importance("regression", runs=2, **BOOSTING)
    return selector.tables["importance"].where(F.col("importance") == 0).select("feature", "importance")


@query("I14", """SELECT feature FROM (SELECT p_type AS feature, sum(count(*)) OVER (ORDER BY count(*) DESC, p_type)
  / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM part GROUP BY p_type) WHERE share > 0.5""")
def low_importance_columns(spark, d):
    counts = views.table(spark, d, "part").groupBy(F.col("p_type").alias("feature")).agg(F.count(F.lit(1)).alias("importance"))
    return select.low_importance(windows.cumulative_share(counts, "importance", "feature"), 0.5).select("feature")


@query("I15")
def selected_feature_table(spark, d):
    selector = select.FeatureSelector(selectable(spark, d), label="target")
    selector.identify_all({"missing_threshold": 0.6, "correlation_threshold": 0.95, "task": "regression",
                           "cumulative_importance": 0.99, "boosting": {"runs": 1, **BOOSTING}})
    return selector.remove("all")


# --- folds --------------------------------------------------------------------------------------------------------------

HASH = "('0x' || substr(md5({0} || ':326'), 1, 8))::BIGINT"


@query("I16", with_views(CARDS, f"SELECT card_id, CAST({HASH.format('card_id')} % 5 AS INTEGER) AS fold FROM cards"))
def kfold_assignment(spark, d):
    return folds.kfold(views.cards(spark, d).select("card_id"), "card_id", 5, 326)


@query("I17", with_views(CARDS, f"""
SELECT card_id, outlier, CAST((row_number() OVER (PARTITION BY outlier ORDER BY {HASH.format('card_id')}, card_id) - 1) % 5 AS INTEGER) AS fold FROM cards"""))
def stratified_fold_assignment(spark, d):
    return folds.stratified_kfold(views.cards(spark, d).select("card_id", "outlier"), "card_id", "outlier", 5, 326)


@query("I18", with_views(CARDS, f"SELECT card_id, {HASH.format('card_id')} < {int(0.15 * 2 ** 32)} AS is_validation FROM cards"))
def validation_split(spark, d):
    return folds.validation_split(views.cards(spark, d).select("card_id"), "card_id", 0.15, 326)


# --- models ----------------------------------------------------------------------------------------------------------------

MODEL_FEATURES = ["visits", "top_line", "oldest", "inst", "feature_1", "feature_2", "feature_3"]


def model_table(spark, d):
    table = aggregate.attach(views.cards(spark, d), card_features(spark, d), ["card_id"])
    return tables.stage(folds.stratified_kfold(table, "card_id", "outlier", 3, 326), "model_table")


def regression(spark, d, where=None, table=None):
    table = table or model_table(spark, d)
    train, test = table.where("is_test = 0"), table.where("is_test = 1")
    train = train if where is None else train.where(where)
    return models.kfold_boosting(train, MODEL_FEATURES, "target", "fold", 3, "regression", test, **BOOSTING)


def classification(spark, d, features=None, seed=7, table=None):
    table = table or model_table(spark, d)
    return models.kfold_boosting(table, features or MODEL_FEATURES, "outlier", "fold", 3, "classification",
                                 **{**BOOSTING, "seed": seed})


@query("I19 J8")
def kfold_regression_test_scores(spark, d):
    return regression(spark, d).test


@query("I19 G3")
def kfold_regression_out_of_fold(spark, d):
    return regression(spark, d).oof.select("card_id", "target", "fold", "prediction")


@query("A9")
def saved_fold_models(spark, d):
    result, path = regression(spark, d), stage_path(spark, "models")
    models.save_models(result.models, path)
    loaded = models.load_models(path, len(result.models), "regression")
    return models.average_scores(model_table(spark, d).where("is_test = 1"), MODEL_FEATURES, loaded, "regression")


@query("A9", with_views(CARDS, f"""SELECT fold, 'regression' AS task, '{','.join(MODEL_FEATURES)}' AS features, TRUE AS trees_within, count(*) AS n_scored,
  0 AS n_different FROM cards, range(3) AS folds(fold) WHERE is_test = 1 GROUP BY fold"""))
def stored_and_reloaded_models(spark, d):
    """What the manifest says of each fold's model, and how many cards its stored form scores differently: none."""
    result, path = regression(spark, d), stage_path(spark, "models")
    models.save_models(result.models, path, "regression", MODEL_FEATURES, BOOSTING)
    test = model_table(spark, d).where("is_test = 1")
    before, after = (models.fold_scores(test, MODEL_FEATURES, found, "regression")
                     for found in (result.models, models.load_models(path, len(result.models), "regression")))
    compared = before.join(after.withColumnRenamed("prediction", "again"), ["card_id", "fold"]).groupBy("fold").agg(
        F.count(F.lit(1)).alias("n_scored"), F.count_if(~F.col("prediction").eqNullSafe(F.col("again"))).alias("n_different"))
    manifest = models.read_manifest(spark, path).select("fold", "task", F.array_join("features", ",").alias("features"),
                                                           F.col("trees").between(1, BOOSTING["maxIter"]).alias("trees_within"))
    return manifest.join(compared, "fold")


@query("I20")
def kfold_classification(spark, d):
    result = models.hard_labels(classification(spark, d).oof)
    return result.select("card_id", "outlier", "fold", "prediction", "predicted")


@query("I21")
def classification_with_tokens(spark, d):
    rows = views.transactions(spark, d).where(history())
    counts = tables.stage(text.sequence_token_counts(rows, "card_id", ["merchant_category_id", "city_id"]), "tokens")
    table = model_table(spark, d)
    chosen = tables.stage(text.select_top(text.chi_square(counts, table.where("is_test = 0"), "card_id", "outlier"), 10), "chosen")
    vectors = models.token_vectors(counts, chosen, "card_id")
    joined = models.with_vectors(table, vectors, "card_id", "tokens", chosen.count())
    result = models.kfold_boosting(joined, MODEL_FEATURES, "outlier", "fold", 3, "classification", vectors=["tokens"], **BOOSTING)
    return result.oof.select("card_id", "outlier", "fold", "prediction")


def stacked(spark, d, table=None):
    table = table or model_table(spark, d)
    first = [classification(spark, d, MODEL_FEATURES[:4], 1, table).oof, classification(spark, d, MODEL_FEATURES[3:], 2, table).oof]
    level = folds.stratified_kfold(models.stack(first, label="outlier"), "card_id", "outlier", 3, 99)
    result = models.kfold_boosting(level, ["score_0", "score_1"], "outlier", "fold", 3, "classification", **BOOSTING)
    return result.oof.select("card_id", "outlier", "fold", "prediction")


@query("I22")
def stacked_classification(spark, d):
    return stacked(spark, d)


@query("I23")
def regression_without_outliers(spark, d):
    return regression(spark, d, F.col("outlier") == 0).test


def scored_sql(model, part, where):
    return f"SELECT '{model}' AS model, '{part}' AS part, count(*) AS n_cards, 0 AS n_twice, 0 AS n_without_score FROM cards WHERE {where}"


@query("I19 I20 I22 I23", with_views(CARDS, " UNION ALL ".join(scored_sql(*x) for x in (
    ("regression", "held out", "is_test = 0"), ("regression", "test", "is_test = 1"), ("classification", "held out", "TRUE"),
    ("stacked", "held out", "TRUE"), ("without outliers", "test", "is_test = 1")))))
def scored_cards(spark, d):
    """Each model scores each card it should exactly once: held-out cards by the model of the other folds, test cards by all.

    All models read one stored table."""
    table = model_table(spark, d)
    whole = regression(spark, d, table=table)
    tables_of = [("regression", "held out", whole.oof), ("regression", "test", whole.test), ("classification", "held out", classification(spark, d, table=table).oof),
                 ("stacked", "held out", stacked(spark, d, table)),
                 ("without outliers", "test", regression(spark, d, F.col("outlier") == 0, table).test)]
    scored = reduce(DataFrame.unionByName, [t.select(F.lit(m).alias("model"), F.lit(p).alias("part"), "card_id", "prediction") for m, p, t in tables_of])
    cards = scored.groupBy("model", "part", "card_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("prediction").isNull() | F.isnan("prediction")).alias("none"))
    return cards.groupBy("model", "part").agg(F.count(F.lit(1)).alias("n_cards"), F.count_if(F.col("n") > 1).alias("n_twice"),
                                              F.sum("none").alias("n_without_score"))


@query("I15", with_views(TXN, CARDS, FEATURES, """kept AS (SELECT card_id FROM cards WHERE target IS NOT NULL),
facts AS (SELECT f.* FROM kept LEFT JOIN feats f USING (card_id))
SELECT 'constant' AS feature, CASE WHEN count(DISTINCT constant) = 1 THEN 'single_unique' END AS reason FROM facts
UNION ALL SELECT 'mostly_missing', CASE WHEN avg(CASE WHEN mostly_missing IS NULL THEN 1.0 ELSE 0 END) > 0.6 THEN 'missing' END FROM facts
UNION ALL SELECT 'visits_copy', CASE WHEN abs(corr(visits, visits_copy)) > 0.95 THEN 'collinear' END FROM facts"""))
def planted_columns_removed(spark, d):
    """Why the selector removes the planted columns: one value, mostly missing, copy of another."""
    selector = select.FeatureSelector(selectable(spark, d), label="target")
    found = {"single_unique": selector.identify_single_unique(), "missing": selector.identify_missing(0.6), "collinear": selector.identify_collinear(0.95)}
    return spark.createDataFrame([(c, next((why for why, names in found.items() if c in names), None)) for c in ("constant", "mostly_missing", "visits_copy")],
                                 "feature string, reason string")


@query("I24 F2", """
WITH means AS (SELECT feature, avg(n) AS m FROM (
  SELECT p_type AS feature, p_size % 5 AS fold, count(*) AS n FROM part GROUP BY 1, 2) GROUP BY 1)
SELECT feature, m AS importance, round(ln(1 + m), 8) AS log_importance, round(m / (SELECT sum(m) FROM means), 10) AS share FROM means""")
def importance_report(spark, d):
    shares = views.table(spark, d, "part").groupBy(
        F.col("p_type").alias("feature"), (F.col("p_size") % 5).alias("fold")).agg(F.count(F.lit(1)).alias("importance"))
    report = models.importance_report(shares)
    return report.withColumns({"log_importance": F.round("log_importance", 8), "share": F.round("share", 10)})


# --- metrics ----------------------------------------------------------------------------------------------------------------

def scored(spark, d):
    documents = views.labelled_documents(spark, d)
    return documents.select("doc_id", "toxic", F.col("n_chars").cast("double").alias("score"),
                            ((F.col("n_chars") % 98 + 1) / F.lit(100.0)).alias("p"),
                            (F.col("n_chars") > 2000).cast("int").alias("predicted"), (F.col("doc_id") % 5).alias("fold"))


SCORED = """scored AS (SELECT doc_id, toxic, CAST(n_chars AS DOUBLE) AS score, (n_chars % 98 + 1) / 100.0 AS p,
  CAST(n_chars > 2000 AS INTEGER) AS predicted, doc_id % 5 AS fold FROM documents JOIN labels USING (doc_id))"""


@query("J1", with_views(TXN, CLEAN, "SELECT sqrt(avg((l_linenumber - installments) * (l_linenumber - installments))) AS rmse FROM tx"))
def rmse(spark, d):
    return metrics.rmse(staged_clean(spark, d), "l_linenumber", "installments")


@query("J2", with_views(SCORED, """
SELECT round((SELECT sum(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0 END)
  FROM scored a, scored b WHERE a.toxic = 1 AND b.toxic = 0) / (sum(toxic) * sum(1 - toxic)), 10) AS auc FROM scored"""))
def roc_auc(spark, d):
    return metrics.roc_auc(scored(spark, d), "toxic", "score").withColumn("auc", F.round("auc", 10))


@query("J3", with_views(SCORED, """
SELECT round(avg(-CASE WHEN toxic = 1 THEN ln(p) ELSE ln(1 - p) END), 8) AS log_loss FROM scored"""))
def log_loss(spark, d):
    return metrics.log_loss(scored(spark, d), "toxic", "p").withColumn("log_loss", F.round("log_loss", 8))


@query("J4", with_views(SCORED, "SELECT toxic AS actual, predicted, count(*) AS n FROM scored GROUP BY 1, 2"))
def confusion_matrix(spark, d):
    return metrics.confusion(scored(spark, d), "toxic", "predicted")


@query("J5", with_views(SCORED, """
SELECT c AS class, tp / nullif(CAST(called AS DOUBLE), 0) AS precision, tp / CAST(support AS DOUBLE) AS recall,
  2.0 * tp / (called + support) AS f1, support FROM (SELECT c, count(*) FILTER (WHERE toxic = c AND predicted = c) AS tp,
    count(*) FILTER (WHERE predicted = c) AS called, count(*) FILTER (WHERE toxic = c) AS support
  FROM scored, (VALUES (0), (1)) AS k(c) GROUP BY c)"""))
def classification_report(spark, d):
    return metrics.classification_report(scored(spark, d), "toxic", "predicted")


@query("J6", with_views(SCORED, """curve AS (
SELECT DISTINCT score, CAST(sum(toxic) OVER (ORDER BY score DESC) AS DOUBLE) AS tp, count(*) OVER (ORDER BY score DESC) AS called FROM scored)
SELECT score AS threshold, 2 * tp / (called + (SELECT sum(toxic) FROM scored)) AS f1 FROM curve ORDER BY f1 DESC, score LIMIT 1"""))
def best_f1_threshold(spark, d):
    return metrics.best_f1(scored(spark, d), "toxic", "score")


@query("J7", with_views(TXN, CLEAN, """
SELECT avg(abs(l_linenumber - installments)) AS mae, round(avg(abs(l_linenumber - installments) / CAST(l_linenumber AS DOUBLE)), 8) AS mape FROM tx"""))
def absolute_errors(spark, d):
    table = metrics.absolute_errors(staged_clean(spark, d), "l_linenumber", "installments")
    return table.withColumn("mape", F.round("mape", 8))


@query("J8", with_views(SCORED, """
SELECT round(avg(l), 8) AS mean_log_loss, count(*) AS folds FROM (
  SELECT fold, avg(-CASE WHEN toxic = 1 THEN ln(p) ELSE ln(1 - p) END) AS l FROM scored GROUP BY fold)"""))
def mean_over_folds(spark, d):
    per_fold = metrics.log_loss(scored(spark, d), "toxic", "p", by="fold")
    return metrics.fold_mean(per_fold, "log_loss").withColumn("mean_log_loss", F.round("mean_log_loss", 8))
