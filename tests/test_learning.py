"""Properties of factorisation, embeddings, selection and boosted models."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardloom.catalog import learning
from cardloom.catalog.flows import SETTING
from cardloom.operators import factor, models, pivots, select, sequences
from cardloom.plans import outliers
from cardloom.session import stage_path
from cardloom.sources import tables, views

FAST = {"maxIter": 2, "maxDepth": 2, "seed": 1}


@pytest.fixture(scope="module")
def cells(spark, sf):
    return tables.stage(pivots.category_matrix(views.transactions(spark, sf), "card_id", "city_id", "purchase_amount"), "cells")


def dense(cells, value):
    rows = cells.select("card_id", "category", value).collect()
    cards, cities = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    a = np.zeros((len(cards), len(cities)))
    for c, k, v in rows:
        a[cards.index(c), cities.index(k)] = v
    return cards, a


def test_nmf_is_non_negative_and_converges(cells):
    found = factor.nmf(cells, "card_id", "category", "n", components=4, tolerance=1e-5)
    cards, a = dense(cells, "n")
    w = np.array([r[1:] for r in sorted(found.scores.collect())])
    h = np.array([r[1:] for r in sorted(found.loadings.collect())]).T
    assert (w >= 0).all() and (h >= 0).all() and w.shape == (len(cards), 4)
    assert all(later <= earlier + 1e-6 for earlier, later in zip(found.sizes, found.sizes[1:]))
    assert np.linalg.norm(a - w @ h) == pytest.approx(found.sizes[-1], rel=1e-3) and len(found.sizes) < 200
    # At the end no loading can be moved alone to reduce the residual by much.
    slope = (w @ h - a) @ h.T
    assert np.abs(np.where(w > 1e-8, slope, np.minimum(slope, 0))).max() < 0.05 * np.abs(a @ h.T).max()


def test_nmf_with_cells_in_rows_equals_nmf_by_joins(spark, sf, cells, monkeypatch):
    odd = cells.select("card_id", "category", "n").unionByName(spark.createDataFrame(
        [(1, 3, 2), (1, 3, 2), (2, 4, None), (None, 3, 9), (4, None, 9), (10 ** 9, 99, None)], "card_id long, category int, n long"))
    joined = factor.nmf(odd, "card_id", "category", "n", components=3, rounds=12, few=0)
    monkeypatch.setattr(factor, "product", None)  # no join of cells and factors is left
    found = factor.nmf(odd, "card_id", "category", "n", components=3, rounds=12)
    assert np.allclose(found.sizes, joined.sizes, rtol=1e-9)
    for a, b in ((found.scores, joined.scores), (found.loadings, joined.loadings)):
        a, b = sorted(map(tuple, a.collect())), sorted(map(tuple, b.collect()))
        assert [r[0] for r in a] == [r[0] for r in b] and np.allclose(a, b, rtol=1e-6, atol=1e-8)


@pytest.mark.parametrize("category, value, widest", [("city_id", "amount", 320), ("merchant_category_id", "amount", 320), ("merchant_category_id", "n", 36)])
def test_svd_scores_equal_numpy_up_to_sign(spark, sf, category, value, widest):
    cells = tables.stage(pivots.category_matrix(views.transactions(spark, sf), "card_id", category, "purchase_amount"), "cells")
    found = factor.svd(cells, "card_id", "category", value, components=4, widest=widest, rounds=400)
    cards, a = dense(cells, value)
    rows = sorted(found.scores.collect())
    assert [r[0] for r in rows] == cards
    u, s, _ = np.linalg.svd(a, full_matrices=False)
    assert np.allclose(found.sizes, s[:4], rtol=1e-9)
    assert np.allclose(np.abs([r[1:] for r in rows]), np.abs(u[:, :4] * s[:4]), rtol=1e-4, atol=1e-5 * s[0])


def test_factors_of_few_cells(spark):
    empty = spark.createDataFrame([], "k long, c string, x double")
    assert factor.svd(empty, "k", "c", "x").scores.count() == factor.nmf(empty, "k", "c", "x").scores.count() == factor.gram(empty, "k", "c", "x").count() == 0
    few = spark.createDataFrame([(1, "a", 3.0), (1, "b", 4.0), (2, "a", 0.0), (2, "b", None), (None, "a", 9.0), (3, None, 9.0)], "k long, c string, x double")
    scores = {r[0]: abs(r[1]) for r in factor.svd(few, "k", "c", "x", components=1).scores.collect()}
    assert scores[1] == pytest.approx(5.0) and scores[2] == pytest.approx(0.0)
    assert {(r[0], r[1]): r[2] for r in factor.gram(few, "k", "c", "x").collect()} == {("a", "a"): 9, ("a", "b"): 12, ("b", "a"): 12, ("b", "b"): 16}


def test_a_gram_matrix_of_many_tiles(spark):
    rng = np.random.default_rng(3)
    a = rng.integers(0, 3, (40, 700)) * (rng.random((40, 700)) < 0.3)
    i, j = np.nonzero(a)
    cells = spark.createDataFrame([(int(x), int(y), int(a[x, y])) for x, y in zip(i, j)], "k int, c int, x int")
    made = np.zeros((700, 700))
    for r in factor.gram(cells, "k", "c", "x").collect():
        made[r[0], r[1]] = r[2]
    assert (made == a.T @ a).all()


def test_correlation_skips_missing_pairs(spark):
    rng = np.random.default_rng(0)
    a, b = rng.random(60), rng.random(60)
    rows = [(float(x), None if i % 4 == 0 else float(x + y), 1.0) for i, (x, y) in enumerate(zip(a, b))]
    matrix = select.correlation_matrix(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"])
    keep = np.arange(60) % 4 != 0
    assert matrix[0, 1] == pytest.approx(np.corrcoef(a[keep], (a + b)[keep])[0, 1])
    assert np.isnan(matrix[2]).all()


def test_selector_finds_planted_columns(spark, sf):
    selector = select.FeatureSelector(learning.selectable(spark, sf), label="target")
    assert selector.identify_missing(0.6) == ["mostly_missing"]
    assert selector.identify_single_unique() == ["constant"]
    assert "visits_copy" in selector.identify_collinear(0.99)
    assert "constant" in selector.identify_zero_importance("regression", runs=1, **FAST)
    assert selector.tables["importance"].agg(F.sum("normalized_importance")).first()[0] == pytest.approx(1)
    selector.identify_low_importance(0.9)
    left = selector.remove(["missing", "single_unique", "collinear"])
    assert not {"mostly_missing", "constant", "visits_copy"} & set(left.columns)
    assert set(selector.check_removal()) >= {"mostly_missing", "constant", "visits_copy"}


def test_selector_refuses_methods_that_were_not_run(spark, sf):
    selector = select.FeatureSelector(learning.selectable(spark, sf), label="target")
    with pytest.raises(NotImplementedError):
        selector.remove(["missing"])
    with pytest.raises(NotImplementedError):
        selector.identify_low_importance(0.9)
    with pytest.raises(ValueError):
        selector.identify_all({"missing_threshold": 0.5})


def test_narrowed_types_keep_values(spark):
    rows = spark.createDataFrame([(1, 300, 1.5), (-5, 40000, 2.25)], "a bigint, b bigint, c double")
    small = select.narrow_types(rows)
    assert [f.dataType.simpleString() for f in small.schema] == ["tinyint", "int", "float"]
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, rows.collect()))
    assert [f.dataType.simpleString() for f in select.halve_types(rows).schema] == ["int", "int", "float"]


def test_kfold_models_score_each_row_once_and_reload(spark, sf):
    table = learning.model_table(spark, sf)
    train, test = table.where("is_test = 0"), table.where("is_test = 1")
    result = models.kfold_boosting(train, learning.MODEL_FEATURES, "target", "fold", 3, "regression", test, **FAST)
    scored = result.oof.groupBy("card_id").count().agg(F.max("count"), F.count("*")).first()
    assert tuple(scored) == (1, train.count()) and result.test.count() == test.count()
    for r in result.importance.groupBy("fold").agg(F.sum("importance")).collect():
        assert r[1] == pytest.approx(1)
    path = stage_path(spark, "models")
    models.save_models(result.models, path)
    again = models.average_scores(test, learning.MODEL_FEATURES, models.load_models(path, 3, "regression"), "regression")
    assert dict(map(tuple, again.collect())) == pytest.approx(dict(map(tuple, result.test.collect())))


def test_outlier_chain_end_to_end(spark, sf):
    result = outliers.outlier_chain(views.cards(spark, sf), views.transactions(spark, sf), SETTING, k=2, budgets=(5, 5, 5), **FAST)
    assert result.stacked.oof.agg(F.min("prediction") >= 0, F.max("prediction") <= 1).first() == (True, True)
    assert 0 <= result.auc.first()[0] <= 1 and result.threshold.count() == 1
    assert result.regression.test.count() == views.cards(spark, sf).where("is_test = 1").count()


def test_word_vectors_factorise_the_association_of_neighbours(spark):
    rng = np.random.default_rng(5)
    talks = {k: [str(x) for x in (rng.integers(0, 5, 40) if k % 2 else rng.integers(4, 9, 40))] for k in range(6)}
    rows = [(k, at, w, None if w == "4" else "x") for k, words in talks.items() for at, w in enumerate(words)]
    table = spark.createDataFrame(rows, "k int, at int, w string, u string")
    got = {r["k"]: np.array([r[f"card_w_vec_{i}"] for i in range(3)]) for r in sequences.association_vectors(table, "k", ["w", "u"], ["at"], size=3, hot_rows=20).collect()}
    n = np.zeros((9, 9))
    for words in talks.values():
        for i, a in enumerate(words):
            for b in words[max(i - 3, 0):i] + words[i + 1:i + 4]:
                n[int(a), int(b)] += 1
    with np.errstate(divide="ignore"):
        x = np.maximum(np.log(n * n.sum() / np.outer(n.sum(1), n.sum(0))), 0)
    u, s, _ = np.linalg.svd(x)
    wanted = u[:, :3] * np.sqrt(s[:3])
    for k, words in talks.items():
        assert np.allclose(np.abs(got[k]), np.abs(np.mean([wanted[int(w)] for w in words], axis=0)), atol=1e-6)


@pytest.mark.parametrize("full", [0.0, 2.0])
def test_svd_of_few_categories_joins_no_cells(spark, monkeypatch, full):
    rng = np.random.default_rng(11)
    a = rng.random((300, 40)) * (rng.random((300, 40)) < 0.2)
    i, j = np.nonzero(a)
    cells = spark.createDataFrame([(int(x), f"c{y:02}", float(a[x, y])) for x, y in zip(i, j)] + [(None, "c00", 9.0), (1, None, 9.0), (999, "c00", None)],
                                  "k int, c string, x double")
    joined = factor.svd(cells, "k", "c", "x", components=3)
    monkeypatch.setattr(factor, "product", None)
    monkeypatch.setattr(factor, "FULL", full)
    found = factor.svd(cells, "k", "c", "x", components=3, held=factor.HELD)
    assert np.allclose(found.sizes, joined.sizes, rtol=1e-9) and np.allclose(found.sizes, np.linalg.svd(a, compute_uv=False)[:3], rtol=1e-9)
    for one, other in ((found.scores, joined.scores), (found.loadings, joined.loadings)):
        one, other = sorted(map(tuple, one.collect())), sorted(map(tuple, other.collect()))
        assert [r[0] for r in one] == [r[0] for r in other]
        assert np.allclose(np.abs([r[1:] for r in one]), np.abs([r[1:] for r in other]), rtol=1e-5, atol=1e-7)


def test_vectors_of_many_words_and_of_hot_keys_are_those_of_few(spark, monkeypatch):
    rng = np.random.default_rng(6)
    table = spark.createDataFrame([(None if k == 3 else k, at, str(rng.integers(0, 12))) for k in range(8) for at in range(30)], "k int, at int, w string")

    def vectors(**options):
        rows = sequences.association_vectors(table, "k", ["w"], ["at"], size=2, **options).collect()
        return [np.abs(r[1:]) for r in sorted(map(tuple, rows), key=str)]

    few = vectors()
    monkeypatch.setattr(sequences, "FEW_VECTORS", 0)
    assert np.allclose(few, vectors()) and np.allclose(few, vectors(hot_rows=20)) and len(few) == 8


def test_transactions_joined_step_by_step_are_the_same_and_keep_one_step(spark, tmp_path, monkeypatch, sf):
    plain = views.transactions(spark, sf)
    monkeypatch.setattr(views, "stage_path", lambda spark, name, made=iter(range(9)): f"{tmp_path}/{name}-{next(made)}")
    found = views.transactions(spark, sf, stepwise=True)
    assert [p.name for p in tmp_path.iterdir()] == ["lines-2"]
    assert found.schema == plain.schema and sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
