import math
import random

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tableworks.operators import (
    features as fe, langmodel as lm, metrics as mt, models as mo, similarity as si, split as sp,
)

random.seed(3)


def test_binary_metrics_and_auc_both_ways(spark):
    rows = [(1.0, 1.0)] * 3 + [(0.0, 1.0)] + [(1.0, 0.0)] * 2 + [(0.0, 0.0)] * 4
    df = spark.createDataFrame(rows, "label double, prediction double")
    m = mt.binary_metrics(df).first()
    assert (m.accuracy, m.precision, m.recall) == (0.7, 0.75, 0.6) and m.f1 == pytest.approx(2 / 3)
    assert mt.auc(df, score="prediction").first().auc == pytest.approx(0.7)
    assert mt.auc(df, score="prediction", swapped=True).first().auc == pytest.approx(0.70833333)
    signed = df.select((2 * F.col("label") - 1).alias("label"), (2 * F.col("prediction") - 1).alias("prediction"))
    assert tuple(mt.binary_metrics(signed).first()) == tuple(m)


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(i, float(random.random() < 0.4), round(random.random(), 1), random.random() * 5) for i in range(300)]
    return spark.createDataFrame(rows, "id int, label double, score double, actual double").cache()


def test_auc_and_regression_equal_the_evaluators(scored):
    exact = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(scored)
    assert mt.auc(scored).first().auc == pytest.approx(exact)
    row = mt.regression_metrics(scored, "actual", "score").first()
    for name in ("rmse", "mae", "r2"):
        e = RegressionEvaluator(labelCol="actual", predictionCol="score", metricName=name)
        assert row[name] == pytest.approx(e.evaluate(scored))


def _gini(actual, predicted):
    order = sorted(range(len(actual)), key=lambda i: (-predicted[i], i))
    run = np.cumsum([actual[i] for i in order])
    return (run.sum() / run[-1] - (len(actual) + 1) / 2) / len(actual)


def test_gini_equals_sorting(scored):
    rows = scored.orderBy("id").collect()
    actual, predicted = [r.actual for r in rows], [r.score for r in rows]
    got = mt.gini_normalized(scored, "actual", "score", "id").first()
    assert got.gini == pytest.approx(_gini(actual, predicted))
    assert got.normalized == pytest.approx(_gini(actual, predicted) / _gini(actual, actual))


def test_fold_summary_is_population_std(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 6.0)], "rmse double, mae double")
    assert tuple(mt.fold_summary(df).first()) == (2.0, 4.0, 1.0, 2.0)


def test_best_per_family_first_wins(spark):
    df = spark.createDataFrame(
        [("a", 0, "x", 0.5), ("a", 1, "y", 0.5), ("b", 2, "z", 0.1)],
        "family string, point int, params string, metric double")
    assert sorted(map(tuple, mt.best_per_family(df).collect())) == [("a", "x", 0.5), ("b", "z", 0.1)]


def test_category_index_equals_the_indexer(spark):
    rows = [(random.choice("abcd"), random.choice(["x", "y", None])) for _ in range(60)]
    df = spark.createDataFrame(rows, "p string, q string")
    table = {(r.column, r.value): r.ix for r in fe.category_index(df, ["p", "q"]).collect()}
    fitted = fe.index_categories(["p", "q"]).setHandleInvalid("skip").fit(df)
    for col, labels in zip(["p", "q"], fitted.labelsArray):
        assert [table[(col, v)] for v in labels] == list(range(len(labels)))


def test_correlation_equals_the_ml_library(scored):
    cols = ["label", "score", "actual"]
    cells = {(r.row_name, r.col_name): r.corr for r in fe.correlation_matrix(scored, cols).collect()}
    matrix = fe.correlation_of_vectors(scored, cols)
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            assert cells[(a, b)] == pytest.approx(matrix[i][j])


def test_features_and_pca(spark):
    rows = [(i, random.choice("abc"), 1990 + i % 3, float(i), float(i % 7)) for i in range(50)] + [(50, None, 1990, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "id int, make string, model_year int, v double, w double")
    out = fe.claims_features(df, ["make", "model_year"], ["v", "w"], ["id"])
    assert out.count() == 50 and out.first().features.size == 2 + 2 + 2
    reduced, explained = fe.reduce_pca(out, 2)
    assert reduced.columns == ["id", "pcaFeatures"] and 0.9 < explained <= 1.0
    assert {r.c for r in fe.threshold(df, "v", 0.0, "c").collect()} == {0.0, 1.0}


def test_vectors(spark):
    v = spark.createDataFrame([("m", [1.0, 0.0]), ("p", [1.0, 1.0]), ("q", [0.0, 2.0]), ("z", [0.0, 0.0])],
                              "id string, vector array<float>")
    pairs = spark.createDataFrame([("m", "p"), ("m", "q"), ("m", "z")], "id_1 string, id_2 string")
    got = {(r.id_1, r.id_2): r.cosine for r in si.cosine_pairs(v, pairs).collect()}
    assert got[("m", "p")] == pytest.approx(1 / math.sqrt(2)) and got[("m", "q")] == 0 and got[("m", "z")] is None
    asked = spark.createDataFrame([("m", "p", "q"), ("q", "m", "m")], "id string, a string, b string")
    assert {r.id: r.choice for r in si.nearer(v, asked).collect()} == {"m": "p", "q": "m"}


@pytest.fixture(scope="module")
def separable(spark):
    rows = [(i, float(i % 2), i % 2 + random.random() * 0.4, random.random()) for i in range(200)]
    return spark.createDataFrame(rows, "id int, label double, x double, noise double").cache()


def test_classifiers(separable):
    names = ["x", "noise"]
    for fit, settings in ((mo.fit_tree, {"depth": 2}), (mo.fit_tree_threshold, {"depth": 2}), (mo.fit_logistic, {})):
        model = fit(separable, names, **settings)
        report = mo.classifier_report(model, separable).first()
        assert report.accuracy > 0.95
        judged = model.transform(separable)
        assert report.auc == pytest.approx(mt.auc(judged, score="prediction").first().auc)
        assert mo.rank_importance(model, names, 1).first().feature == "x"


def test_importance_by_size(separable):
    flipped = separable.withColumn("x", -F.col("x"))
    model = mo.fit_logistic(flipped, ["x", "noise"])
    assert mo.rank_importance(model, ["x", "noise"], 1, by="abs").first().feature == "x"
    assert mo.rank_importance(model, ["x", "noise"], 1).first().feature == "noise"


def test_grid(separable):
    assert sum(len(f.points) for f in mo.classifier_families(["x"]).values()) == 23
    families = mo.classifier_families(
        ["x", "noise"], depths=(1,), tree_bins=(16,), threshold_bins=(16,), regs=(0.01,), iters=(5,), nets=(0.0,))
    grid = mo.grid_search(separable, families, "id", folds=3)
    rows = grid.table.collect()
    assert [r.family for r in rows] == ["tree", "tree_threshold", "logistic"]
    assert all(r.metric > 0.9 for r in rows) and rows[0].params["maxDepth"] == "1"
    assert mt.best_per_family(grid.table).count() == 3
    assert grid.best.transform(separable).where("prediction = label").count() > 190


def test_recommender(spark):
    rows = [(u, i, float((u * i) % 5 + 1)) for u in range(12) for i in range(10)]
    ratings = spark.createDataFrame(rows, "userId int, movieId int, rating double")
    table = mo.cross_validate_recommender(ratings, ["userId", "movieId"], k=2, ranks=(3, 2), iters=2)
    assert {(r["rank"], r.fold) for r in table.collect()} == {(3, 0), (3, 1), (2, 0), (2, 1)}
    assigned = mo.cluster_items(mo.fit_recommender(ratings, 3, 2), k=3)
    assert assigned.count() == 10 and {r.cluster for r in assigned.collect()} <= {0, 1, 2}


def test_claims(spark):
    rows = [(i, str(2005 + i % 3), float(i % 17), float(i % 5), 50.0 + i % 17 if i % 4 == 0 else 0.0) for i in range(240)]
    df = spark.createDataFrame(rows, "id int, year string, a double, b double, label double")
    vectors = fe.assemble(["a", "b"], "pcaFeatures").transform(df)
    versions = mo.sampling_versions(vectors, "id", cut=2007)
    train, test = versions["over"]
    assert not {r.id for r in train.collect()} & {r.id for r in test.collect()}
    literal = mo.sampling_versions(vectors, "id", cut=2007, literal=True)["over"]
    assert {r.id for r in literal[0].collect()} & {r.id for r in literal[1].collect()}
    table = mo.compare_samplings(versions).collect()
    assert [r.data for r in table] == ["full", "positives", "under", "over"]
    weighted = sp.with_copies(versions["full"][0], "label", "id")
    judged = mo.fit_forest(weighted, trees=3, depth=3, weight="copies").transform(train)
    assert "bin_labels" in judged.columns and judged.where("prediction = bin_labels").count() > 0.5 * train.count()
    model, r2 = mo.fit_two_part(judged.withColumn("prediction", F.lit(1.0)), link="log")
    assert len(model.coefficients) == 2 and r2 > 0.5


def test_over_sampling_by_weight_keeps_nothing(spark, monkeypatch):
    """Copies as weights give the fit of written copies, and no version of the rows is held."""
    rows = [(i, float(i % 9 == 0) * (i % 70 + 1), "2007" if i % 4 == 0 else "2005", i % 70 + (i * 37 % 11) / 11) for i in range(600)]
    rows += rows[:30]
    df = spark.createDataFrame(rows, "id int, label double, year string, x double")
    vectors = VectorAssembler(inputCols=["x"], outputCol="pcaFeatures").transform(df)
    written_out = mo.compare_samplings(mo.sampling_versions(vectors, "id")).collect()
    versions = mo.sampling_versions(vectors, "id", copies="copies")
    assert versions["over"][0].agg(F.sum("copies")).first()[0] == written_out[3].train_rows > versions["over"][0].count()
    kept = []
    monkeypatch.setattr(type(df), "persist", lambda self, *a: kept.append(self) or self)
    weighted = mo.compare_samplings(versions, copies="copies").collect()
    assert not kept
    for a, b in zip(weighted, written_out, strict=True):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:])


def test_spark_sampling_methods(spark):
    df = spark.range(200).withColumn("label", (F.col("id") % 4 == 0).cast("double"))
    assert sp.kfold(df, "id", 4, 1, method="spark").count() == 200
    assert 20 < sp.hash_sample(df, "id", 0.25, 1, method="spark").count() < 90
