"""Model fits and their reports, on Spark's ML library.

Random splits are taken from a hash of the row key, so every report can be
repeated. A model is small next to its data; only metrics, importances and grid
points, a handful of rows each, are made into tables from the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import Binarizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GeneralizedLinearRegression,
    LinearRegression,
)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, functions as F

from tableworks.functions.vectors import dot
from tableworks.operators import metrics as mt
from tableworks.operators.cells import fit_stages
from tableworks.operators.features import assemble
from tableworks.operators.gamma import fit_gamma, gamma_mean
from tableworks.operators.split import Key, balance_over, balance_under, fold_pairs, kfold, \
    random_split, temporal_split, with_copies
from tableworks.session import dropped, held, shared_folder


# Recommender ---------------------------------------------------------------

#: Blocks of users and of items in a factorisation.
BLOCKS = 4
#: Iterations of a factorisation whose shuffled factors are on disk at once.
KEPT_ITERATIONS = 2


def fit_recommender(
    ratings: DataFrame, rank: int = 10, iters: int = 10, user: str = "userId",
    item: str = "movieId", rating: str = "rating", seed: int = 1, blocks: int = BLOCKS,
) -> ALSModel:
    """Matrix factorisation; pairs with an unknown side get no prediction.

    Each half step sends a factor to every block that has a rating of it, so what is moved
    grows with ``blocks`` and not with the tasks that work on them.  Item factors are written
    to the checkpoint folder every ``KEPT_ITERATIONS``: what was moved before is deleted then,
    and not after the last iteration.
    """
    context = ratings.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(ratings.sparkSession))
    return ALS(
        rank=rank, maxIter=iters, userCol=user, itemCol=item, ratingCol=rating, seed=seed,
        coldStartStrategy="drop", numUserBlocks=blocks, numItemBlocks=blocks, checkpointInterval=KEPT_ITERATIONS,
    ).fit(ratings)


def _folded_ratings(ratings: DataFrame, key: Key, k: int, seed: int, user: str = "userId", item: str = "movieId",
                    rating: str = "rating") -> DataFrame:
    """``fold`` and what a fit reads: the key gives the fold and isn't kept with every row."""
    return kfold(ratings, key, k, seed).select("fold", user, item, rating)


def cross_validate_recommender(
    ratings: DataFrame, key: Key, k: int = 5, ranks: Sequence[int] = (10, 5), iters: int = 10,
    seed: int = 111, parallelism: int = 4, **cols: str,
) -> DataFrame:
    """``rank, fold, rmse, mae``: every rank on every fold."""
    rating = cols.get("rating", "rating")
    folded = _folded_ratings(ratings, key, k, seed, **cols)

    def judge(task) -> tuple:
        rank, (fold, train, test) = task
        model = fit_recommender(train, rank, iters, **cols)
        scored = mt.regression_metrics(model.transform(test), rating).first()
        del model
        dropped(ratings.sparkSession)
        return rank, fold, scored.rmse, scored.mae

    tasks = [(rank, pair) for pair in fold_pairs(folded, k) for rank in ranks]
    # The fits are separate jobs: several at a time keep the cluster busy.
    with held(folded), ThreadPool(parallelism) as pool:
        rows = pool.map(inheritable_thread_target(ratings.sparkSession)(judge), tasks)
    return ratings.sparkSession.createDataFrame(rows, "rank int, fold int, rmse double, mae double")


def item_mean_errors(ratings: DataFrame, key: Key, k: int = 5, seed: int = 111, item: str = "movieId",
                     rating: str = "rating") -> DataFrame:
    """``fold, item_mean_rmse, item_mean_mae``: what each item's mean of the other folds reaches.

    Every fold's means follow from the item's sums, those of the fold taken off.
    """
    folded = kfold(ratings, key, k, seed).select("fold", F.col(item).alias("item"), F.col(rating).alias("rating"))
    own = folded.groupBy("item", "fold").agg(F.sum("rating").alias("s"), F.count("rating").alias("n"))
    whole = folded.groupBy("item").agg(F.sum("rating").alias("all_s"), F.count("rating").alias("all_n"))
    means = own.join(whole, "item").select("item", "fold", F.try_divide(F.col("all_s") - F.col("s"), F.col("all_n") - F.col("n")).alias("mean"))
    error = F.col("rating") - F.col("mean")
    return folded.join(means, ["item", "fold"]).where("mean is not null").groupBy("fold").agg(
        F.sqrt(F.avg(error * error)).alias("item_mean_rmse"), F.avg(F.abs(error)).alias("item_mean_mae")
    )


def ridge_residual(model: ALSModel, ratings: DataFrame, reg: float = 0.1, user: str = "userId", item: str = "movieId",
                   rating: str = "rating") -> DataFrame:
    """``user, residual, scale``: how far each user's factors are from solving their ridge equations.

    The last half step fits users to items: the sum of (x · y - r) x over a user's n items, and
    reg n y, is 0. ``scale`` is the size of the sum of r x.
    """
    # Factors are looked up by hash: ratings are moved as they are, not sorted, and widened afterwards.
    x = model.itemFactors.select(F.col("id").alias(item), F.col("features").alias("x")).hint("shuffle_hash")
    y = model.userFactors.select(F.col("id").alias(user), F.col("features").alias("y")).hint("shuffle_hash")
    rows = ratings.join(x, item).join(y, user).withColumns({c: F.col(c).cast("array<double>") for c in ("x", "y")})
    rows = rows.withColumn("e", dot(F.col("x"), F.col("y")) - F.col(rating))
    terms = rows.select(user, F.col(rating).alias("r"), "e", F.posexplode(F.arrays_zip("x", "y")).alias("i", "xy"))
    sums = terms.groupBy(user, "i").agg(
        (F.sum(F.col("e") * F.col("xy.x")) + reg * F.count("*") * F.first("xy.y")).alias("left"), F.sum(F.col("r") * F.col("xy.x")).alias("right")
    )
    size = lambda c: F.sqrt(F.sum(F.col(c) * F.col(c)))
    return sums.groupBy(F.col(user).alias("user")).agg(size("left").alias("residual"), size("right").alias("scale"))


def fold_clusters(
    ratings: DataFrame, key: Key, k: int = 5, rank: int = 10, clusters: int = 20, seed: int = 111,
    parallelism: int = 4, **cols: str,
) -> DataFrame:
    """``model, item, cluster``: the item clusters of the recommender of each fold."""
    folded = _folded_ratings(ratings, key, k, seed, **cols)

    def one(task) -> DataFrame:
        fold, train, _ = task
        items = cluster_items(fit_recommender(train, rank, **cols), clusters)
        return items.select(F.lit(fold).alias("model"), "item", "cluster")

    with held(folded), ThreadPool(parallelism) as pool:
        parts = pool.map(inheritable_thread_target(ratings.sparkSession)(one), list(fold_pairs(folded, k)))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def cluster_items(model: ALSModel, k: int = 20, seed: int = 11) -> DataFrame:
    """``item, cluster``: k-means over the item factors."""
    factors = model.itemFactors.select("id", array_to_vector("features").alias("features"))
    fitted = KMeans(k=k, seed=seed).fit(factors)
    return fitted.transform(factors).select(
        F.col("id").alias("item"), F.col("prediction").alias("cluster")
    )


# Classifiers and their grid ------------------------------------------------

def fit_tree(df: DataFrame, names: Sequence[str], label: str = "label", depth: int = 15,
             bins: int = 32, seed: int = 111) -> PipelineModel:
    tree = DecisionTreeClassifier(labelCol=label, maxDepth=depth, maxBins=bins, seed=seed)
    return fit_stages(df, [assemble(names), tree])


def fit_tree_threshold(df: DataFrame, names: Sequence[str], label: str = "label", depth: int = 15,
                       bins: int = 16, at: float = 0.5, seed: int = 111) -> PipelineModel:
    """A regression tree whose prediction above ``at`` means class 1."""
    tree = DecisionTreeRegressor(
        labelCol=label, predictionCol="bin_prediction", maxDepth=depth, maxBins=bins, seed=seed
    )
    cut = Binarizer(threshold=at, inputCol="bin_prediction", outputCol="prediction")
    return fit_stages(df, [assemble(names), tree, cut])


def fit_logistic(df: DataFrame, names: Sequence[str], label: str = "label", reg: float = 0.01,
                 iters: int = 10, elastic_net: float = 0.0) -> PipelineModel:
    model = LogisticRegression(
        labelCol=label, regParam=reg, maxIter=iters, elasticNetParam=elastic_net
    )
    return Pipeline(stages=[assemble(names), model]).fit(df)


def classifier_report(model: PipelineModel, test: DataFrame, label: str = "label") -> DataFrame:
    """``accuracy, precision, recall, f1`` of the 0/1 predictions and ``auc``, one row.

    The area is that of the model's scores: the probability of class 1, or the
    prediction before it is cut, or else the 0/1 prediction itself.
    """
    out = model.transform(test)
    if "probability" in out.columns:
        score = vector_to_array("probability")[1]
    else:
        score = F.col("bin_prediction" if "bin_prediction" in out.columns else "prediction")
    judged = out.select(label, "prediction", score.alias("score"))
    with held(judged):
        row = mt.binary_metrics(judged, label).first()
        area = mt.auc(judged, label, "score").first()[0]
    return test.sparkSession.createDataFrame(
        [(*row, area)], "accuracy double, precision double, recall double, f1 double, auc double"
    )


class Family(NamedTuple):
    stages: list
    points: list[dict]


class Grid(NamedTuple):
    table: DataFrame
    best: Model


def classifier_families(
    names: Sequence[str], label: str = "label", depths: Sequence[int] = (5, 10, 15),
    tree_bins: Sequence[int] = (16, 32), threshold_bins: Sequence[int] = (6, 16, 32),
    regs: Sequence[float] = (0.01, 0.05), iters: Sequence[int] = (10, 100),
    nets: Sequence[float] = (0.0, 0.1),
) -> dict[str, Family]:
    """Trees, thresholded regression trees and logistic regression: 6 + 9 + 8 points."""
    vector = assemble(names)
    tree = DecisionTreeClassifier(labelCol=label, seed=111)
    rtree = DecisionTreeRegressor(labelCol=label, predictionCol="bin_prediction", seed=111)
    cut = Binarizer(threshold=0.5, inputCol="bin_prediction", outputCol="prediction")
    logit = LogisticRegression(labelCol=label)
    grid = ParamGridBuilder
    return {
        "tree": Family([vector, tree], grid().addGrid(tree.maxDepth, list(depths))
                       .addGrid(tree.maxBins, list(tree_bins)).build()),
        "tree_threshold": Family([vector, rtree, cut], grid().addGrid(rtree.maxDepth, list(depths))
                                 .addGrid(rtree.maxBins, list(threshold_bins)).build()),
        "logistic": Family([vector, logit], grid().addGrid(logit.regParam, list(regs))
                           .addGrid(logit.maxIter, list(iters))
                           .addGrid(logit.elasticNetParam, list(nets)).build()),
    }


def grid_search(
    df: DataFrame, families: Mapping[str, Family], key: Key, folds: int = 3, parallelism: int = 4,
    label: str = "label", seed: int = 16,
) -> Grid:
    """All points of all families under one cross-validation, several fits at a time.

    The table is ``family, point, params, metric`` (accuracy); ``best`` is the
    best point of all, fitted again on every row.
    """
    pipeline = Pipeline(stages=[])
    points, names = [], []
    for family, (stages, settings) in families.items():
        for setting in settings:
            points.append({pipeline.stages: stages, **setting})
            names.append((family, {p.name: str(v) for p, v in setting.items()}))
    folded = kfold(df, key, folds, seed)
    validator = CrossValidator(
        estimator=pipeline, estimatorParamMaps=points, numFolds=folds, foldCol="fold",
        evaluator=MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy"),
        parallelism=parallelism,
    )
    with held(folded):
        fitted = validator.fit(folded)
    rows = [(f, i, p, float(m)) for i, ((f, p), m) in enumerate(zip(names, fitted.avgMetrics))]
    table = df.sparkSession.createDataFrame(
        rows, "family string, point int, params map<string,string>, metric double"
    )
    return Grid(table, fitted.bestModel)


def fit_best(train: DataFrame, families: Mapping[str, Family], table: DataFrame) -> dict[str, PipelineModel]:
    """The best grid point of each family, fitted on ``train``; ``table`` is a grid's."""
    settings = [(family, s) for family, f in families.items() for s in f.points]
    best: dict[str, int] = {}
    for row in table.orderBy(F.desc("metric"), "point").collect():  # one row per grid point
        best.setdefault(row.family, row.point)
    return {f: fit_stages(train, families[f].stages, settings[i][1]) for f, i in best.items()}


def rank_importance(model: Model, names: Sequence[str], k: int = 3, by: str = "signed") -> DataFrame:
    """``rank, feature, importance`` of a fitted tree, forest or linear model.

    ``by='abs'`` ranks coefficients by size, ``'signed'`` as they are.
    """
    last = model
    if isinstance(model, PipelineModel):
        last = [s for s in model.stages if not isinstance(s, (VectorAssembler, Binarizer))][-1]
    values = last.featureImportances if hasattr(last, "featureImportances") else last.coefficients
    measure = abs if by == "abs" else float
    pairs = sorted(zip(names, map(float, values.toArray())), key=lambda p: (-measure(p[1]), p[0]))
    rows = [(i, n, v) for i, (n, v) in enumerate(pairs[:k], 1)]
    return _session().createDataFrame(rows, "rank int, feature string, importance double")


def _session() -> SparkSession:
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


# Claims: linear, forest, two-part ------------------------------------------

def fit_linear(df: DataFrame, features: str = "pcaFeatures", label: str = "label", reg: float = 0.01,
               weight: str | None = None):
    linear = LinearRegression(featuresCol=features, labelCol=label, regParam=reg, fitIntercept=True)
    return (linear.setWeightCol(weight) if weight else linear).fit(df)


def sampling_versions(
    df: DataFrame, key: Key, label: str = "label", year: str = "year", cut: int = 2007,
    weights: Sequence[float] = (0.75, 0.25), seed: int = 666, literal: bool = False, copies: str | None = None,
) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Train and test part of the full, positive, under- and over-sampled data.

    Balancing touches the training part only. ``literal`` balances first and
    splits afterwards, which puts copies of one row on both sides. ``copies`` names a column
    that holds how often a row is over-sampled, in place of its copies.
    """
    by_year = temporal_split(df.where(F.col(label) > 0), year, cut)
    train, test = random_split(df, weights, seed, key)
    versions = {
        "full": (train, test),
        "positives": tuple(by_year.where(F.col("part") == p).drop("part") for p in ("train", "test")),
    }
    for name, balance in (("under", balance_under), ("over", balance_over)):
        if literal:
            # Copies of a row are told apart by their number.
            copied = name == "over"
            drawn = balance(df, label, key, **({"copy_no": "copy_no"} if copied else {}))
            row = [*([key] if isinstance(key, str) else key), *(["copy_no"] if copied else [])]
            versions[name] = tuple(p.drop("copy_no") for p in random_split(drawn, weights, seed, row))
        elif copies and name == "over":
            versions[name] = (with_copies(train, label, key, name=copies).where(F.col(copies) > 0), test)
        else:
            versions[name] = (balance(train, label, key), test)
    return versions


def compare_samplings(versions: Mapping[str, tuple[DataFrame, DataFrame]], features: str = "pcaFeatures",
                      label: str = "label", reg: float = 0.01, copies: str | None = None) -> DataFrame:
    """``data, train_rows, test_rows, rmse, r2`` of a linear regression on each.

    A training part with a column ``copies`` stands for as many rows as it says. A part is
    read once to fit or to judge and once to count, so none is kept: kept rows would be as
    large as the data several times over.
    """
    rows = []
    for name, (train, test) in versions.items():
        weight = copies if copies in train.columns else None
        judged = fit_linear(train, features, label, reg, weight).transform(test)
        m = mt.regression_metrics(judged, label).crossJoin(judged.agg(F.count("*").alias("n"))).first()
        drawn = train.agg(F.sum(weight) if weight else F.count("*")).first()[0] or 0
        rows.append((name, drawn, m.n, m.rmse, m.r2))
    return _session().createDataFrame(
        rows, "data string, train_rows bigint, test_rows bigint, rmse double, r2 double"
    )


def fit_forest(train: DataFrame, features: str = "pcaFeatures", label: str = "label",
               trees: int = 10, depth: int = 30, seed: int = 1, weight: str | None = None,
               memory_mb: int = 1024) -> PipelineModel:
    """Claim or no claim: a forest on ``label`` above 0 (``bin_labels``).

    ``weight`` names a column of draws (``with_copies``): a row drawn often is one weighted
    row, not written copies. Rows carry the node they are in, so a deep level costs no walk
    from the root, and nodes are split as many at a time as ``memory_mb`` holds.
    """
    forest = RandomForestClassifier(
        labelCol="bin_labels", featuresCol=features, numTrees=trees, maxDepth=depth, seed=seed,
        cacheNodeIds=True, checkpointInterval=10, maxMemoryInMB=memory_mb,
    )
    if weight:
        train = train.where(F.col(weight) > 0)
        forest = forest.setWeightCol(weight)
    return Pipeline(stages=[Binarizer(threshold=0.0, inputCol=label, outputCol="bin_labels"), forest]).fit(train)


def fit_two_part(judged: DataFrame, features: str = "pcaFeatures", label: str = "label",
                 link: str = "inverse", iters: int = 50):
    """Gamma regression on rows predicted and observed positive.

    Returns the fit and its R² on those rows. The inverse link is fitted by ``fit_gamma``,
    whose steps stay where every mean is positive; ``log`` by the library.
    """
    both = judged.where((F.col("prediction") > 0) & (F.col(label) > 0)).select(features, label)
    with held(both):
        if link == "inverse":
            fit = fit_gamma(both, features, label, iters)
            means = both.withColumn("gamma_prediction", gamma_mean(fit, features))
        else:
            fit = GeneralizedLinearRegression(
                labelCol=label, featuresCol=features, predictionCol="gamma_prediction", family="gamma",
                link=link, maxIter=iters,
            ).fit(both)
            means = fit.transform(both)
        r2 = mt.regression_metrics(means, label, "gamma_prediction").first().r2
    return fit, r2
