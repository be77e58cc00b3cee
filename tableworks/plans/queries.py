"""The named queries: ``name -> function(spark, sf_dir) -> DataFrame``.

Real numbers are rounded, since engines add them up in different orders, and
lists are shown as text.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from tableworks.functions import text as tx
from tableworks.operators import (
    clusters as cl,
    corpus as co,
    features as fe,
    gamma as ga,
    langmodel as lm,
    metrics as mt,
    models as mo,
    nextword as nw,
    perceptron as pe,
    similarity as si,
    split as sp,
    tagger as ta,
    treegrid as tg,
    weblog as wl,
)
from tableworks import sources as so
from tableworks.plans import views as v
from tableworks.session import shared_folder, written
from tableworks.sources import writers as wr

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _round(df: DataFrame, places: int = 6, *cols: str) -> DataFrame:
    names = cols or [n for n, t in df.dtypes if t == "double"]
    return df.withColumns({n: F.round(n, places) for n in names})


def _text(col: str):
    return F.array_join(col, " ").alias(col)


# Files -----------------------------------------------------------------------
#
# Each writes its rows in one file layout and reads them back.

def _new_file(spark, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/tableworks/file-{name}-{uuid4().hex}"


@query
def file_access_log(spark, sf):
    path = _new_file(spark, "log")
    wr.write_lines(v.log_lines(spark, sf), F.col("value"), path, "gzip")
    return so.read_access_log(spark, path, partitions=4)


@query
def file_ratings(spark, sf):
    path = _new_file(spark, "ratings")
    wr.write_csv(v.ratings(spark, sf).select("userId", "movieId", "rating", F.lit(0).alias("timestamp")), path)
    return so.read_ratings(spark, path)


@query
def file_tag_scores(spark, sf):
    scores, names = _new_file(spark, "scores"), _new_file(spark, "tags")
    wr.write_csv(v.tag_scores(spark, sf), scores)
    wr.write_csv(v.tag_names(spark, sf), names)
    return _round(so.read_tag_scores(spark, scores).join(so.read_tags(spark, names), "tagId"))


@query
def file_numeric(spark, sf):
    path, names = _new_file(spark, "numeric"), ["label", *v.NUMERIC_FEATURES]
    wr.write_csv(v.numeric(spark, sf).select(*names), path, header=False, compression="gzip")
    return so.read_numeric_csv(spark, path, names, partitions=4)


@query
def file_claims(spark, sf):
    path = _new_file(spark, "claims")
    wr.write_csv(v.claim_file(spark, sf), path, null="?")
    back = so.read_claims(spark, path)
    return _round(back.groupBy("Calendar_Year", "Cat1", "Cat2", "OrdCat", "NVCat").agg(
        F.count("*").alias("n"), F.count("Cat3").alias("known"), F.sum("Vehiclhe").alias("vehicles"),
        F.sum("Var1").alias("var1"), F.sum("NVVar4").alias("nvvar4"), F.sum("label").alias("label"),
    ), 4)


@query
def file_documents(spark, sf):
    path = _new_file(spark, "docs")
    wr.write_labelled_docs(v.labelled_documents(spark, sf), path)
    return so.read_labelled_docs(spark, path).select("doc_id", "label", F.length("text").alias("chars"), F.md5("text").alias("digest"))


@query
def file_corpus(spark, sf):
    path = _new_file(spark, "corpus")
    wr.write_lines(co.document_lines(v.documents(spark, sf)), F.col("line"), path)
    return so.read_corpus(spark, path).groupBy(_text("tokens")).agg(F.count("*").alias("n"))


@query
def file_questions(spark, sf):
    path = _new_file(spark, "questions")
    plain = F.transform("tokens", lambda t: F.translate(t, ":/", "__"))
    cand = lambda i: F.translate(F.max(F.when(F.col("cand_no") == i, F.col("cand"))), ":/", "__")
    asked = v.questions(spark, sf).groupBy("q_id", plain.alias("tokens")).agg(cand(1).alias("first"), cand(2).alias("second"))
    wr.write_lines(asked, wr.question_line(), path)
    return so.read_questions(spark, path).groupBy(_text("tokens"), "cand_no", "cand").agg(F.count("*").alias("n"))


@query
def file_tagged(spark, sf):
    path = _new_file(spark, "tagged")
    wr.write_lines(v.tagged(spark, sf), wr.tagged_line(), path)
    return so.read_tagged(spark, path, form="rows").groupBy("pos", "word", "tag").agg(F.count("*").alias("n"))


# Web log ---------------------------------------------------------------------

@query
def access_log_parse(spark, sf):
    return wl.parse_access_log(v.raw_log(spark, sf))


@query
def access_log_report(spark, sf):
    return wl.parse_report(v.raw_log(spark, sf))


@query
def access_log_weekday(spark, sf):
    return _round(wl.weekday_average(wl.parse_access_log(v.raw_log(spark, sf))))


@query
def top_paths(spark, sf):
    return wl.top_values(wl.parse_access_log(v.raw_log(spark, sf)), "path", "%.gif%", 20)


# Splits and balancing ----------------------------------------------------------

@query
def complete_rows(spark, sf):
    return sp.complete_rows(v.claims(spark, sf)).select("row_key", "year", "brand", "type")


@query
def kfold_sizes(spark, sf):
    folded = sp.kfold(v.table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 5, 111)
    return folded.groupBy("fold").agg(F.count("*").alias("n"))


@query
def hash_split(spark, sf):
    return sp.hash_split(v.table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", [0.8, 0.2], 666)


@query
def hash_sample(spark, sf):
    return sp.hash_sample(v.table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.25, 91)


@query
def head_split(spark, sf):
    docs = v.labelled_documents(spark, sf).select("doc_id", "label")
    return sp.head_split(docs, "label", "doc_id", 40, 10)


@query
def shuffle_order(spark, sf):
    return sp.shuffle_order(v.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 999)


@query
def temporal_split(spark, sf):
    rows = v.claims(spark, sf).where("label > 0").select("row_key", "year", "label")
    return sp.temporal_split(rows, "year", v.CLAIM_CUT).select("row_key", "part")


@query
def class_counts(spark, sf):
    return sp.class_counts(v.claims(spark, sf), "label")


@query
def balance_under(spark, sf):
    return _round(sp.balance_under(v.claims(spark, sf).select("row_key", "label"), "label", "row_key", 12))


@query
def balance_over(spark, sf):
    drawn = sp.balance_over(v.claims(spark, sf).select("row_key", "label"), "label", "row_key", 111)
    return _round(drawn.groupBy("row_key", "label").agg(F.count("*").alias("copies")))


# Clusters ----------------------------------------------------------------------

@query
def largest_clusters(spark, sf):
    return cl.largest_clusters(v.assignment(spark, sf), 3)


@query
def cluster_profile(spark, sf):
    profile = cl.cluster_profile(v.assignment(spark, sf), v.tag_scores(spark, sf), v.tag_names(spark, sf))
    return _round(profile, 6)


@query
def cluster_profile_outer(spark, sf):
    profile = cl.cluster_profile(
        v.wide_assignment(spark, sf), v.tag_scores(spark, sf), v.tag_names(spark, sf),
        top_clusters=50, k=1000, keep_unmatched=True,
    )
    return _round(profile, 6)


# Features ----------------------------------------------------------------------

@query
def category_index(spark, sf):
    return fe.category_index(v.claims(spark, sf), v.CLAIM_CATEGORIES)


@query
def threshold(spark, sf):
    return fe.threshold(v.claims(spark, sf).select("row_key", "label"), "label", 0.0, "claimed").select(
        "row_key", "claimed"
    )


@query
def correlation_matrix(spark, sf):
    return _round(fe.correlation_matrix(v.numeric(spark, sf), [*v.NUMERIC_FEATURES, "label"]))


PCA_SIZE = 25


def _claims_vectors(spark, sf):
    return fe.claims_features(
        v.claims(spark, sf), v.CLAIM_CATEGORIES, v.CLAIM_MEASURES, ["row_key", "year", "label"]
    )


@query
def claims_features(spark, sf):
    """Vector size, the places that are not 0 in the one-hot part, the measures."""
    rows = _claims_vectors(spark, sf).withColumn("a", vector_to_array("features"))
    size, measures = F.size("a"), len(v.CLAIM_MEASURES)
    hot = F.filter(F.sequence(F.lit(0), size - measures - 1), lambda i: F.element_at("a", i + 1) != 0)
    return rows.select(
        "row_key", size.alias("dims"), F.array_join(hot, " ").alias("hot"),
        *[F.round(F.element_at("a", i - measures), 4).alias(m) for i, m in enumerate(v.CLAIM_MEASURES)],
    )


@query
def pca_explained(spark, sf):
    """25 components of rows whose variance the price makes; each solves its equation."""
    vectors = written(_claims_vectors(spark, sf), "vectors")
    model = fe.fit_pca(vectors, PCA_SIZE)
    reduced, explained = fe.reduce_pca(vectors, PCA_SIZE, model=model)
    sound = 0.99 < explained <= 1 + 1e-9 and float(model.residuals.max()) < 1e-6 * model.trace
    return reduced.select(
        "row_key", F.size(vector_to_array("pcaFeatures")).alias("dims"), F.round(F.lit(model.trace), 0).alias("trace"), F.lit(sound).alias("sound")
    )


# Metrics -----------------------------------------------------------------------

def _rule(spark, sf):
    """A rule of thumb for the price of a line, to have something to measure."""
    return v.numeric(spark, sf).select(
        "row_key", F.col("price").alias("label"), (F.col("quantity") * 1500).alias("prediction"),
    )


@query
def metrics_regression(spark, sf):
    return _round(mt.regression_metrics(_rule(spark, sf)), 4)


@query
def metrics_binary(spark, sf):
    return _round(mt.binary_metrics(v.numeric(spark, sf)))


@query
def metrics_auc(spark, sf):
    return _round(mt.auc(v.numeric(spark, sf), "label", "price"))


@query
def gini_normalized(spark, sf):
    return _round(mt.gini_normalized(_rule(spark, sf), "label", "prediction", "row_key"))


def _fold_metrics(spark, sf):
    return mt.regression_metrics(sp.kfold(_rule(spark, sf), "row_key", 5, 111), by=["fold"])


@query
def cv_fold_metrics(spark, sf):
    return _round(_fold_metrics(spark, sf), 4)


@query
def fold_summary(spark, sf):
    return _round(mt.fold_summary(_fold_metrics(spark, sf)), 4)


GRID_RULES = {"quantity": [10, 25, 40], "discount": [0.02, 0.05, 0.08], "tax": [0.02, 0.04, 0.06]}


@query
def grid_best(spark, sf):
    """Accuracy of one-column rules at several cuts, best cut per column; one scan."""
    rows = v.numeric(spark, sf)
    points = [(f, at) for f, cuts in GRID_RULES.items() for at in cuts]
    wide = rows.agg(*[
        F.avg(((F.col(f) > at).cast("double") == F.col("label")).cast("double")).alias(f"m{i}")
        for i, (f, at) in enumerate(points)
    ])
    table = wide.select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("family"), F.lit(i).alias("point"), F.lit(float(at)).alias("params"),
                 F.col(f"m{i}").alias("metric"))
        for i, (f, at) in enumerate(points)
    ])))
    return _round(mt.best_per_family(table))


# Texts -------------------------------------------------------------------------

@query
def bag_of_words(spark, sf):
    bag = co.bag_of_words(v.documents(spark, sf), orders=(1, 2))
    return bag.select("doc_id", "n_order", _text("feature"), "n")


@query
def ngram_counts(spark, sf):
    return co.ngram_counts(v.sentences(spark, sf), "tokens", 2).select(_text("gram"), "n")


@query
def ngram_vocabulary(spark, sf):
    return co.ngram_vocabulary(v.documents(spark, sf), orders=(1, 2)).select("n_order", _text("feature"))


@query
def vocabulary(spark, sf):
    return co.vocabulary(v.documents(spark, sf), tx.word_runs("text"))


@query
def lm_unigram(spark, sf):
    return lm.ngram_probs(v.sentences(spark, sf), 1).select(
        _text("gram"), "n", "p"
    )


@query
def lm_bigram(spark, sf):
    return lm.ngram_probs(v.sentences(spark, sf), 2).select(
        _text("gram"), "n", "p"
    )


@query
def lm_bigram_conditional(spark, sf):
    return lm.ngram_probs(v.sentences(spark, sf), 2, kind="conditional").select(
        _text("gram"), "n", "p"
    )


def _add_one(spark, sf):
    extra = lm.candidate_grams(v.questions(spark, sf), 2)
    return lm.ngram_probs(v.sentences(spark, sf), 2, smoothing=1, extra=extra)


@query
def lm_bigram_add1(spark, sf):
    return _add_one(spark, sf).select(_text("gram"), "n", "p")


@query
def lm_mass(spark, sf):
    lines = v.sentences(spark, sf)
    masses = None
    for n in (1, 2):
        row = lm.mass(lm.ngram_probs(lines, n)).select(F.lit(n).alias("n"), F.round("mass", 6).alias("mass"))
        masses = row if masses is None else masses.unionByName(row)
    return masses


def _answers(spark, sf, probs, n):
    return _round(lm.cloze_answers(v.questions(spark, sf), probs, n))


@query
def cloze_unigram(spark, sf):
    return _answers(spark, sf, lm.ngram_probs(v.sentences(spark, sf), 1), 1)


@query
def cloze_bigram(spark, sf):
    return _answers(spark, sf, lm.ngram_probs(v.sentences(spark, sf), 2), 2)


@query
def cloze_add1(spark, sf):
    return _answers(spark, sf, _add_one(spark, sf), 2)


@query
def context_pairs(spark, sf):
    pairs = lm.context_pairs(v.sentences(spark, sf))
    return pairs.groupBy("w1", "w2", "next").agg(F.count("*").alias("n"))


@query
def next_word(spark, sf):
    return lm.next_word(lm.context_pairs(v.sentences(spark, sf)))


@query
def sentence_logprob(spark, sf):
    pairs = lm.context_pairs(v.sentences(spark, sf), keep=("sent_id",))
    return _round(lm.sentence_logprob(pairs, lm.next_word(pairs)), 4)


@query
def next_word_accuracy(spark, sf):
    pairs = lm.context_pairs(v.sentences(spark, sf))
    return _round(lm.pair_accuracy(pairs, lm.next_word(pairs)))


# Perceptron --------------------------------------------------------------------

EPOCHS = 10
TAG_EPOCHS = 5


def _polarity(spark, sf, part: int | None = None, orders=(1,)):
    docs = v.labelled_documents(spark, sf)
    if part is not None:
        docs = docs.where(F.col("part") == part)
    return co.bag_of_words(docs, orders=orders), docs.select("doc_id", "label")


@query
def perceptron_weights(spark, sf):
    weights = pe.fit_perceptron(*_polarity(spark, sf), epochs=EPOCHS)
    return weights.select(_text("feature"), "weight")


@query
def perceptron_ngram_weights(spark, sf):
    weights = pe.fit_perceptron(*_polarity(spark, sf, orders=(1, 2, 3)), epochs=2)
    return weights.select(F.size("feature").alias("n_order"), _text("feature"), "weight")


@query
def perceptron_predict(spark, sf):
    weights = pe.fit_perceptron(*_polarity(spark, sf, 0), epochs=EPOCHS)
    bags, docs = _polarity(spark, sf, 1)
    return pe.predict_perceptron(bags, docs, weights)


@query
def perceptron_extremes(spark, sf):
    weights = pe.fit_perceptron(*_polarity(spark, sf), epochs=EPOCHS)
    return pe.extreme_features(weights, 10).select("side", "rank", _text("feature"), "weight")


@query
def perceptron_epochs(spark, sf):
    return _round(pe.perceptron_epochs(*_polarity(spark, sf, 0), *_polarity(spark, sf, 1), epochs=EPOCHS))


@query
def perceptron_mixing(spark, sf):
    weights = pe.fit_perceptron(*_polarity(spark, sf), epochs=EPOCHS, mode="mixing", docs_per_shard=100)
    return weights.select(_text("feature"), F.round("weight", 6).alias("weight"))


# Tagging -----------------------------------------------------------------------

def _tagged(spark, sf, part: int):
    return v.tagged(spark, sf).where(F.col("part") == part).drop("part")


@query
def word_tag_counts(spark, sf):
    return ta.word_tag_counts(v.tagged(spark, sf))


@query
def tag_pair_counts(spark, sf):
    return ta.tag_pair_counts(v.tagged(spark, sf))


@query
def tag_features(spark, sf):
    return ta.tag_features(_tagged(spark, sf, 1), ta.feature_table(_tagged(spark, sf, 0)))


@query
def tagger_weights(spark, sf):
    return ta.fit_tagger(v.tagged(spark, sf), epochs=TAG_EPOCHS)


@query
def tagger_greedy(spark, sf):
    weights = ta.fit_tagger(_tagged(spark, sf, 0), epochs=TAG_EPOCHS)
    return ta.decode_greedy(_tagged(spark, sf, 1), weights)


@query
def tag_f1(spark, sf):
    weights = ta.fit_tagger(_tagged(spark, sf, 0), epochs=TAG_EPOCHS)
    test = _tagged(spark, sf, 1)
    both = ta.tag_accuracy(test, ta.decode_greedy(test, weights))
    return _round(mt.micro_f1(both, ["ORG", "MISC", "PER", "LOC"]))


@query
def tagger_top_features(spark, sf):
    train = v.tagged(spark, sf)
    vocab = train.select(F.explode("words").alias("word")).distinct()
    return ta.top_features(ta.fit_tagger(train, epochs=TAG_EPOCHS), vocab=vocab)


@query
def tagger_transition_weights(spark, sf):
    return ta.fit_tagger(_tagged(spark, sf, 0), transitions=True, epochs=TAG_EPOCHS)


@query
def tagger_viterbi(spark, sf):
    weights = ta.fit_tagger(_tagged(spark, sf, 0), transitions=True, epochs=TAG_EPOCHS)
    return ta.decode_viterbi(_tagged(spark, sf, 1), weights)


@query
def tagger_beam(spark, sf):
    """Width 1 without transitions: the same answer as token by token."""
    weights = ta.fit_tagger(_tagged(spark, sf, 0), epochs=TAG_EPOCHS)
    return ta.decode_beam(_tagged(spark, sf, 1), weights, width=1)


# Vectors -----------------------------------------------------------------------

@query
def cosine_pairs(spark, sf):
    pairs = v.vector_questions(spark, sf).select(F.col("id").alias("id_1"), F.col("a").alias("id_2"))
    return _round(si.cosine_pairs(v.vectors(spark, sf), pairs))


@query
def nearer(spark, sf):
    return _round(si.nearer(v.vectors(spark, sf), v.vector_questions(spark, sf)).where(
        "cosine_a is not null and cosine_b is not null"))


@query
def word_vectors(spark, sf):
    """A vector for every word; the leading one solves its equation."""
    found = si.word_vectors(v.sentences(spark, sf), size=5)
    solves = found.residuals[0] < 0.3 * abs(found.values[0])
    return found.vectors.select("word", F.size("vector").alias("size"), F.lit(solves).alias("solves"))


@query
def words_nearer(spark, sf):
    """Word vectors in use: is a word nearer to the word two or four places on?"""
    sentences = v.sentences(spark, sf)
    vectors = si.word_vectors(sentences, size=5).vectors.withColumnRenamed("word", "id")
    asked = sentences.where(F.size("tokens") >= 5).select(
        F.col("tokens")[0].alias("id"), F.col("tokens")[2].alias("a"), F.col("tokens")[4].alias("b")
    ).distinct()
    found = si.nearer(vectors, asked)
    sound = F.col("cosine_a").isNotNull() & F.col("cosine_b").isNotNull() & F.col("choice").isin(F.col("a"), F.col("b"))
    return found.select("id", "a", "b", sound.alias("answered"))


# Models ------------------------------------------------------------------------
#
# What a fit learns differs between engines. These queries give what SQL can tell as well
# (rows, what a constant or a mean would reach) and whether the fit does clearly better.

@query
def als_cv(spark, sf):
    """Errors of both ranks on all folds, well under those of each item's mean."""
    ratings = v.ratings(spark, sf)
    table = mo.cross_validate_recommender(ratings, "row_key", k=5, ranks=(10, 5))
    plain = mo.item_mean_errors(ratings, "row_key", k=5)
    sound = (F.col("rmse") < 0.7 * F.col("item_mean_rmse")) & (F.col("mae") < 0.7 * F.col("item_mean_mae"))
    return _round(table.join(plain, "fold").select("rank", "fold", "item_mean_rmse", "item_mean_mae", sound.alias("sound")), 4)


@query
def als_clusters(spark, sf):
    """Item clusters: they separate what items differ by, and the factors solve their equations."""
    ratings = v.ratings(spark, sf)
    model = mo.fit_recommender(ratings)
    assigned = mo.cluster_items(model, k=20)
    part = (F.col("item") % 4).cast("double")
    inside = assigned.groupBy("cluster").agg(F.count("*").alias("n"), F.var_pop(part).alias("v"))
    inside = inside.agg((F.sum(F.col("n") * F.col("v")) / F.sum("n")).alias("inside"))
    whole = assigned.agg(F.count("*").alias("items"), F.var_pop(part).alias("whole"))
    left = mo.ridge_residual(model, ratings).agg(F.max(F.col("residual") / F.col("scale")).alias("left"))
    facts = (*whole.first(), inside.first()[0], left.first()[0])
    return spark.createDataFrame(
        [(facts[0], facts[2] < 0.3 * facts[1], facts[3] < 1e-3)], "items bigint, separates boolean, solves boolean"
    )


@query
def als_fold_profiles(spark, sf):
    """Profiles of the largest clusters of the five fold models: what each has."""
    assigned = written(mo.fold_clusters(v.ratings(spark, sf), "row_key"), "clusters")
    profile = cl.cluster_profile(assigned, v.tag_scores(spark, sf), v.tag_names(spark, sf), by=["model"])
    items = assigned.groupBy("model").agg(F.count("*").alias("items"))
    rows = profile.groupBy("model").agg(
        F.count_distinct("cluster").alias("clusters"), F.max("rank").alias("tags")
    )
    return items.join(rows, "model")


def _train_test(spark, sf):
    return sp.random_split(v.measured(spark, sf), [0.8, 0.2], 44, "row_key")


def _facts(test, report, label="label", above=0.15, area=0.75):
    """Rows, positives and the larger share of the test part; are accuracy and area clearly better than that and a half?"""
    share = F.greatest(F.avg(label), 1 - F.avg(label))
    good = (F.lit(report.accuracy) >= share + above) & F.lit(report.auc).between(area, 1)
    return _round(test.agg(
        F.count("*").alias("test_rows"), F.sum(label).cast("bigint").alias("positives"), share.alias("majority"), good.alias("sound")
    ))


def _classifier(spark, sf, fit):
    train, test = _train_test(spark, sf)
    return _facts(test, mo.classifier_report(fit(train, v.NUMERIC_FEATURES), test).first())


@query
def tree_classifier(spark, sf):
    return _classifier(spark, sf, mo.fit_tree)


@query
def tree_threshold(spark, sf):
    return _classifier(spark, sf, mo.fit_tree_threshold)


@query
def logistic(spark, sf):
    return _classifier(spark, sf, mo.fit_logistic)


@query
def tree_importance(spark, sf):
    """The two features that make the label, the weightier one first."""
    model = mo.fit_tree(_train_test(spark, sf)[0], v.NUMERIC_FEATURES)
    return mo.rank_importance(model, v.NUMERIC_FEATURES, 2).select("rank", "feature", F.col("importance").between(0.1, 0.9).alias("sound"))


def _params(col: str):
    keys = F.array_sort(F.map_keys(col))
    return F.array_join(F.transform(keys, lambda k: F.concat(k, F.lit("="), F.col(col)[k])), " ")


@query
def grid_search(spark, sf):
    """All 23 points of the three families; every one is clearly better than the larger class."""
    rows = v.measured(spark, sf)
    table = tg.grid_table(rows, v.NUMERIC_FEATURES, "row_key", folds=3)
    share = rows.agg(F.greatest(F.avg("label"), 1 - F.avg("label"))).scalar()
    return table.select("family", "point", _params("params").alias("params"), (F.col("metric") > share + 0.1).alias("sound"))


@query
def grid_models(spark, sf):
    """The best of the 23 points of the whole grid for each family, fitted on all training rows and judged."""
    train, test = _train_test(spark, sf)
    families = mo.classifier_families(v.NUMERIC_FEATURES)
    table = tg.grid_table(train, v.NUMERIC_FEATURES, "row_key", folds=3, families=families)
    out = None
    for family, model in mo.fit_best(train, families, table).items():
        facts = _facts(test, mo.classifier_report(model, test).first())
        top = mo.rank_importance(model, v.NUMERIC_FEATURES).count()
        facts = facts.select(F.lit(family).alias("family"), "*", F.lit(top).alias("features"))
        out = facts if out is None else out.unionByName(facts)
    return out


def _reduced_claims(spark, sf):
    """Read by every version of the data, so it is worked out once and written."""
    return written(fe.reduce_pca(_claims_vectors(spark, sf), PCA_SIZE)[0], "claims")


@query
def claims_linear(spark, sf):
    """Four versions of the training rows, each judged beside the spread of its test labels."""
    versions = mo.sampling_versions(_reduced_claims(spark, sf), "row_key", cut=v.CLAIM_CUT, copies="copies")
    table = mo.compare_samplings(versions, copies="copies")
    # Positives hang on the price alone; balanced rows overrate every claim, but stay in its range.
    least = F.when(F.col("data") == "positives", 0.9).when(F.col("data") == "full", 0.01).otherwise(-5)
    spread = F.col("rmse") / F.sqrt(1 - F.col("r2"))
    return _round(table.select("data", "test_rows", spread.alias("spread"), (F.col("r2") > least).alias("sound")), 4)


def _forest(spark, sf):
    """A forest on over-sampled rows as weights, and its judgement of the test rows."""
    train, test = sp.random_split(_reduced_claims(spark, sf), (0.75, 0.25), 666, "row_key")
    train = sp.with_copies(train, "label", "row_key")
    return written(mo.fit_forest(train, weight="copies").transform(test).select(
        "row_key", "label", "pcaFeatures", "bin_labels", "prediction", vector_to_array("probability")[1].alias("score")
    ), "forest")


@query
def claims_forest(spark, sf):
    judged = _forest(spark, sf)
    area = mt.auc(judged, "bin_labels", "score").first()[0]
    return judged.agg(F.count("*").alias("test_rows"), F.sum("bin_labels").cast("bigint").alias("positives"), F.lit(area > 0.6).alias("sound"))


@query
def claims_gamma(spark, sf):
    """Intercept and 25 coefficients of the inverse link: each solves its score equation."""
    both = _forest(spark, sf).where("prediction > 0 and label > 0")
    fit, _ = mo.fit_two_part(both)
    score = ga.score_equations(fit, both)
    return score.select(F.col("term").cast("int").alias("term"), (F.abs("score") <= 1e-5 * F.col("scale")).alias("solved"))


@query
def next_word_net(spark, sf):
    """Every word of the vocabulary can be predicted; accuracy and loss stand against word frequencies alone."""
    pairs = lm.context_pairs(v.sentences(spark, sf))
    net = nw.fit_next_word(pairs)
    judged = nw.log_loss(net, pairs).first()
    counts = pairs.groupBy("w1", "w2", "next").agg(F.count("*").alias("n"))
    best = nw.likeliest(net, pairs)
    right = counts.join(best, ["w1", "w2"]).agg(F.sum(F.when(F.col("next") == F.col("predicted"), F.col("n")).otherwise(0))).first()[0]
    words = counts.groupBy("next").agg(F.sum("n").alias("n"))
    total = F.sum("n")
    entropy = F.log(total) - F.sum(F.col("n") * F.log("n")) / total
    return _round(words.agg(
        total.alias("pairs"), F.count("*").alias("words"), (F.max("n") / total).alias("commonest"),
        (F.lit(right) > 1.1 * F.max("n")).alias("beats_commonest"), (F.lit(judged.loss) < entropy).alias("beats_frequencies"),
    ))
