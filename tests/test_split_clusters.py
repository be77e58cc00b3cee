import math

import pytest
from pyspark.sql import functions as F

from tableworks.operators import clusters as cl, split as sp
from tableworks.operators.ordering import row_index, running_totals


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(1000).select(
        "id", F.when(F.col("id") % 10 == 0, 2.0).otherwise(0.0).alias("label")).cache()


def test_folds_cover_and_do_not_overlap(rows):
    folded = sp.kfold(rows, "id", 5, 1)
    seen = set()
    for _, train, test in sp.fold_pairs(folded, 5):
        ids = {r.id for r in test.collect()}
        assert not ids & seen and train.count() == 1000 - len(ids)
        seen |= ids
    assert len(seen) == 1000


def test_split_does_not_depend_on_partitioning(rows):
    a = {tuple(r) for r in sp.hash_split(rows, "id", [0.5, 0.3, 0.2], 9).collect()}
    b = {tuple(r) for r in sp.hash_split(rows.repartition(7), "id", [0.5, 0.3, 0.2], 9).collect()}
    assert a == b and {r[2] for r in a} == {0, 1, 2}
    parts = sp.random_split(rows, [0.8, 0.2], 3, "id")
    assert sum(p.count() for p in parts) == 1000 and 750 < parts[0].count() < 850
    assert sum(p.count() for p in sp.random_split(rows, [0.8, 0.2], 3)) == 1000
    assert 200 < sp.hash_sample(rows, "id", 0.25, 4).count() < 300


def test_balancing(rows):
    assert tuple(sp.class_counts(rows, "label").first()) == (1000, 100, 900)
    under = sp.balance_under(rows, "label", "id")
    assert under.where("label > 0").count() == 100 and 60 < under.where("label = 0").count() < 120
    over = sp.balance_over(rows, "label", "id", copy_no="c")
    assert over.where("label = 0").count() == 900 and 850 < over.where("label > 0").count() < 1150
    assert over.groupBy("id", "c").count().where("count > 1").count() == 0
    for method in (sp.balance_under, sp.balance_over):
        assert method(rows, "label", None, method="spark").count() > 100


def test_time_split_ignores_what_is_no_year(spark):
    df = spark.createDataFrame([("2005",), ("2007",), ("2008",), ("?",)], "y string")
    assert sorted(map(tuple, sp.temporal_split(df, "y", 2007).collect())) == [("2005", "train"), ("2007", "test")]


@pytest.mark.parametrize("limit", [1000, 0])
def test_head_split_both_ways(spark, limit):
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", str(limit))
    df = spark.createDataFrame([(c, f"{i:03d}") for c in (-1, 1) for i in range(9)], "label int, name string")
    out = sp.head_split(df, "label", "name", 5, 2).collect()
    spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    got = {(r.label, r.name): r.part for r in out}
    assert len(got) == 14 and got[(-1, "004")] == "train" and got[(1, "005")] == "test"


def test_shuffle_order_carries_labels(rows):
    out = sp.shuffle_order(rows, "id", 5).orderBy("position").collect()
    assert [r.position for r in out] == list(range(1000))
    assert [r.id for r in out] != list(range(1000))
    assert all((r.label > 0) == (r.id % 10 == 0) for r in out)


@pytest.mark.parametrize("positives", [2500, 250, 12])
def test_draws_with_replacement_are_poisson(spark, positives):
    """Mean and variance of the draws are both rows / positives, and the table is the distribution's."""
    rows = spark.range(5000).select("id", (F.col("id") < positives).cast("double").alias("label"))
    mean = 5000 / positives
    drawn = sp.with_copies(rows, "label", "id")
    got = drawn.where("label > 0").agg(F.avg("copies"), F.var_samp("copies")).first()
    assert abs(got[0] - mean) < 5 * math.sqrt(mean / positives)
    assert abs(got[1] - mean) < 5 * mean * math.sqrt(3 / positives)
    assert drawn.where("label = 0 and copies <> 1").count() == 0
    table = spark.range(1).select(sp.poisson_table(F.lit(mean))).first()[0]
    terms = [math.exp(-mean + k * math.log(mean) - math.lgamma(k + 1)) for k in range(len(table))]
    assert all(abs(t - sum(terms[: k + 1])) < 1e-9 for k, t in enumerate(table)) and 1 - table[-1] < 2**-32


def test_running_totals_over_many_slices(spark):
    df = spark.range(500).select(((F.col("id") * 37) % 500).alias("k"), (F.col("id") % 3).alias("v"))
    out = running_totals(df, [F.desc("k")], {"run": F.col("v")}).orderBy(F.desc("k")).collect()
    total = 0
    for r in out:
        total += r.v
        assert r.run == total
    assert [r.ix for r in row_index(df, [F.col("k")]).orderBy("k").collect()] == list(range(500))


def _profile_tables(spark):
    assign = spark.createDataFrame(
        [("m", i, c) for i, c in enumerate([0, 0, 0, 1, 1, 2, 2, 3])], "model string, item int, cluster int")
    scores = spark.createDataFrame(
        [(0, 1, 0.5), (1, 1, 0.5), (0, 2, 0.9), (3, 2, 0.1), (7, 1, 9.0)], "item int, tag_id int, relevance double")
    tags = spark.createDataFrame([(1, "one"), (2, "two")], "tag_id int, tag string")
    return assign, scores, tags


def test_largest_clusters_break_ties_by_number(spark):
    assign, _, _ = _profile_tables(spark)
    assert [tuple(r) for r in cl.largest_clusters(assign, 2).collect()] == [(0, 3), (1, 2)]
    assert cl.largest_clusters(assign, 2, ["model"]).count() == 2


def test_cluster_profile_inner_and_outer(spark):
    tables = _profile_tables(spark)
    inner = {tuple(r) for r in cl.cluster_profile(*tables, top_clusters=3).collect()}
    assert inner == {(0, 1, 1, "one", 1.0), (0, 2, 2, "two", 0.9), (1, 1, 2, "two", 0.1)}
    outer = {tuple(r) for r in cl.cluster_profile(*tables, top_clusters=3, keep_unmatched=True).collect()}
    assert outer - inner == {(0, 3, None, None, None), (1, 2, None, None, None), (2, 1, None, None, None)}
    many = cl.cluster_profile(*tables, top_clusters=3, by=["model"])
    assert many.columns[:2] == ["model", "cluster"] and many.count() == 3
