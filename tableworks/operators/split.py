"""Train/test splits, folds, samples and class balancing.

Random choices hash a row key (``method='hash'``), so they are repeatable. The
same calls with ``method='spark'`` use Spark's own seeded samplers, whose result
depends on the partitioning of the input.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tableworks.functions import hashing as h
from tableworks.operators.ordering import rank_within, row_index

Key = str | Sequence[str]
# Row numbers up to this setting are cut down before the shuffle by the planner.
_GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def complete_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=list(subset) if subset else None)


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows, rows with a label above 0, rows with label 0: one pass."""
    value = F.col(label)
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(value > 0).alias("positives"),
        F.count_if(value == 0).alias("negatives"),
    )


def kfold(df: DataFrame, key: Key, k: int = 5, seed: int = 111, method: str = "hash") -> DataFrame:
    """Add ``fold`` in 0 … k-1."""
    if method == "spark":
        parts = df.randomSplit([1.0] * k, seed)
        out = parts[0].withColumn("fold", F.lit(0))
        for i, part in enumerate(parts[1:], 1):
            out = out.unionByName(part.withColumn("fold", F.lit(i)))
        return out
    return df.withColumn("fold", (h.bucket(key, seed) % k).cast("int"))


def fold_pairs(folded: DataFrame, k: int) -> Iterator[tuple[int, DataFrame, DataFrame]]:
    """Each fold in turn as the test part, the others as its training part."""
    for i in range(k):
        rest, held = folded.where(F.col("fold") != i), folded.where(F.col("fold") == i)
        yield i, rest.drop("fold"), held.drop("fold")


def _cuts(weights: Sequence[float]) -> list[int]:
    total, run, cuts = sum(weights), 0.0, []
    for w in weights[:-1]:
        run += w
        cuts.append(round(run / total * h.BUCKETS))
    return cuts


def hash_split(df: DataFrame, key: Key, weights: Sequence[float], seed: int) -> DataFrame:
    """Add ``part`` 0, 1, … with shares as weighted."""
    at = h.bucket(key, seed)
    part = F.lit(len(weights) - 1)
    for i, cut in reversed(list(enumerate(_cuts(weights)))):
        part = F.when(at < cut, F.lit(i)).otherwise(part)
    return df.withColumn("part", part)


def random_split(
    df: DataFrame, weights: Sequence[float], seed: int, key: Key | None = None
) -> list[DataFrame]:
    """The parts as separate tables; Spark's own split when there is no key."""
    if key is None:
        return df.randomSplit(list(weights), seed)
    parted = hash_split(df, key, weights, seed)
    return [parted.where(F.col("part") == i).drop("part") for i in range(len(weights))]


def hash_sample(
    df: DataFrame, key: Key | None, fraction: float, seed: int, method: str = "hash"
) -> DataFrame:
    """Sample without replacement."""
    if method == "spark":
        return df.sample(False, fraction, seed)
    return df.where(h.bucket(key, seed) < round(fraction * h.BUCKETS))


def _share(df: DataFrame, label: str, above: str, below: str) -> Column:
    """Ratio of two class counts as a one-row subquery."""
    return class_counts(df, label).select(F.try_divide(above, below)).scalar()


def balance_under(
    df: DataFrame, label: str, key: Key | None, seed: int = 12, method: str = "hash"
) -> DataFrame:
    """Keep every positive row and a sample of the rest at positives / rows."""
    positives, negatives = df.where(F.col(label) > 0), df.where(F.col(label) == 0)
    if method == "spark":
        c = class_counts(df, label).first()
        return positives.unionByName(negatives.sample(False, c.positives / c.total, seed))
    keep = h.unit(key, seed) < _share(df, label, "positives", "total")
    # One pass in place of a union of two scans.
    return df.where((F.col(label) > 0) | ((F.col(label) == 0) & keep))


def poisson_table(mean: Column) -> Column:
    """Shares of draws of at most 0, 1, 2 ... for a Poisson mean, as an array; up to 2^-32 of all draws."""
    last = (mean + 12 * F.sqrt(mean) + 30).cast("int")

    def further(a: Column, k: Column) -> Column:
        log = a["log"] + F.log(mean / k)
        total = a["total"] + F.exp(log)
        return F.struct(log.alias("log"), total.alias("total"), F.concat(a["table"], F.array(total)).alias("table"))

    none = F.exp(-mean)
    begin = F.struct((-mean).alias("log"), none.alias("total"), F.array(none).alias("table"))
    return F.aggregate(F.sequence(F.lit(1), last), begin, further, lambda a: a["table"])


def with_copies(df: DataFrame, label: str, key: Key, seed: int = 111, name: str = "copies") -> DataFrame:
    """Add how often each row is drawn when positives are sampled with replacement.

    rows/positives draws a row on average, as independent draws give them: the hash of a row
    is looked up in the table of the Poisson distribution. Other rows are drawn once, rows
    without a label never. A fit that takes weights needs no written copies.
    """
    counts = class_counts(df, label).where("positives > 0")
    table = counts.select(poisson_table(F.col("total") / F.col("positives"))).scalar()
    # The table is a column first: it is worked out once, not for each row. The hash is worked
    # out once for a row, not for each entry of the table.
    passed = F.zip_with("_poisson", F.array_repeat(h.unit(key, seed), F.size("_poisson")), lambda c, u: c <= u)
    drawn = F.size(F.filter(passed, lambda p: p))
    copies = F.when(F.col(label) > 0, drawn).when(F.col(label) == 0, 1)
    return df.withColumn("_poisson", table).withColumn(name, F.coalesce(copies, F.lit(0)).cast("int")).drop("_poisson")


def balance_over(
    df: DataFrame, label: str, key: Key | None, seed: int = 111, method: str = "hash",
    copy_no: str | None = None,
) -> DataFrame:
    """Draw positive rows with replacement, rows/positives times on average; others are kept once.

    ``copy_no`` names a column to number the copies of each row from 0.
    """
    if method == "spark":
        positives, negatives = df.where(F.col(label) > 0), df.where(F.col(label) == 0)
        c = class_counts(df, label).first()
        return negatives.unionByName(positives.sample(True, c.total / c.positives, seed))
    names = df.columns
    drawn = with_copies(df, label, key, seed, "_copies").select(
        *names, F.posexplode(F.array_repeat(F.lit(True), F.col("_copies"))).alias("_copy", "_one")
    )
    return drawn.select(*names, *([F.col("_copy").alias(copy_no)] if copy_no else []))


def temporal_split(df: DataFrame, col: str, cut: int) -> DataFrame:
    """Years before ``cut`` are ``train``, the year itself ``test``; others go."""
    year = F.col(col).try_cast("int")
    return df.withColumn(
        "part", F.when(year < cut, "train").when(year == cut, "test")
    ).where(F.col("part").isNotNull())


def head_split(df: DataFrame, label: str, order: str, n: int, m: int) -> DataFrame:
    """First ``n`` rows of each class are ``train``, the next ``m`` ``test``."""
    if n + m <= int(df.sparkSession.conf.get(_GROUP_LIMIT)):
        place = F.row_number().over(Window.partitionBy(label).orderBy(order))
        ranked = df.withColumn("_place", place).where(F.col("_place") <= n + m)
    else:
        # Long heads: a class may be most of the table, so it is numbered in slices.
        ranked = rank_within(df, [label], [F.col(order)], "_place").withColumn(
            "_place", F.col("_place") + 1
        ).where(F.col("_place") <= n + m)
    part = F.when(F.col("_place") <= n, "train").otherwise("test")
    return ranked.withColumn("part", part).drop("_place")


def shuffle_order(df: DataFrame, key: Key, seed: int) -> DataFrame:
    """Each row's ``position`` from 0 in a seeded random order.

    The labels travel with the rows. The key must be unique. Rows are not moved
    again to lie in that order; sort by ``position`` where that is wanted.
    """
    keyed = df.withColumn("_mix", h.shuffle_key(key, seed))
    names = [key] if isinstance(key, str) else list(key)
    order = [F.col("_mix"), *map(F.col, names)]
    return row_index(keyed, order, "position").drop("_mix")
