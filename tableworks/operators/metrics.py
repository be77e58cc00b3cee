"""Metrics as DataFrame aggregates, one row each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tableworks.operators.ordering import row_index, running_totals


def regression_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """``rmse, mae, r2`` in one pass, per group when ``by`` is given."""
    y, p = F.col(label), F.col(prediction)
    squares = F.sum((y - p) * (y - p))
    spread = F.var_pop(y) * F.count(y)
    return df.groupBy(*by).agg(
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        F.avg(F.abs(y - p)).alias("mae"),
        (1 - F.try_divide(squares, spread)).alias("r2"),
    )


def binary_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", positive: float = 1,
    by: Sequence[str] = (),
) -> DataFrame:
    """``accuracy, precision, recall, f1`` of the positive class."""
    y, p = F.col(label), F.col(prediction)
    tp = F.count_if((y == positive) & (p == positive))
    fp = F.count_if((y != positive) & (p == positive))
    fn = F.count_if((y == positive) & (p != positive))
    return df.groupBy(*by).agg(
        F.avg((y == p).cast("double")).alias("accuracy"),
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, tp + fn).alias("recall"),
        F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def micro_f1(
    df: DataFrame, labels: Sequence[str], label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """``tp, fp, fn, f1`` over the chosen labels; others count as background."""
    y, p = F.col(label), F.col(prediction)
    tp = F.count_if((y == p) & y.isin(*labels))
    fp = F.count_if((y != p) & p.isin(*labels))
    fn = F.count_if((y != p) & y.isin(*labels))
    return df.agg(
        tp.alias("tp"), fp.alias("fp"), fn.alias("fn"),
        F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def auc(df: DataFrame, label: str = "label", score: str = "score", swapped: bool = False) -> DataFrame:
    """Area under ROC with ties at their middle rank.

    Only distinct scores are sorted. ``swapped`` gives the two columns each
    other's part.
    """
    if swapped:
        label, score = score, label
    groups = df.where(F.col(label).isNotNull() & F.col(score).isNotNull()).groupBy(
        F.col(score).cast("double").alias("score")
    ).agg(
        F.count_if(F.col(label) > 0.5).alias("pos"), F.count_if(F.col(label) <= 0.5).alias("neg")
    )
    ranked = running_totals(groups, [F.col("score")], {"neg_run": F.col("neg")})
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    won = F.sum(pos * (F.col("neg_run") - neg / 2))
    return ranked.agg(F.try_divide(won, F.sum(pos) * F.sum(neg)).alias("auc"))


def gini_normalized(df: DataFrame, actual: str, predicted: str, key: str | Sequence[str]) -> DataFrame:
    """Gini of the losses in order of prediction, over that of the best order.

    Ties of the prediction are in key order; the key must be unique. The best
    order needs no tie-break, so it is sorted by distinct loss only.
    """
    keys = [key] if isinstance(key, str) else list(key)
    loss = F.col("loss")

    narrow = df.select(F.col(actual).alias("loss"), F.col(predicted).alias("_p"), *keys)
    ranked = row_index(narrow, [F.desc("_p"), *map(F.col, keys)], "place", start=1)
    given = ranked.agg(
        F.max("place").alias("n"), F.sum("loss").alias("total"),
        F.sum(loss * F.col("place")).alias("placed"),
    )
    sizes = narrow.groupBy("loss").agg(F.count("*").alias("n"))
    tops = running_totals(sizes, [F.desc("loss")], {"last": F.col("n")})
    n, last = F.col("n").cast("double"), F.col("last").cast("double")
    best = tops.agg(F.sum(loss * n * (2 * last - n + 1) / 2)).scalar()

    def gini(placed):
        rows = F.col("n")
        sums = (rows + 1) * F.col("total") - placed
        return (F.try_divide(sums, "total") - (rows + 1) / 2) / rows

    return given.select(
        gini(F.col("placed")).alias("gini"), gini(best).alias("best"),
        F.try_divide(gini(F.col("placed")), gini(best)).alias("normalized"),
    )


def fold_summary(metrics: DataFrame, names: Sequence[str] = ("rmse", "mae"),
                 by: Sequence[str] = ()) -> DataFrame:
    """Mean and population standard deviation of each metric over the folds."""
    return metrics.groupBy(*by).agg(
        *[F.avg(n).alias(f"avg_{n}") for n in names],
        *[F.stddev_pop(n).alias(f"std_{n}") for n in names],
    )


def best_per_family(table: DataFrame, family: str = "family", point: str = "params",
                    metric: str = "metric", order: str = "point") -> DataFrame:
    """Best grid point of each family; the first one wins a tie."""
    best = F.min_by(F.struct(point, metric), F.struct(-F.col(metric), F.col(order))).alias("_b")
    return table.groupBy(family).agg(best).select(family, f"_b.{point}", f"_b.{metric}")
