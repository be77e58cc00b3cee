"""Counting features of texts: bags of words, n-grams, vocabularies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tableworks.functions import text as tx
from tableworks.operators.ordering import row_index


#: Text of the documents that are placed together.
PLACE_BYTES = 4 * 2**20


def document_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, line_no, line``: every line of every document."""
    return df.select(doc_id, F.posexplode(tx.lines(text)).alias("line_no", "line"))


def count_features(df: DataFrame, features: str | Column, name: str = "feature") -> DataFrame:
    """Count each member of an array column over the whole table."""
    return (
        df.select(F.explode(features).alias(name)).groupBy(name).agg(F.count("*").alias("n"))
    )


def gram_rows(df: DataFrame, items: str, n: int, keep: Sequence[str] = ()) -> DataFrame:
    """One row per n-gram of a list column: ``keep…, gram``."""
    rows = df.select(*keep, F.inline(tx.ngrams(items, n)))
    return rows.select(*keep, F.array(*[f"g{i + 1}" for i in range(n)]).alias("gram"))


def _feature_rows(
    df: DataFrame, tokens: str, orders: Sequence[int], stop: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """One row per feature of any of the orders: ``keep…, feature``."""
    width = max(orders)
    lists = [
        tx.ngrams(tx.without_words(tokens, stop) if n == 1 else F.col(tokens), n, width)
        for n in orders
    ]
    rows = df.select(*keep, F.inline(F.concat(*lists)))
    members = F.array(*[f"g{i + 1}" for i in range(width)])
    return rows.select(*keep, F.slice(members, 1, F.col("size")).alias("feature"))


def bag_of_words(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    orders: Sequence[int] = (1,),
    stop: Sequence[str] = tx.STOP_WORDS,
    order_weights: Mapping[int, int] | None = None,
) -> DataFrame:
    """``doc_id, n_order, feature, n`` with ``feature`` the list of its words.

    Stop words are left out of the single words only. Documents are placed by id
    before they are taken apart, so the wide exchange moves the texts once and
    the much larger list of features never moves; the result stays placed by id. The places
    follow from the size of the texts: joined to larger ones, as small exchanges are, they
    would hold more features than fit into memory.
    """
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    places = max(df.sparkSession.sparkContext.defaultParallelism, -(-size // PLACE_BYTES))
    tokens = df.repartition(places, doc_id).select(doc_id, tx.word_runs(text).alias("tokens"))
    features = _feature_rows(tokens, "tokens", orders, stop, [doc_id])
    bag = features.groupBy(doc_id, "feature").agg(F.count("*").alias("n"))
    order = F.size("feature")
    n = F.col("n")
    if order_weights:
        weights = [F.when(order == o, n * w) for o, w in order_weights.items()]
        n = F.coalesce(*weights, n)
    return bag.select(doc_id, order.alias("n_order"), "feature", n.alias("n"))


def vocabulary(df: DataFrame, tokens: str | Column, name: str = "word") -> DataFrame:
    """Distinct members of an array column, numbered from 0 in their order."""
    words = df.select(F.explode(tokens).alias(name)).distinct()
    return row_index(words, [F.col(name)], "ix")


def ngram_vocabulary(
    df: DataFrame, text: str = "text", orders: Sequence[int] = (1, 2)
) -> DataFrame:
    """Distinct features of several orders: ``n_order, feature``."""
    tokens = df.select(tx.word_runs(text).alias("tokens"))
    features = _feature_rows(tokens, "tokens", orders, ())
    return features.distinct().select(F.size("feature").alias("n_order"), "feature")


def ngram_counts(df: DataFrame, tokens: str, n: int, marks: bool = True) -> DataFrame:
    """Count the n-grams of a token column, by default with sentence marks."""
    items = tx.marked(tokens) if marks else F.col(tokens)
    rows = gram_rows(df.select(items.alias("items")), "items", n)
    return rows.groupBy("gram").agg(F.count("*").alias("n"))
