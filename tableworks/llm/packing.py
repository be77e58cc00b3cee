"""Packing sequences into optimal length buckets.

Texts are cut into pieces of at most ``max_length`` words.  The histogram of piece
lengths is counted over the whole corpus; it has at most ``max_length`` entries, a
parameter, whatever the corpus, so the driver can work on it.  Dynamic programming
over the histogram finds the bucket boundaries with the least padding.  Inside each
bucket pieces are put in hash order and cut into batches: as many pieces, padded to
the bucket's boundary, as the token budget holds.

Batches need the number of each piece in its bucket.  A bucket may hold most of the
rows, so it is numbered in slices: inside each slice, then shifted by the counts of
the slices before.  Only keys and lengths are shuffled, no text.

NULL, empty and blank texts are one piece of length 0; they are batched like others
(in the bucket of the shortest pieces), so that every document is in the result.
Repeated rows are packed separately.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from tableworks.functions.hashing import bucket
from tableworks.llm.common import WORD

MAX_LENGTH = 2048
BUDGET = 16384
BUCKETS = 8
SLICE_ROWS = 50_000


def boundaries(histogram: dict[int, int], buckets: int) -> list[int]:
    """Upper lengths of at most ``buckets`` buckets that pad the least; the last is the longest length.

    ``best[j]``: least padded total of the lengths up to the j-th with the buckets so
    far.  Each further bucket tries all last cuts of all j at once.
    """
    lengths = np.array(sorted(n for n, c in histogram.items() if c), dtype=np.int64)
    if not len(lengths):
        return []
    count = np.concatenate([[0], np.cumsum([histogram[int(n)] for n in lengths])]).astype(np.float64)
    k, m = min(buckets, len(lengths)), len(lengths)
    # Tokens with padding if pieces i .. j - 1 are one bucket; a bucket ends with its longest length.
    cost = lengths[None, :] * (count[None, 1:] - count[:-1, None])
    cost[np.arange(m)[:, None] > np.arange(m)[None, :]] = np.inf
    best, cuts = cost[0].copy(), [np.zeros(m, dtype=np.int64)]
    for _ in range(1, k):
        before = np.concatenate([[0.0], best[:-1]])
        total = before[:, None] + cost
        cuts.append(total.argmin(axis=0))
        best = total.min(axis=0)
    ends, j = [], m - 1
    for level in range(k - 1, -1, -1):
        ends.append(int(lengths[j]))
        j = int(cuts[level][j]) - 1
        if j < 0:
            break
    return ends[::-1]


def pieces_of(documents: DataFrame, text: str, key: str, max_length: int, seed: int) -> DataFrame:
    """``key, piece, first_word, n_tokens, order``: texts cut to ``max_length`` words."""
    sized = documents.select(
        F.col(key).alias("key"), F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long").alias("words"),
        bucket(key, seed).alias("order"),
    )
    cut = sized.withColumn("piece", F.explode(F.expr(f"sequence(0L, greatest(words - 1, 0) div {max_length})")))
    return cut.select(
        "key", "piece", F.expr(f"piece * {max_length}").alias("first_word"),
        F.expr(f"least({max_length}, words - piece * {max_length})").alias("n_tokens"), "order",
    )


def pack(documents: DataFrame, text: str = "text", key: str = "doc_id", max_length: int = MAX_LENGTH,
         budget: int = BUDGET, buckets: int = BUCKETS, seed: int = 31) -> DataFrame:
    """``key, piece, first_word, n_tokens, bucket, bucket_length, batch, place, padding``, a row per piece."""
    pieces = pieces_of(documents, text, key, max_length, seed)
    histogram = {r[0]: r[1] for r in pieces.groupBy("n_tokens").count().collect()}
    ends = boundaries(histogram, buckets)
    if not ends:
        ends = [0]
    table = F.array(*[F.lit(e) for e in ends])
    number = sum(F.when(F.col("n_tokens") > e, 1).otherwise(0) for e in ends)
    placed = pieces.withColumn("bucket", number)
    placed = placed.withColumn("bucket_length", table[F.col("bucket")].cast("long"))
    rows = sum(histogram.values())
    slices = max(1, rows // SLICE_ROWS)
    placed = placed.withColumn("slice", F.expr(f"`order` * {slices} div {2**32}"))
    counts = placed.groupBy("bucket", "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bucket").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("bucket", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    inside = Window.partitionBy("bucket", "slice").orderBy("order", "key", "piece", "n_tokens")
    at = placed.withColumn("inner", F.row_number().over(inside)).join(shifts, ["bucket", "slice"])
    at = at.withColumn("at", F.col("shift") + F.col("inner") - 1)
    per = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.col("bucket_length"), F.lit(1))))
    return at.withColumn("per", per).select(
        "key", "piece", "first_word", "n_tokens", "bucket", "bucket_length",
        F.expr("at div per").alias("batch"), F.expr("at % per").alias("place"),
        (F.col("bucket_length") - F.col("n_tokens")).alias("padding"),
    )
