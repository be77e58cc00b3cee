"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order.  Vectors are dealt over blocks;
each block posts its vectors in one inverted file per pivot (vector, place of the pivot
in its order).  A query reads the files of its own pivots, adds up the footrule distance
of the orders (a pivot that one side lacks counts as behind all others), takes the
``share`` of the block with the smallest distance and ranks these by the exact cosine.
The best of all blocks are merged.

Queries are dealt over blocks as well, so a task holds one block of each whatever the
tables' sizes.  Pivots are ``pivots`` vectors that are apart from each other, out of a sample four times as large, chosen by a hash of the key, a bounded parameter; every vector is indexed.

Equal vectors tie, and ties go to smaller keys, so of equal vectors in a block only the
``k + 1`` with the smallest keys can be found; the others are left out of the files.

Vectors that are NULL, zero, hold a NULL or a non-finite component, or differ in length
from most others take no part, nor do rows without a key.  Repeated query keys are one
query (any of their rows).  Empty tables give an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

PIVOTS = 256
ORDER = 128
SHARE = 0.06
#: Candidates of a query in a block are ``LEAST × k`` at least.
LEAST = 50
#: So many vectors are drawn for each pivot; those closer than this cosine to a pivot are
#: passed over, else one dense group would hold many pivots that say the same.
OVERSAMPLE = 4
CLOSE = 0.8
BLOCK = 8192
QUERY_BLOCK = 4096


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``key, v`` of the rows that take part."""
    named = vectors.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("v"))
    sound = F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    ok = named.filter(F.col("key").isNotNull() & F.col("v").isNotNull()).filter(sound & F.exists("v", lambda x: x != 0))
    length = ok.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return ok.filter(F.size("v") == (length["n"] if length else 0))


def _unit(a: np.ndarray) -> np.ndarray:
    a = a / np.abs(a).max(axis=1, keepdims=True)
    return a / np.sqrt((a * a).sum(axis=1, keepdims=True))


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = table["key"].to_numpy()
    flat = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return keys, flat.reshape(len(keys), -1)


def _orders(unit: np.ndarray, pivots: np.ndarray, k: int) -> np.ndarray:
    return np.argsort(-(unit @ pivots.T), axis=1, kind="stable")[:, :k]


def _apart(drawn: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` vectors that are not close to an earlier one."""
    chosen: list[int] = []
    for i in range(len(drawn)):
        if len(chosen) < n and (not chosen or (drawn[chosen] @ drawn[i]).max() < CLOSE):
            chosen.append(i)
    return drawn[chosen]


def nearest(
    vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 5,
    pivots: int = PIVOTS, order: int = ORDER, share: float = SHARE, block: int = BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each query, its own key left out."""
    base = usable(vectors, key, vector)
    asked = usable(queries, key, vector).dropDuplicates(["key"])
    sample = base.orderBy(F.md5(F.col("key").cast("string")), "key").limit(OVERSAMPLE * pivots).collect()
    out = "query_id long, vec_id long, score double"
    spark = vectors.sparkSession
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    points = _apart(_unit(np.array([r["v"] for r in sample], np.float64)), pivots)
    depth = min(order, len(points))
    blocks, query_blocks = -(-base.count() // block), max(1, -(-asked.count() // query_block))
    spread = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    own = lambda n: F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")
    left = base.select("key", "v", own(blocks).alias("block"), F.explode(spread(query_blocks)).alias("part"))
    right = asked.select("key", "v", F.explode(spread(blocks)).alias("block"), own(query_blocks).alias("part"))

    def search(files: pa.Table, questions: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not files.num_rows or not questions.num_rows:
            return empty
        keys, values = _matrix(files)
        by_key = np.argsort(keys, kind="stable")
        keys, units = keys[by_key], _unit(values[by_key])
        _, same = np.unique(units, axis=0, return_inverse=True)
        same = same.ravel()
        grouped = np.argsort(same, kind="stable")
        first = np.searchsorted(same[grouped], same[grouped], side="left")
        stay = np.sort(grouped[np.arange(len(grouped)) - first <= k])
        keys, units = keys[stay], units[stay]
        n = len(keys)
        orders = _orders(units, points, depth)
        # Inverted files: for each pivot the vectors that list it, and where.
        pivot, place = orders.ravel(), np.tile(np.arange(depth), n)
        owner = np.repeat(np.arange(n), depth)
        filed = np.argsort(pivot, kind="stable")
        bounds = np.searchsorted(pivot[filed], np.arange(len(points) + 1))
        owner, place = owner[filed].astype(np.int32), place[filed].astype(np.int32)
        q_keys, q_values = _matrix(questions)
        q_units = _unit(q_values)
        q_orders = _orders(q_units, points, depth)
        most = max(LEAST * k, int(np.ceil(share * n)))
        found: tuple[list, list, list] = ([], [], [])
        for i in range(len(q_keys)):
            distance = np.full(n, depth * (depth + 1), np.int64)
            for at, p in enumerate(q_orders[i].tolist()):
                file = slice(bounds[p], bounds[p + 1])
                where = place[file]
                distance[owner[file]] += np.abs(where - at) - (depth - at) - (depth - where)
            distance = distance * n + np.arange(n)  # ties to smaller keys
            near = np.argpartition(distance, most)[:most] if most < n else np.arange(n)
            near = near[keys[near] != q_keys[i]]
            score = (units[near] * q_units[i]).sum(axis=1)
            best = np.lexsort((keys[near], -score))[:k]
            found[0].append(np.full(len(best), q_keys[i]))
            found[1].append(keys[near][best])
            found[2].append(score[best])
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, found), strict=True)))

    each = left.groupBy("part", "block").cogroup(right.groupBy("part", "block")).applyInArrow(search, out)
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
