"""Connected components of a table of links, by alternating stars.

Each round writes its links to the shared folder and deletes those of the round
before; nothing is collected.  The least neighbour of a node is found by an
aggregation, so a node with very many links is pre-aggregated; joins keep the links on
the side that can be split.  Rounds grow with the logarithm of the longest path.

Self-links and repeated links are allowed; NULL ends are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tableworks.llm.common import new_folder, remove, stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Every neighbour is tied to the least one: larger neighbours of all nodes, or smaller ones and the node."""
    if large:
        links = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    tied = links.join(least, "a")
    if large:
        return tied.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    both = tied.select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("t"))
    return both.select(F.col("t.b").alias("a"), F.col("t.m").alias("b")).filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for each node with a link; ``root`` is the smallest node of its component.

    ``links`` has the columns ``a`` and ``b``, whole numbers.
    """
    spark, folder = links.sparkSession, new_folder(links.sparkSession, "links")
    # Kept even if two ends are equal, so that a node linked only to itself is in the result.
    loops = links.filter("a = b").select(F.col("a").alias("node"), F.col("b").alias("root"))
    now = stored(links.filter("a <> b").distinct(), f"{folder}/0")
    seen, k = None, 0
    while True:
        k += 1
        following = stored(_star(_star(now, True), False), f"{folder}/{k}")
        remove(spark, f"{folder}/{k - 1}")
        now = following
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    found = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = found.select(F.col("root").alias("node"), "root").distinct()
    known = found.union(roots)
    return known.union(loops.join(known, "node", "left_anti").distinct())
