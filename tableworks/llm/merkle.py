"""Merkle manifest of a dataset: leaves, subtrees per group, one root, and a proof for each row.

A row's leaf is the SHA-256 of its fields.  The leaves of a group, by ascending key, are a
tree in which every run of ``FAN`` neighbours hashes to their parent; the groups' roots,
ordered by the group's name, are the leaves of the tree above them.

A tree is climbed ``DEPTH`` levels for each shuffle.  Rows are numbered from 0 and put into
blocks of ``FAN ** DEPTH`` neighbours, one window partition each, so that a group of any
size is spread out.  A node lives on the row of its first leaf in the block.  At level k,
``lag`` and ``lead`` by the fixed offsets FAN^k, 2 FAN^k ... read a node's neighbours; the
slot of the node in its run and the end of the block say which of them are siblings, and
the rows in slot 0 hash the next parent.  A row finds the siblings of its ancestors on the
last row before it that holds them.  One row per block goes on to the next climb.

Row numbers need no window over a group: rows are sorted into slices by range, stored with
their place in the slice, and shifted by the sizes of the slices before.

Every field that is NULL is ``-``, so NULL and empty texts differ.  NULL groups are one
group, the first; NULL keys come first in theirs.  Rows with one key are ordered by their
leaf, equal rows get one place each.  Texts are hashed whole.  Other columns are not read
and cannot clash; those asked for by ``more`` are returned as given.  An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tableworks.llm.common import new_folder, remove, stored

FAN = 3
#: Levels climbed for each shuffle: blocks of 729 rows.
DEPTH = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts one after another."""
    return F.sha2(F.concat(*parts), 256)


def leaf(values: Sequence[Column]) -> Column:
    """The digest of a row: ``-`` for NULL, else the number of UTF-8 bytes, ``:`` and the value."""
    texts = [v.cast("string") for v in values]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def proof_digest(path: Column) -> Column:
    """The digest of all siblings of a path, level by level, left to right."""
    sides = F.transform(path, lambda step: F.concat(step["left"], step["right"]))
    return F.sha2(F.array_join(sides, ""), 256)


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings along its path lead to."""
    return F.aggregate(path, start, lambda node, step: digest(step["left"], node, step["right"]))


def _numbered(rows: DataFrame, order: Sequence[str], path: str) -> tuple[DataFrame, int]:
    """``rows`` with ``pos``, from 0 in each tree, and ``size``, the tree's; and the largest size."""
    by = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    # The number holds the slice above bit 33 and the place in the sorted slice below it.
    placed = stored(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id()), path)
    placed = placed.withColumn("slice", F.shiftright("at", 33))
    parts = placed.groupBy("tree", "slice").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    of_tree = Window.partitionBy("tree")
    parts = parts.select(
        "tree", "slice", (F.sum("n").over(of_tree.orderBy("slice")) - F.col("n") - F.col("first")).alias("shift"),
        F.sum("n").over(of_tree).alias("size"),
    )
    parts = stored(parts, f"{path}-slices")
    numbered = placed.join(parts, ["tree", "slice"]).withColumn("pos", F.col("at") + F.col("shift"))
    return numbered.drop("at", "slice", "shift"), parts.agg(F.max("size")).first()[0] or 0


def _climbed(nodes: DataFrame, fan: int, depth: int) -> DataFrame:
    """``nodes`` (``tree, pos, size, node``) with ``block``, ``path`` inside it, and ``top`` on each block's first row."""
    width = fan**depth
    block = Window.partitionBy("tree", "block").orderBy("pos")
    out = nodes.withColumn("block", F.expr(f"pos div {width}")).withColumn("top", F.col("node"))
    for k in range(depth):
        step = fan**k
        slot, live = F.expr(f"pos div {step} % {fan}"), F.col("size") > step
        before = [F.when(slot >= j, F.lag("top", j * step).over(block)) for j in range(fan - 1, 0, -1)]
        after = [F.when(slot + j < fan, F.lead("top", j * step).over(block)) for j in range(1, fan)]
        here = live & (F.col("pos") % step == 0)
        out = out.withColumn(f"at{k}", F.when(here, F.struct(F.concat_ws("", *before).alias("left"), F.concat_ws("", *after).alias("right"))))
        parent = F.when(live, digest(F.col("top"), F.col(f"at{k}.right"))).otherwise(F.col("top"))
        out = out.withColumn("top", F.when(F.col("pos") % (step * fan) == 0, parent))
    so_far = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = [F.last(f"at{k}", ignorenulls=True).over(so_far) for k in range(depth)]
    path = F.filter(F.array(*steps), lambda step: step.isNotNull())
    return out.withColumn("path", path).drop(*[f"at{k}" for k in range(depth)])


def _trees(rows: DataFrame, order: Sequence[str], folder: str, fan: int, depth: int) -> tuple[list[DataFrame], DataFrame]:
    """The climbs, lowest first, and ``tree, pos, node``: one row per tree with its root.

    ``rows`` has ``tree``, ``node`` and what ``order`` names; other columns stay in the first climb.
    """
    nodes, largest = _numbered(rows, order, f"{folder}/leaves")
    climbs, width = [], fan**depth
    while True:
        climbs.append(stored(_climbed(nodes, fan, depth), f"{folder}/climb-{len(climbs)}"))
        if len(climbs) == 1:
            remove(rows.sparkSession, f"{folder}/leaves", f"{folder}/leaves-slices")
        firsts = climbs[-1].filter(F.col("pos") % width == 0)
        nodes = firsts.select("tree", F.col("block").alias("pos"), F.expr(f"(size + {width - 1}) div {width}").alias("size"), F.col("top").alias("node"))
        largest = -(-largest // width)
        if largest <= 1:
            return climbs, nodes.select("tree", "pos", "node")


def _with_paths(climbs: list[DataFrame], above: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The rows of the lowest climb with their whole path; ``above`` has ``tree, pos, rest`` and ``keep`` for each tree."""
    for climb in reversed(climbs):
        own = climb.join(above.withColumnRenamed("pos", "block"), ["tree", "block"]).withColumn("rest", F.concat("path", "rest"))
        above = own.select("tree", "pos", *keep, "rest")
    return own.drop("pos", "path", "block", "size", "top").withColumnRenamed("rest", "path")


def manifest(documents: DataFrame, key: str = "doc_id", group: str = "source", fields: Sequence[str] = FIELDS,
             more: dict[str, Column] | None = None, fan: int = FAN, depth: int = DEPTH) -> DataFrame:
    """``key, leaf, subroot, root, path`` for each row, and the columns ``more`` makes of it.

    ``path`` has a ``left`` and a ``right`` text of sibling digests for each level, from the
    leaf to the root; see ``folded`` and ``proof_digest``.
    """
    folder = new_folder(documents.sparkSession, "merkle")
    col = lambda c: F.col(f"`{c}`")
    extra = [v.alias(f"v{i}") for i, v in enumerate((more or {}).values())]
    rows = documents.select(
        # NULL groups come before all others, the empty name too.
        F.coalesce(F.concat(F.lit("="), col(group).cast("string")), F.lit("")).alias("tree"), col(key).alias("key"),
        leaf([col(c) for c in fields]).alias("node"), F.struct(F.lit(0).alias("none"), *extra).alias("more"),
    )
    climbs, roots = _trees(rows, ["key", "node"], f"{folder}/rows", fan, depth)
    groups = roots.select(F.lit("").alias("tree"), F.col("tree").alias("key"), "node")
    tops, root = _trees(groups, ["key"], f"{folder}/groups", fan, depth)
    nothing = F.expr("cast(array() as array<struct<left:string,right:string>>)")
    above = _with_paths(tops, root.select("tree", "pos", F.col("node").alias("root"), nothing.alias("rest")), ["root"])
    above = above.select(
        F.col("key").alias("tree"), F.lit(0).cast("long").alias("pos"), F.col("node").alias("subroot"), "root", F.col("path").alias("rest"),
    )
    rows = _with_paths(climbs, above, ["subroot", "root"])
    return rows.select(
        "key", F.col("node").alias("leaf"), "subroot", "root", "path",
        *[F.col(f"more.v{i}").alias(name) for i, name in enumerate(more or {})],
    )
