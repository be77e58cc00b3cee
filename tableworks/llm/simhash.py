"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints of 64 bits are linked at three differing bits or fewer.  Cut into two
segments of 32 bits, two linked fingerprints have a segment that differs by one bit at
most.  A segment has 32 variants with one bit blanked out; both fingerprints have the
variant that blanks their differing bit.  So links are found by equality on variants and
verified: 64 rows per distinct fingerprint, where cutting into exact segments would need
more segments that are shorter, and so much larger groups.

Groups that hold many fingerprints are cut again in the same way, on the half that is
not fixed yet (16 of 32 bits, then 8 of 16): at the third level 53 bits are fixed and a
group can hold 2,048 fingerprints at most.  Groups are compared inside one task and give
one row per member, never all pairs.

Equal texts have equal fingerprints and are one member.  Components are found on
fingerprints; the class of a document is the smallest key in its component.

NULL, empty and blank texts have fingerprint zero and are linked like any other.  NULL
keys count as larger than all others; the class is NULL only if all keys of a component
are.  Repeated rows are members of one class.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tableworks.llm.common import looked_up, new_folder, row_of, stored, tidied, without_rows
from tableworks.llm.components import components

SHINGLE = 3
SEED = 42
DISTANCE = 3
#: Groups of more members are cut by the next level.
GROUP = 256


def fingerprint(raw: bytes, size: int = SHINGLE) -> int:
    """The majority of each bit over the hashes of all word shingles, as an unsigned number."""
    words = raw.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(size, len(words))
    first, last = starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, len(first), 65536):
        part = [digest(line[s:e], SEED) for s, e in zip(first[i : i + 65536], last[i : i + 65536], strict=True)]
        bits = np.unpackbits(np.array(part, ">u8").view(np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(first)).tobytes(), "big")


def fingerprints(documents: DataFrame, text: str, key: str) -> DataFrame:
    """``key, row, fp``: ``row`` is a hash of the whole row, ``fp`` a signed number."""
    number, row = row_of(documents, key)
    named = documents.select(
        number.alias("key"), row.alias("row"), F.encode(F.coalesce(F.col(f"`{text}`"), F.lit("")), "utf-8").alias("text")
    )

    def computed(batches):
        for batch in batches:
            fps = np.array([fingerprint(t.as_buffer().to_pybytes()) for t in batch.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], ["key", "row", "fp"]
            )

    return named.mapInArrow(computed, "key long, row long, fp long")


def _variants(at: str, bits: int) -> str:
    """SQL: the one-wildcard variants of the two halves of a field of ``2 × bits`` bits that starts at bit ``at``.

    A variant is the half's number, the blanked bit and the rest of the half.
    """
    mask = f"(shiftleft(1L, {bits}) - 1)"
    value = f"(shiftright(fp, cast({at} + i div {bits} * {bits} as int)) & {mask})"
    return (
        f"transform(sequence(0, {2 * bits - 1}), i -> shiftleft(cast(i as bigint), 32) | "
        f"({value} & ~shiftleft(1L, i % {bits})))"
    )


#: Per level: the variants, and where the field that is still free begins, seen from the variant.
_LEVELS = ((32, "0", "(1 - shiftright(v, 32) div 32) * 32"), (16, "free", "free + (1 - shiftright(v, 32) div 16) * 16"), (8, "free", "free"))


def _linked(groups: DataFrame) -> DataFrame:
    """``a, b``: each member of a group tied to the first member it is connected with."""
    sets = groups.groupBy("g").agg(F.sort_array(F.collect_list("fp")).alias("members")).select("members").distinct()

    def ties(batches):
        for batch in batches:
            a, b = [], []
            for i in range(batch.num_rows):
                m = np.asarray(batch.column(0)[i].values)
                near = np.bitwise_count(m[:, None].view(np.uint64) ^ m[None, :].view(np.uint64)) <= DISTANCE
                left = np.ones(len(m), bool)
                for root in range(len(m)):
                    if not left[root]:
                        continue
                    front = np.zeros(len(m), bool)
                    front[root] = True
                    left[root] = False
                    while front.any():
                        front = near[front].any(axis=0) & left
                        left &= ~front
                        a += [m[root]] * int(front.sum())
                        b += m[front].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return sets.mapInArrow(ties, "a long, b long")


def links(fps: DataFrame, group: int = GROUP) -> DataFrame:
    """``a, b``: links that connect all fingerprints (column ``fp``, distinct) as close ones would."""
    folder = new_folder(fps.sparkSession, "groups")
    rows = fps.select("fp", F.lit(0).alias("free"), F.lit("").alias("g"))
    found = None
    for level, (bits, at, free) in enumerate(_LEVELS):
        keyed = rows.withColumn("v", F.explode(F.expr(_variants(at, bits)))).select(
            "fp", F.expr(f"cast({free} as int)").alias("free"),
            (F.col("v") if level == 0 else F.xxhash64("g", "v")).alias("g"),
        )
        sizes = stored(keyed.groupBy("g").agg(F.count("*").alias("n")).filter("n > 1"), f"{folder}/sizes-{level}")
        # Few rows share a variant; they are read twice, here and by the next level.
        grouped = stored(looked_up(keyed, sizes, "g"), f"{folder}/{level}")
        last = level == len(_LEVELS) - 1
        here = _linked(grouped if last else grouped.filter(F.col("n") <= group))
        found = here if found is None else found.union(here)
        rows = grouped.filter(F.col("n") > group).select("fp", "free", "g")
        if last or rows.isEmpty():
            break
    return found.distinct()


def near_duplicates(documents: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, row, fp, component_id, keeper`` of each document.

    ``keeper`` is true for rows that equal the first one (smallest key, then row hash) of
    their component.
    """
    spark = documents.sparkSession
    folder = new_folder(spark, "simhash")
    each = stored(fingerprints(documents, text, key), f"{folder}/fingerprints")
    order = F.struct(F.col("key").isNull().alias("none"), "key", "row")
    least = stored(each.groupBy("fp").agg(F.min(order).alias("least")), f"{folder}/least")
    known = components(links(least.select("fp")))
    classes = least.join(known.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    head = classes.groupBy("root").agg(F.min("least").alias("head"))
    of_fp = classes.select("fp", "root").join(head, "root").select("fp", "head")
    return each.join(of_fp, "fp").select(
        "key", "row", "fp", F.col("head.key").alias("component_id"),
        (F.col("head.key").eqNullSafe(F.col("key")) & (F.col("head.row") == F.col("row"))).alias("keeper"),
    )


def without_near_duplicates(documents: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``documents`` with one row of each class; their columns may have any name."""
    spark = documents.sparkSession
    path = new_folder(spark, "classes")
    with tidied(spark):
        classes = stored(near_duplicates(documents, text, key).select("key", "row", "keeper"), path)
    return without_rows(documents, classes.filter(~F.col("keeper")).select("key", "row"), classes, key)
