"""Near copies by the Jaccard similarity of word shingles, every removal checked exactly.

A fingerprint of 64 bits cannot tell a similarity of 0.8 from chance cheaply: some ten
bits differ.  Here a document's signature is the least value of each of 100 hashes over its
shingles, 16 bits of each.  Five of them make a key, 20 keys a document; two documents with
similarity s share one with probability 1 - (1 - s^5)^20: 0.9996 at 0.8, more above.

Documents with one key are a group.  Its first ``HEADS`` documents are its heads; the others
are dealt to parts of about as many, each part with a copy of the heads.  Inside a part
signatures are compared in numpy and a document is tied to the ``TIES`` likeliest earlier
ones among the heads, if their estimate is over ``ESTIMATE``: rows are one per member and
tie, never all pairs.  Ties are then checked on whole shingle sets; where two documents are
similar the later one goes.  A document that stays is tied to its next likely heads, four
times as many in all, and so on until none is left over ``ESTIMATE``.

A group within ``HEADS`` documents is done after that, since all its pairs were compared.  In
a larger one what is similar to a head has gone, which is nearly all of a large family of
copies.  The rest meets again under pairs of keys, then triples: documents that are not
similar part there, two with similarity 0.8 share two keys with probability 0.996, three
with 0.98.  Groups that stay large after ``CUTS`` cuts lose their heads each time, so every
pair is compared at last.

Texts are lower-cased (ASCII) and cut at ASCII white space; shorter ones than a shingle
are one shingle.  Texts without words are never removed.  NULL keys count as larger than
all others; equal rows have equal places, and one stays.  Columns are carried as one struct
and may have any name.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tableworks.llm.common import SLOTS, looked_up, new_folder, remove, row_of, stored, without_rows

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 20
ROWS = 5
SEED = 42
HEADS = 128
TIES = 3
#: Estimates from 100 hashes have a standard deviation of 0.04 at 0.8.
ESTIMATE = 0.7
CUTS = 2
_MIX = np.random.default_rng(SEED).integers(0, 2**64, (2, BANDS * ROWS), np.uint64)
_DOC = "none boolean, key long, row long"


def shingles(raw: bytes, size: int = SHINGLE) -> np.ndarray:
    """The distinct hashes of all word shingles."""
    words = raw.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(size, len(words))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    return np.unique(np.fromiter((digest(line[s:e], SEED) for s, e in spans), np.uint64))


def signature(hashes: np.ndarray) -> bytes:
    """16 bits of the least value of each hash function, nothing for a text without words."""
    if not len(hashes):
        return b""
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for i in range(0, len(hashes), 4096):
        mixed = (hashes[i : i + 4096, None] ^ _MIX[0]) * (_MIX[1] | np.uint64(1))
        np.minimum(least, mixed.min(axis=0), out=least)
    return ((least * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype("<u2").tobytes()


def _rows(documents: DataFrame, text: str, key: str) -> DataFrame:
    """``doc, text``: ``doc`` is the place of a row in the order of documents, with a hash of the whole row."""
    number, row = row_of(documents, key)
    return documents.select(
        F.struct(number.isNull().alias("none"), number.alias("key"), row.alias("row")).alias("doc"),
        F.encode(F.coalesce(F.col(f"`{text}`"), F.lit("")), "utf-8").alias("text"),
    )


def _made(rows: DataFrame, name: str, kind: str, type_: pa.DataType, make) -> DataFrame:
    """``doc`` and what ``make`` gives for the text's shingles."""

    def made(batches):
        for batch in batches:
            values = [make(t.as_buffer().to_pybytes()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, type_)], ["doc", name])

    return rows.mapInArrow(made, f"doc struct<{_DOC.replace(' ', ':').replace(',:', ',')}>, {name} {kind}")


def _keyed(rows: DataFrame) -> DataFrame:
    """``g, band, doc, signature``: every row of ``g, band`` under each key with a larger number than ``band``."""
    key = f"xxhash64(g, i, substring(signature, i * {2 * ROWS} + 1, {2 * ROWS}))"
    keys = f"transform(filter(sequence(0, {BANDS - 1}), i -> i > band), i -> struct({key} as g, i as band))"
    return rows.withColumn("k", F.explode(F.expr(keys))).select("k.g", "k.band", "doc", "signature")


def _compared(parts: DataFrame, start: int = 0, end: int | None = None) -> DataFrame:
    """``a, b, more``: documents of a part tied to earlier heads that are likely to be similar.

    Of a document's likely heads those at the places from ``start`` to ``end`` by likeness;
    ``more``: there are others after them.
    """
    end = TIES if end is None else end

    def ties(batches):
        for batch in batches:
            found = []
            for part in batch.to_pylist():
                heads, rest = part["heads"] or [], part["rest"] or []
                signs = [np.frombuffer(x["signature"], "<u2") for x in heads]
                if not signs:
                    continue
                base = np.stack(signs)
                place = {tuple(x["doc"].values()): i for i, x in enumerate(heads)}
                for x in [*(heads if part["first"] else []), *rest]:
                    at = place.get(tuple(x["doc"].values()), len(heads))
                    if not at:
                        continue
                    same = (base[:at] == np.frombuffer(x["signature"], "<u2")).mean(axis=1)
                    likely = [i for i in np.argsort(-same, kind="stable") if same[i] >= ESTIMATE]
                    found += [(heads[i]["doc"], x["doc"], len(likely) > end) for i in likely[start:end]]
            doc = pa.struct([("none", pa.bool_()), ("key", pa.int64()), ("row", pa.int64())])
            columns = [pa.array([f[i] for f in found], t) for i, t in enumerate((doc, doc, pa.bool_()))]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "more"])

    kind = f"struct<{_DOC.replace(' ', ':').replace(',:', ',')}>"
    return parts.mapInArrow(ties, f"a {kind}, b {kind}, more boolean")


def _parted(members: DataFrame, headed: DataFrame, heads: int) -> DataFrame:
    """Members (``g, n, doc, signature``) in parts of about as many as there are heads, each with a copy of its group's heads."""
    parts = F.expr(f"n div {heads} + 1")
    dealt = members.select(F.xxhash64("g", F.pmod(F.xxhash64("doc"), parts)).alias("p"), F.struct("doc", "signature").alias("member"))
    dealt = dealt.groupBy("p").agg(F.collect_list("member").alias("rest"))
    copies = headed.select(
        F.explode(F.transform(F.sequence(F.lit(0).cast("long"), parts - 1), lambda i: F.xxhash64("g", i))).alias("p"), "heads"
    )
    # Copies are as many as parts, whatever the file of heads says: never broadcast them.
    return dealt.join(copies.hint("merge"), "p").select("heads", "rest", F.lit(False).alias("first"))


def _ties(groups: DataFrame, heads: int, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The ties of all groups; the members of larger groups that are no heads, with ``g, band``; the heads. ``groups``: ``g, band, n, doc, signature``."""
    member = F.struct("doc", "signature").alias("member")
    first = Window.partitionBy("g").orderBy("doc")
    headed = groups.withColumn("at", F.row_number().over(first)).filter(F.col("at") <= heads)
    headed = stored(headed.groupBy("g").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(member)).alias("heads")), f"{folder}/heads")
    ends = headed.filter(F.col("n") > heads).select("g", F.col("heads")[heads - 1]["doc"].alias("end"))
    rest = stored(groups.filter(F.col("n") > heads).join(ends, "g").filter("doc > end").select("g", "band", "n", "doc", "signature"), f"{folder}/rest")
    parted = _parted(rest, headed.filter(F.col("n") > heads), heads)
    own = headed.select("heads", F.lit(None).cast(parted.schema["rest"].dataType).alias("rest"), F.lit(True).alias("first"))
    return _compared(own.union(parted)), rest.select("g", "band", "doc", "signature"), headed


def _undecided(ties: DataFrame, found: DataFrame) -> DataFrame:
    """``doc`` of documents with further likely heads that have not gone."""
    return ties.filter("more").select(F.col("b").alias("doc")).distinct().join(found, "doc", "left_anti")


def _similar(ties: DataFrame, rows: DataFrame, size: int, similarity: float, folder: str) -> DataFrame:
    """``doc`` of the ties' later documents whose shingle sets are similar enough."""
    asked = stored(ties.select(F.explode(F.array("a.row", "b.row")).alias("row")).distinct(), f"{folder}/tied")
    # Shingles of tied documents only; 32 bits tell apart what is in two sets.
    slots = F.broadcast(asked.select(F.pmod("row", F.lit(SLOTS)).alias("slot")).distinct())
    texts = rows.withColumn("row", F.col("doc.row")).join(slots, F.pmod("row", F.lit(SLOTS)) == F.col("slot"), "left_semi")
    texts = looked_up(texts, asked, "row", "left_semi").select("doc", "text")
    short = lambda raw: np.unique(shingles(raw, size).astype(np.uint32).view(np.int32))
    sets = stored(_made(texts, "shingles", "array<int>", pa.list_(pa.int32()), short), f"{folder}/sets").dropDuplicates(["doc"]).hint("merge")
    pairs = ties.join(sets.withColumnRenamed("doc", "b"), "b")
    pairs = pairs.join(sets.select(F.col("doc").alias("a"), F.col("shingles").alias("others")), "a")
    both = F.size(F.array_intersect("shingles", "others"))
    alike = both >= F.lit(similarity) * (F.size("shingles") + F.size("others") - both)
    return pairs.filter(alike).select(F.col("b").alias("doc")).distinct()


def copies(documents: DataFrame, text: str = "text", key: str = "doc_id", size: int = SHINGLE,
           similarity: float = SIMILARITY, heads: int = HEADS, cuts: int = CUTS, without: DataFrame | None = None) -> DataFrame:
    """``key, row`` of the documents that go; ``row`` is a hash of the whole row.

    ``without`` (``key, row``): documents that take no part.
    """
    spark = documents.sparkSession
    folder, left_to = new_folder(spark, "similar"), new_folder(spark, "gone")
    rows = _rows(documents, text, key)
    signed = _made(rows, "signature", "binary", pa.binary(), lambda raw: signature(shingles(raw, size)))
    signed = stored(signed.filter("length(signature) > 0"), f"{folder}/signatures").distinct()
    if without is not None:
        other = without.select(F.struct(F.col("key").isNull().alias("none"), "key", "row").alias("other"))
        signed = looked_up(signed, other, F.col("doc").eqNullSafe(F.col("other")), "left_anti")
    each = _keyed(signed.select(F.lit(0).cast("long").alias("g"), F.lit(-1).alias("band"), "doc", "signature"))
    gone, k = None, 0
    while True:
        now = f"{folder}/{k}"
        sizes = stored(each.groupBy("g").agg(F.count("*").alias("n")).filter("n > 1"), f"{now}/sizes")
        groups = stored(looked_up(each, sizes, "g"), f"{now}/groups")
        ties, rest, headed = _ties(groups, heads, now)
        ties = stored(ties.distinct(), f"{now}/ties")
        found = stored(_similar(ties, rows, size, similarity, now), f"{left_to}/{k}")
        # Where the likeliest heads were not similar, the next ones are asked, up to the last.
        start, asked = TIES, stored(_undecided(ties, found), f"{now}/asked")
        while not asked.isEmpty():
            end, step = 4 * start, f"{now}/from-{start}"
            members = looked_up(groups, asked, "doc").select("g", "n", "doc", "signature")
            ties = stored(_compared(_parted(members, headed, heads), start, end).distinct(), f"{step}/ties")
            found = found.union(stored(_similar(ties, rows, size, similarity, step), f"{left_to}/{k}-{start}"))
            start, asked = end, stored(_undecided(ties, found), f"{step}/asked")
        gone = found if gone is None else gone.union(found)
        left = stored(looked_up(rest, found, "doc", "left_anti"), f"{folder}/left-{k}")
        remove(spark, now, f"{folder}/left-{k - 1}" if k else f"{folder}/signatures")
        k += 1
        if left.isEmpty():
            remove(spark, folder)
            break
        each = _keyed(left) if k <= cuts else left
    return gone.select("doc.key", "doc.row").distinct()


def without_copies(documents: DataFrame, text: str = "text", key: str = "doc_id", size: int = SHINGLE,
                   similarity: float = SIMILARITY) -> DataFrame:
    """``documents`` without those whose shingles are similar to a document with a smaller key, and without repeated rows."""
    number, row = row_of(documents, key)
    each = documents.select(number.alias("key"), row.alias("row"))
    return without_rows(documents, copies(documents, text, key, size, similarity), each, key)
