"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

A record's slot is a hash of its key over a fixed number of slots (thousands), so
it never changes.  Bytes and rows are summed per slot; the map from slots to shards
is a small table, made so that shards are near equal in bytes, and stored under a
version number.  Rebalancing edits the map and moves whole slots.

The map has at most ``slots`` rows, a parameter, so it is made on the driver and
broadcast; nothing that grows with the data is.  A slot holds one part in
thousands of the keys, so numbering rows inside a slot is bounded work.

Rows without a key go by a hash of their text.  The law is near equal bytes; records go by
their key, so equal texts under different keys may lie in different shards.  NULL texts
have no bytes and checksum 0.  Repeated rows all count and get places of their own.  An
empty table gives an empty result; shards without rows are allowed.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tableworks.functions.hashing import bucket

SLOTS = 4096
OVERHEAD = 8
#: Shards that differ by less are left as they are by an edit.
SLACK = 0.01


def sized(documents: DataFrame, key: str = "doc_id", text: str = "text", slots: int = SLOTS, seed: int = 11) -> DataFrame:
    """``key, size, text_crc32, virtual_slot`` of each record."""
    body = F.coalesce(F.col(text), F.lit(""))
    return documents.select(
        F.col(key).alias("key"), (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.encode(body, "utf-8")).alias("text_crc32"),
        F.pmod(F.when(F.col(key).isNull(), F.xxhash64(body)).otherwise(bucket(key, seed)), F.lit(slots)).alias("virtual_slot"),
    )


def slot_totals(records: DataFrame) -> DataFrame:
    """Bytes and rows per used slot; at most ``slots`` rows."""
    return records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def make_map(totals: list[tuple[int, int, int]], shards: int) -> dict[int, int]:
    """Slots, heaviest first, each to the shard with the fewest bytes so far."""
    heap = [(0, s) for s in range(shards)]
    placed = {}
    for slot, size, _ in sorted(totals, key=lambda t: (-t[1], t[0])):
        load, shard = heapq.heappop(heap)
        placed[slot] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def rebalance(old: dict[int, int], totals: list[tuple[int, int, int]], shards: int) -> dict[int, int]:
    """An edited map: slots leave the fullest shards for the emptiest while that evens them out.

    Slots of shards that are no longer there, and new slots, are placed first.
    """
    sizes = {slot: size for slot, size, _ in totals}
    load = [0] * shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    new, loose = dict(old), []
    for slot in sorted(sizes):
        shard = old.get(slot)
        if shard is None or shard >= shards:
            loose.append(slot)
        else:
            load[shard] += sizes[slot]
            heapq.heappush(held[shard], (sizes[slot], slot))
    for slot in sorted(loose, key=lambda s: (-sizes[s], s)):
        shard = min(range(shards), key=lambda s: (load[s], s))
        new[slot] = shard
        load[shard] += sizes[slot]
        heapq.heappush(held[shard], (sizes[slot], slot))
    # A shard that can't be relieved, such as one with a single large slot, is left; loads of
    # the thinnest only rise, so it never can again.
    giving = set(range(shards))
    while giving:
        full = max(giving, key=lambda s: (load[s], -s))
        thin = min(range(shards), key=lambda s: (load[s], s))
        if not held[full] or load[thin] + held[full][0][0] >= load[full] or load[thin] >= (1 - SLACK) * load[full]:
            giving.remove(full)
            continue
        size, slot = heapq.heappop(held[full])
        heapq.heappush(held[thin], (size, slot))
        load[full] -= size
        load[thin] += size
        new[slot] = thin
    return new


def map_frame(spark: SparkSession, placed: dict[int, int], totals: list[tuple[int, int, int]], version: int) -> DataFrame:
    """The map as a table, with each slot's first place in its shard."""
    seen: dict[int, int] = {}
    rows = []
    for slot, size, n in sorted(totals):
        shard = placed[slot]
        rows.append((version, slot, shard, size, n, seen.get(shard, 0)))
        seen[shard] = seen.get(shard, 0) + n
    return spark.createDataFrame(
        rows, "version int, virtual_slot long, shard int, bytes long, rows long, first long"
    )


def store_map(table: DataFrame, path: str) -> None:
    """Add one version to the maps kept under ``path``; a version is written once."""
    version = table.first()["version"] if table.take(1) else 0
    table.drop("version").coalesce(1).write.parquet(f"{path.rstrip('/')}/version={version}")


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A stored version of the map, the latest by default."""
    maps = spark.read.parquet(path)
    wanted = version if version is not None else maps.agg(F.max("version")).first()[0]
    return maps.filter(F.col("version") == wanted)


def edit_map(spark: SparkSession, path: str, shards: int) -> DataFrame:
    """The next version of the latest map under ``path``, rebalanced to ``shards`` and stored beside it."""
    now = load_map(spark, path).collect()  # a row per slot
    totals = [(r["virtual_slot"], r["bytes"], r["rows"]) for r in now]
    placed = rebalance({r["virtual_slot"]: r["shard"] for r in now}, totals, shards)
    version = max((r["version"] for r in now), default=0) + 1
    store_map(map_frame(spark, placed, totals, version), path)
    return load_map(spark, path, version)


def shard_by_slots(
    documents: DataFrame, maps: str, key: str = "doc_id", text: str = "text", shards: int = 24,
    slots: int = SLOTS, version: int = 1,
) -> DataFrame:
    """``key, size, text_crc32, virtual_slot, shard, slot``; ``slot`` counts the rows of a shard from 0.

    This version of the map is stored in the folder ``maps`` and read from there.
    """
    spark = documents.sparkSession
    records = sized(documents, key, text, slots)
    totals = [(r["virtual_slot"], r["bytes"], r["rows"]) for r in slot_totals(records).collect()]
    store_map(map_frame(spark, make_map(totals, shards), totals, version), maps)
    return place(records, load_map(spark, maps, version))


def place(records: DataFrame, table: DataFrame) -> DataFrame:
    """Records of ``sized`` in the shards and places of a map; the map has a row per slot."""
    inside = Window.partitionBy("virtual_slot").orderBy("key", "text_crc32", "size")
    return (
        records.withColumn("at", F.row_number().over(inside))
        .join(F.broadcast(table.select("virtual_slot", "shard", "first")), "virtual_slot")
        .select("key", "size", "text_crc32", "virtual_slot", "shard", (F.col("first") + F.col("at") - 1).alias("slot"))
    )
