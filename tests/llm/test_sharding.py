import hashlib
import random
import zlib

from tableworks.llm import queries, sharding


def rows():
    r = random.Random(6)
    out = [(i, "é" * r.randint(0, 300)) for i in range(1500)]
    return out + [(None, "x"), (None, None), (7, out[7][1]), (7, out[7][1]), (9000, "long " * 20000)]


def frame(spark, data):
    return spark.createDataFrame([(*x, "s") for x in data], "doc_id long, text string, shard string")


def test_sizes_shards_and_places(spark, tmp_path):
    got = sharding.shard_by_slots(frame(spark, rows()), str(tmp_path / "maps"), shards=6).collect()
    body = lambda t: (t or "").encode()
    want = sorted((str(k), len(body(t)) + 8, zlib.crc32(body(t))) for k, t in rows())
    assert sorted((str(r.key), r["size"], r.text_crc32) for r in got) == want
    slots = {}
    for r in got:
        slots.setdefault(r.virtual_slot, set()).add(r.shard)
    assert all(len(s) == 1 for s in slots.values()) and all(0 <= s < 4096 for s in slots)
    for shard in range(6):
        places = sorted(r.slot for r in got if r.shard == shard)
        assert places == list(range(len(places)))
    load = sorted(sum(r["size"] for r in got if r.shard == s) for s in range(6))
    assert load[-2] - load[0] < 0.01 * load[-2]  # the longest document is more than a shard by itself
    stored = sharding.load_map(spark, str(tmp_path / "maps"))
    assert {r.virtual_slot: {r.shard} for r in stored.collect()} == slots
    assert stored.first().version == 1


def test_rebalancing_moves_whole_slots(spark, tmp_path):
    r = random.Random(1)
    totals = [(s, r.randint(1, 100), 1) for s in range(500)]
    old = sharding.make_map(totals, 8)
    assert sharding.rebalance(old, totals, 8) == old
    new = sharding.rebalance(old, totals, 9)
    load = [sum(n for s, n, _ in totals if new[s] == k) for k in range(9)]
    assert max(load) - min(load) <= 100
    assert all(new[s] == 8 for s in old if new[s] != old[s])
    fewer = sharding.rebalance(new, totals + [(500, 7, 1)], 3)
    assert set(fewer.values()) == {0, 1, 2} and len(fewer) == 501
    path = str(tmp_path / "maps")
    sharding.store_map(sharding.map_frame(spark, old, totals, 1), path)
    sharding.store_map(sharding.map_frame(spark, new, totals, 2), path)
    assert {x.virtual_slot: x.shard for x in sharding.load_map(spark, path).collect()} == new
    assert {x.virtual_slot: x.shard for x in sharding.load_map(spark, path, 1).collect()} == old


def test_query_against_a_plain_map(spark, tmp_path):
    """Slots from the hash, the map from sorted totals, places by counting."""
    frame(spark, rows()).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.REGISTRY["op8_virtual_slots"](spark, str(tmp_path))
    assert got.columns[:7] == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    got = got.collect()
    body = lambda t: (t or "").encode()
    known = [(k, len(body(t)) + 8, zlib.crc32(body(t)), int(hashlib.md5(f"11:{k}".encode()).hexdigest()[:8], 16) % 4096) for k, t in rows() if k is not None]
    lost = [(None, r["size"], r.text_crc32, r.virtual_slot) for r in got if r.doc_id is None]
    assert sorted(x[1:3] for x in lost) == sorted((len(body(t)) + 8, zlib.crc32(body(t))) for k, t in rows() if k is None)
    totals = {}
    for _, size, _, v in known + lost:
        totals.setdefault(v, [0, 0])
        totals[v] = [totals[v][0] + size, totals[v][1] + 1]
    load, placed = [0] * 24, {}
    for v in sorted(totals, key=lambda v: (-totals[v][0], v)):
        placed[v] = min(range(24), key=lambda s: (load[s], s))
        load[placed[v]] += totals[v][0]
    want, seen = [], [0] * 24
    for v in sorted(totals):
        for k, size, crc, _ in sorted((x for x in known + lost if x[3] == v), key=lambda x: (x[0] is not None, x[0] or 0, x[2], x[1])):
            want.append((str(k), size, crc, placed[v], seen[placed[v]]))
            seen[placed[v]] += 1
    assert sorted((str(r.doc_id), r["size"], r.text_crc32, r.shard, r.slot) for r in got) == sorted(want)
    moved = {r.virtual_slot: (r.shard, r.shard_version_2) for r in got}
    assert {b for a, b in moved.values() if a != b} == {24}


def test_empty(spark, tmp_path):
    assert sharding.shard_by_slots(frame(spark, []).limit(0), str(tmp_path / "maps")).collect() == []
