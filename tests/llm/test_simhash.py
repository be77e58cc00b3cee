import random

import pytest
import xxhash

from tableworks.llm import simhash
from tableworks.llm.common import new_folder, stored
from tableworks.llm.components import components


def plain(text):
    words = "".join(c.lower() if c.isascii() else c for c in (text or "")).encode().split()
    if not words:
        return 0
    k = min(3, len(words))
    hs = [xxhash.xxh64(b" ".join(words[i : i + k]), seed=42).intdigest() for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def test_fingerprint_of_words():
    for t in ["", None, "one", "Two words", "a b c", "Ü ü A b c d\x0be f", "x " * 5000]:
        assert simhash.fingerprint((t or "").encode()) == plain(t)


@pytest.mark.parametrize("group", [256, 4, 1])
def test_links_connect_what_is_close(spark, group):
    """All levels of cutting give the components of a comparison of all pairs."""
    r = random.Random(5)
    fps = {0, 2**64 - 1}
    for _ in range(12):
        x = r.getrandbits(64)
        for _ in range(12):
            for b in r.sample(range(64), r.choice([0, 1, 2, 3, 4])):
                x ^= 1 << b
            fps.add(x)
    base = r.getrandbits(64)
    fps |= {base ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(12)}
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    found = components(simhash.links(df, group))
    got = {row.node: row.root for row in found.collect()}
    want = brute_components([signed(f) for f in fps], lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 3)
    assert {n: got.get(n, n) for n in want} == want


def test_documents(spark):
    texts = {5: "the cat sat on the mat", 3: "the cat sat on the mat", 9: None, 7: " \n", 2: "Another text, short", None: "lone"}
    df = spark.createDataFrame([(k, t, "w", 1) for k, t in texts.items()] + [(3, texts[3], "w", 1)],
                               "doc_id long, text string, key string, row int")
    got = {(r.key, r.fp, r.component_id) for r in simhash.near_duplicates(df).collect()}
    classes = {k: c for k, _, c in got}
    assert classes == {5: 3, 3: 3, 9: 7, 7: 7, 2: 2, None: None}
    kept = simhash.without_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [2, 3, 7, None]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).collect() == []


def test_components_of_path_and_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (500, 500), (1, 0)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {500: 500}


def test_groups_over_the_bound_are_not_broadcast(spark, monkeypatch):
    """An exploded table is taken for as small as its file; joins to it go by counted rows."""
    plans = []

    def recorded(df, path, **options):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, path, **options)

    monkeypatch.setattr("tableworks.llm.common.SENT", 0, raising=False)
    monkeypatch.setattr(simhash, "stored", recorded)
    fps = spark.createDataFrame([(x ^ b,) for x in range(0, 2**20, 2**12) for b in (0, 1, 2)], "fp long")
    found = simhash.links(stored(fps, new_folder(spark, "fps"))).collect()
    assert found and any("SortMergeJoin" in p for p in plans)
    assert not any("BroadcastExchange" in p for p in plans)
