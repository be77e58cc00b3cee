import hashlib
import random

import pytest

from tableworks.llm import suffix
from tableworks.llm.common import remove

SCHEMA = "doc_id long, text string, n_bytes string, chunk int"


def brute(rows, length):
    """Every byte covered by a passage that also starts in a document with a smaller key."""
    first = {}
    keyed = [(k if k is not None else 2**63 - 1, (t or "").encode()) for k, t in rows]
    for k, t in keyed:
        for i in range(len(t) - length + 1):
            w = t[i : i + length]
            first[w] = min(first.get(w, k), k)
    out = []
    for (k, t), (orig, _) in zip(keyed, rows):
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if first[t[i : i + length]] < k:
                gone[i : i + length] = [True] * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((orig, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, length=50, chunk=3000):
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], SCHEMA).repartition(3)
    got = suffix.remove_repeats(df, length=length, keep_text=False, chunk_bytes=chunk)
    cols = ["doc_id", "r_n_bytes", "r_n_removed", "r_n_spans", "r_kept_sha256"]
    return sorted((tuple(r) for r in got.select(*cols).collect()), key=repr)


def corpus(seed, n):
    r = random.Random(seed)
    words = ["ab", "the", "of", "ü", "né", "x" * 9, "longer", "日本"]
    passages = [" ".join(r.choices(words, k=r.randint(5, 60))) for _ in range(6)]
    texts = []
    for _ in range(n):
        t = " ".join(r.choice(passages) if r.random() < 0.4 else " ".join(r.choices(words, k=8)) for _ in range(r.randint(0, 6)))
        texts.append(t[r.randint(0, 5):])
    texts += [texts[0], texts[1], "a" * 200, "a" * 120, "", None, "b" * 49, "b" * 50, "b" * 50]
    texts += ["ab" * 80, "ba" * 60, passages[0] * 5]
    return texts


@pytest.mark.parametrize("seed,length,chunk", [(1, 50, 3000), (2, 50, 200), (3, 40, 10**6)])
def test_same_as_brute_force(spark, seed, length, chunk):
    texts = corpus(seed, 40)
    keys = list(range(len(texts)))
    random.Random(seed).shuffle(keys)
    rows = list(zip(keys, texts)) + [(keys[0], texts[0]), (None, texts[2]), (None, texts[3] or "q"), (keys[5], texts[2])]
    assert run(spark, rows, length, chunk) == brute(rows, length)


def test_hash_clashes_are_sorted_by_bytes(spark, monkeypatch):
    """Equal hashes of different passages don't remove anything."""
    import numpy as np

    texts = ["0123456789" * 8, "9876543210" * 8]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    words = suffix._words(data)
    at = np.array([0, 80, 10])
    h = np.array([5, 5, 5], np.uint64)
    assert suffix._heads(words, at, h, 50) is None


def test_text_that_is_left(spark):
    passage = "p" * 30 + "ü" * 20
    df = spark.createDataFrame([(1, f"head {passage} tail"), (2, f"x {passage} y"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in suffix.remove_repeats(df).collect()}
    assert got == {1: f"head {passage} tail", 2: "xy", 3: ""}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert suffix.remove_repeats(df).collect() == []


def test_a_frequent_phrase_is_dealt_to_many_buckets(spark, monkeypatch):
    """A phrase in ever new contexts has one smallest string in many suffixes; no bucket gets them all."""
    import numpy as np

    r = random.Random(8)
    noise = lambda n: "".join(r.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=n))
    phrase = "The licence says, and so on: it"
    rows = [(i, noise(60) + phrase + noise(60)) for i in range(400)]
    rows += [(400 + i, noise(10) + rows[i][1][20:120]) for i in range(20)]
    monkeypatch.setattr(suffix, "BUCKET_SUFFIXES", 1000)
    monkeypatch.setattr(suffix, "HOT", 100)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    work = suffix.Removal(df, "text", "doc_id", 50, 3000)
    work.copies()
    work.ranks()
    work.hot()
    loads = {}
    for row in work._sent().collect():
        sizes = np.frombuffer(row.sizes, np.int32)
        loads[row.bucket] = loads.get(row.bucket, 0) + int((sizes - 49).sum())
    average = sum(loads.values()) / work.out
    assert max(loads.values()) < 2 * average + 100
    assert run(spark, rows) == brute(rows, 50)


def test_strings_of_a_chunk_are_found_once(spark, monkeypatch):
    """Sending and removing read the strings that the counting pass wrote; ranks are not asked again."""
    monkeypatch.setattr(suffix, "HOT", 200)
    texts = corpus(6, 40)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    work = suffix.Removal(df, "text", "doc_id", 50, 2000)
    work.copies()
    work.ranks()
    work.hot()
    remove(spark, f"{work.root}/ranks")
    work.repeats()
    got = [(r.doc_id, r.r_n_removed, r.r_kept_sha256) for r in work.result(False).collect()]
    whole = [(r.doc_id, r.r_n_removed, r.r_kept_sha256) for r in suffix.remove_repeats(df, keep_text=False, chunk_bytes=2000).collect()]
    assert sorted(got) == sorted(whole) and sum(n for _, n, _ in got) > 0
