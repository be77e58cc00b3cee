import random
import re

import pytest
from pyspark.sql import functions as F

from tableworks.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("n", [1, 2, 7, 100, 4097])
def test_permutations(spark, n):
    moved = {
        k: [r[0] for r in spark.range(n).select(mixing.shuffled("id", f"{n}L", str(k)).alias("x")).collect()] for k in (0, 5)
    }
    assert all(sorted(m) == list(range(n)) for m in moved.values())
    assert n < 100 or moved[0] != moved[5] and moved[0] != list(range(n))


def shared(sizes, total_share=1.5, most=2, weights=(3, 1, 2)):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, target = total_share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in open_}
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def documents(seed=1):
    r = random.Random(seed)
    rows = [(i, " ".join(r.choices(["a", "bé", "ccc"], k=r.randint(0, 400))) + r.choice(["", " \n"]), r.choice(["x", "y", "é", "z", "hot", "hot", "hot", None])) for i in range(150)]
    return rows + [(1000, None, "x"), (1001, "", "only empty"), (None, "some words here", "y"), rows[3], rows[3], (1002, "w " * 30000, "hot")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "t") for r in rows], "doc_id long, text string, source string, size int, target string")


def test_targets_and_takes(spark):
    rows = documents()
    got = mixing.taken_words(frame(spark, rows)).collect()
    size = lambda t: len(WORD.findall(t or ""))
    assert sorted((str(r.key), r.size) for r in got) == sorted((str(k), size(t)) for k, t, _ in rows)
    totals = {}
    for _, t, s in rows:
        totals[s] = totals.get(s, 0) + size(t)
    want = shared(totals)
    taken = {}
    for r in got:
        assert r.source_size == totals[r.source]
        assert abs(r.target - want[r.source]) < 1e-5
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= mixing.BLOCK_WORDS
    again = mixing.taken_words(frame(spark, rows).repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mixed_texts_are_the_taken_words(spark):
    rows = documents(2)
    df = frame(spark, rows)
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    words = {}
    for r in out.collect():
        words[str(r.doc_id)] = words.get(str(r.doc_id), 0) + len(WORD.findall(r.text))
    texts = {str(k): t for k, t, _ in rows}
    assert all(WORD.findall(r.text)[0] in texts[str(r.doc_id)] for r in out.collect())
    whole = [r for r in out.collect() if r.doc_id != 1002 and r.text == (texts[str(r.doc_id)] or "")]
    assert whole  # a document of which a round takes everything keeps its white space
    want = {}
    for r in mixing.taken_words(df).groupBy(F.col("key").cast("string").alias("k")).agg(F.sum("taken").alias("n")).collect():
        want[str(r.k)] = r.n
    totals = lambda d: sum(d.values())
    assert abs(totals(words) - totals(want)) <= 8 * mixing.BLOCK_WORDS


def test_empty(spark):
    df = frame(spark, []).limit(0)
    assert mixing.taken_words(df).collect() == []
    assert mixing.mixed_documents(df).collect() == []


def test_no_broadcast_of_slots(spark):
    plan = mixing.taken_words(frame(spark, documents()))._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert "Python" not in plan and "SortMergeJoin" in plan


def test_shards_keep_the_order_of_the_mix(spark, tmp_path):
    """Every slot is one block of its source's words, and shards hold sources in proportion."""
    rows = documents(3)
    df = frame(spark, rows)
    mixing.write_shards(df, str(tmp_path / "mix"), shard_slots=16)
    out = spark.read.parquet(str(tmp_path / "mix")).collect()
    slots = {}
    for r in sorted(out, key=lambda r: (r.shard, r.place, r["at"])):
        slots.setdefault((r.shard, r.place), []).append(r)
    assert all(len({r.source for r in s}) == 1 for s in slots.values())
    words = {at: sum(len(WORD.findall(r.text)) for r in s) for at, s in slots.items()}
    assert max(words.values()) == mixing.BLOCK_WORDS
    shards = sorted({s for s, _ in slots})
    assert shards == list(range(len(shards))) and len(shards) > 3
    assert all({p for s, p in slots if s == k} == set(range(16)) for k in shards[:-1])
    taken = sum(r.taken for r in mixing.taken_words(df).collect())
    assert abs(sum(words.values()) - taken) <= 8 * mixing.BLOCK_WORDS
    texts = {}
    for k, t, _ in rows:
        texts.setdefault(str(k), []).append(t or "")
    assert all(any(r.text in t for t in texts[str(r.key)]) for r in out)
    mixing.write_shards(df.repartition(3), str(tmp_path / "again"), shard_slots=16)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "again")).collect()), key=repr) == sorted(map(tuple, out), key=repr)
