import itertools
import random

from tableworks.llm import packing


def padding(ends, histogram):
    return sum(c * (min(e for e in ends if e >= n) - n) for n, c in histogram.items())


def test_boundaries_are_optimal():
    r = random.Random(8)
    for _ in range(40):
        histogram = {n: r.randint(1, 50) for n in r.sample(range(0, 60), r.randint(1, 9))}
        for k in (1, 2, 3, 4):
            lengths = sorted(histogram)
            best = min(
                padding([*cut, lengths[-1]], histogram)
                for m in range(min(k, len(lengths)))
                for cut in itertools.combinations(lengths[:-1], m)
            )
            ends = packing.boundaries(histogram, k)
            assert len(ends) <= k and ends[-1] == lengths[-1] and padding(ends, histogram) == best
    assert packing.boundaries({}, 4) == []


def test_pieces_and_batches(spark, monkeypatch):
    monkeypatch.setattr(packing, "SLICE_ROWS", 30)
    r = random.Random(9)
    rows = [(i, "w " * r.randint(0, 90)) for i in range(200)] + [(None, None), (None, "a b"), (5, "x y z"), (5, "x y z"), (7, "q " * 5000)]
    df = spark.createDataFrame([(*x, "n", 1) for x in rows], "doc_id long, text string, bucket string, piece int")
    got = packing.pack(df, max_length=64, budget=256, buckets=4).collect()
    spans = {}
    for p in got:
        assert 0 <= p.n_tokens <= 64 and p.padding == p.bucket_length - p.n_tokens >= 0
        spans.setdefault(str(p.key), []).append((p.first_word, p.n_tokens))
    for k, t in rows:
        n = len((t or "").split())
        want = [(a, min(64, n - a)) for a in range(0, max(n, 1), 64)]
        assert set(want) <= set(spans[str(k)])
    assert sum(p.n_tokens for p in got) == sum(len((t or "").split()) for _, t in rows)
    places = {}
    for p in got:
        places.setdefault((p.bucket, p.batch), []).append(p.place)
        assert (p.place + 1) * max(p.bucket_length, 1) <= 256
    for (bucket, batch), at in places.items():
        per = max(1, 256 // max(1, next(p.bucket_length for p in got if p.bucket == bucket)))
        last = max(b for c, b in places if c == bucket)
        assert sorted(at) == list(range(per if batch < last else len(at)))
    histogram = {}
    for p in got:
        histogram[p.n_tokens] = histogram.get(p.n_tokens, 0) + 1
    assert sum(p.padding for p in got) == padding(packing.boundaries(histogram, 4), histogram)


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    one = packing.pack(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect()
    assert [(r.key, r.n_tokens, r.bucket_length, r.batch, r.place) for r in one] == [(1, 0, 0, 0, 0)]
