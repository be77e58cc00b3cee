import numpy as np

from tableworks.llm import pivots

SCHEMA = "vec_id long, embedding array<float>, rank int"


def exact(rows, queries, k=5):
    unit = {i: np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) for i, v in rows}
    out = {}
    for q in queries:
        scores = sorted(((-round(float(unit[q] @ v), 12), i) for i, v in unit.items() if i != q))
        out[q] = [i for _, i in scores[:k]]
    return out


def found(df, queries=None, **options):
    asked = df.filter("vec_id % 50 = 0") if queries is None else queries
    got = {}
    for r in pivots.nearest(df, asked, **options).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return got


def test_whole_share_is_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[50][1]) for i in range(40)]  # one vector many times
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = found(df, pivots=16, order=8, share=1.0, block=64, query_block=3)
    assert {q: [v for _, v, _ in x] for q, x in got.items()} == exact(rows, [i for i, _ in rows if i % 50 == 0])
    assert all([r for r, _, _ in x] == [1, 2, 3, 4, 5] for x in got.values())
    assert [v for _, v, _ in got[50]] == [1000, 1001, 1002, 1003, 1004]


def test_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = exact(rows, [i for i, _ in rows if i % 50 == 0])
    got = found(df)
    hits = sum(len(set(want[q]) & {v for _, v, _ in got[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_rows_that_take_no_part(spark):
    rows = [
        (0, [1.0, 0.0], 1), (50, [0.0, 2.0], 1), (1, [1.0, 1.0], 1), (2, None, 1), (3, [0.0, 0.0], 1), (4, [None, 1.0], 1),
        (5, [float("nan"), 1.0], 1), (6, [float("inf"), 1.0], 1), (7, [1.0], 1), (None, [1.0, 0.0], 1), (50, [0.0, 2.0], 1), (100, None, 1),
    ]
    got = found(spark.createDataFrame(rows, SCHEMA))
    assert {q: [v for _, v, _ in x] for q, x in got.items()} == {0: [1, 50, 50], 50: [1, 0]}
    assert abs(got[0][0][2] - 0.5**0.5) < 1e-12


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert pivots.nearest(df, df).collect() == []
