"""The pipeline against a plain version of its stages on a small table."""

import random

import pytest

import corpus_pipeline
from tableworks.llm import packing
from tests.llm.test_quality import plain as counted
from tests.llm.test_simhash import brute_components, plain as fingerprint
from tests.llm.test_suffix import brute as removed


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(12)
    words = [f"{a}{b}" for a in ("the", "ka", "lo", "mi", "ün") for b in ("", "ra", "so", "te", "po", "vi", "du")] + ["of", "and", "in"]
    prose = lambda n: " ".join(r.choices(words, k=n))
    shared = prose(60)
    texts = [prose(r.randint(60, 200)) + ". The end of it." for _ in range(40)]
    texts += [texts[0], texts[0], f"{prose(30)} {shared} {prose(40)}", f"{prose(50)} {shared} {prose(20)}", "junk### " * 40, "", None, "short text"]
    near = texts[5].split()
    near[30] = "changed"
    texts.append(" ".join(near * 1))
    rows = [(i, t, "en", f"s{i % 4}" if i % 11 else None, len(t or "")) for i, t in enumerate(texts)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}
    stages = [f for _, f in corpus_pipeline.STAGES]

    kept = stages[0](spark, docs, folder)
    assert kept.columns == columns
    good = {k: r.text for k, r in rows.items() if not counted(r.text)[-1] and "#" not in (r.text or "")}
    assert {r.doc_id: r.text for r in kept.collect()} == good

    single = stages[1](spark, kept, folder)
    fps = {k: fingerprint(t) for k, t in good.items()}
    classes = brute_components(sorted(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    first = {k: t for k, t in good.items() if classes[k] == k}
    assert single.columns == columns and {r.doc_id: r.text for r in single.collect()} == first

    left = stages[2](spark, single, folder)
    assert left.columns == columns
    got = {r.doc_id: r for r in left.collect()}
    want = {k: n - gone for k, n, gone, _, _ in removed(list(first.items()), 50)}
    assert {k: len(r.text.encode()) for k, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())

    mixed = stages[3](spark, left, folder)
    assert mixed.columns == columns
    texts = {k: r.text.split() for k, r in got.items()}
    out = mixed.collect()
    for r in out:
        assert set(r.text.split()) <= set(texts[r.doc_id]) and r.n_chars == len(r.text)
    total = sum(map(len, texts.values()))
    assert abs(sum(len(r.text.split()) for r in out) - 1.5 * total) <= 5 * 64

    packed = stages[4](spark, spark.createDataFrame(out, mixed.schema), folder).collect()
    histogram = {}
    for p in packed:
        histogram[p.n_tokens] = histogram.get(p.n_tokens, 0) + 1
    assert sum(p.n_tokens for p in packed) == sum(len(r.text.split()) for r in out)
    assert sorted({p.bucket_length for p in packed}) == packing.boundaries(histogram, 8)


def test_run(spark, folder):
    result = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "bucket", "batch", "place", "n_tokens"} <= set(result.columns)
    assert result.count() > 40
