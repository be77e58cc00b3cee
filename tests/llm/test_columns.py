"""Stages keep a caller's columns, whatever they are called."""

import random

import pytest

from tableworks.llm import mixing, quality, similar, simhash, suffix

NAMES = [
    "_id", "_n", "_hash", "_key", "_row", "_at", "_plan", "_round", "_tokens", "own", "key", "row", "slot", "name", "at", "text2",
    "q_n_words", "q_lines", "q_kept", "r_n_bytes", "r_kept_sha256", "tokens", "round", "doc", "g", "signature", "a.b", "size", "start",
]


@pytest.fixture(scope="module")
def docs(spark):
    r = random.Random(2)
    words = ["the", "of", "and", "in"] + [f"{a}{b}" for a in ("ka", "lo", "mi") for b in ("ra", "so", "te", "po")]
    texts = [" ".join(r.choices(words, k=60)) for _ in range(12)]
    rows = [(i, t, f"s{i % 3}", *[f"{c}{i}" for c in NAMES]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` {'long' if c == 'doc_id' else 'string'}" for c in ["doc_id", "text", "source", *NAMES]))


@pytest.mark.parametrize("stage", [
    quality.good_documents, simhash.without_near_duplicates, similar.without_copies, suffix.without_repeats, mixing.mixed_documents,
])
def test_columns_are_kept(docs, stage):
    out = stage(docs)
    assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    got = {tuple(r[c] for c in ["doc_id", *NAMES]) for r in out.collect()}
    assert got == {(i, *[f"{c}{i}" for c in NAMES]) for i in range(12)}
