import hashlib
import random

import pytest

from tableworks.llm import edits, queries


def prose(r, n):
    words = [f"{a}{b}{c}" for a in ("the", "ka", "lo", "mü") for b in ("ra", "so", "te") for c in ("", "n", "s")]
    return " ".join(r.choices(words, k=n))


def edited(r, text, n):
    for _ in range(n):
        i = r.randrange(len(text))
        text = r.choice([text[:i] + text[i + 1 :], text[:i] + "q" + text[i:], text[:i] + "z" + text[i + 1 :]])
    return text


def walk_by_steps(text, walk):
    """The embedding, one step after the other: (step, character)."""
    bits = (edits._mixed(edits.np.arange(256 * edits.PERIOD).reshape(256, -1) + (walk << 20)) >> edits.np.uint64(63)).tolist()
    out, i = [], 0
    while i < len(text):
        c = ord(text[i])
        out.append(c)
        i += bits[c if c < 128 else (c * 40503 >> 4) & 255][(len(out) - 1) % edits.PERIOD]
    return out


@pytest.mark.parametrize("text", ["a", "ab ü", "x" * 700, None])
def test_digits_are_those_of_the_plain_walk(text):
    text = text or prose(random.Random(2), 900)
    level, *walks = edits.fingerprint(text).split(".")
    for walk, digits in enumerate(walks):
        seen = walk_by_steps(text, walk)
        steps = []
        for at in range((len(seen) >> int(level, 16)) + 1):
            for k in range(int(level, 16), 0, -1):
                at = 2 * at + int(edits._mixed(edits.np.array([(at << 6) | k]))[0] >> 63)
            if at < len(seen):
                steps.append(at)
        want = [int(edits._mixed(edits.np.array([(s << 21) | seen[s]]))[0] >> 60) for s in steps]
        assert digits == "".join(f"{d:x}" for d in want)


def test_likeness_follows_the_edits():
    r = random.Random(1)
    mean = {}
    for n in (0, 1, 4, 400):
        pairs = [(t, edited(r, t, n)) for t in (prose(r, r.randint(100, 1500)) for _ in range(30))]
        values = [edits.likeness(edits.fingerprint(a), edits.fingerprint(b)) for a, b in pairs]
        assert all(0 <= v <= 1 for v in values)
        mean[n] = sum(values) / len(values)
    assert mean[0] == 1 and mean[1] > 0.95 and mean[4] > 0.85 and mean[400] < 0.5
    far = [edits.likeness(edits.fingerprint(prose(r, r.randint(50, 900))), edits.fingerprint(prose(r, r.randint(50, 900)))) for _ in range(40)]
    assert sum(far) / len(far) < 0.15
    long = prose(r, 1000)
    halves = edits.likeness(edits.fingerprint(long), edits.fingerprint(long[: len(long) // 2]))
    assert 0.4 < halves < 0.6
    assert [edits.likeness(edits.fingerprint(a), edits.fingerprint(b)) for a, b in (("", None), ("", "x"), ("x", "x"))] == [1, 0, 1]


def table(spark, path, rows, parts=4):
    spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, key string, slice int").repartition(parts).write.parquet(f"{path}/documents.parquet")


@pytest.mark.parametrize("n", [1, 2, 60])
def test_query_is_the_plain_comparison(spark, tmp_path, n):
    r = random.Random(n)
    rows = [(i * 7 % 61, r.choice([prose(r, r.randint(1, 300)), "", None, "ü" * 999, "same text"])) for i in range(n)]
    if n > 2:
        rows += [(None, "no key"), (61, prose(r, 40_000))]
    table(spark, tmp_path, rows)
    ordered = sorted(((k, t or "") for k, t in rows), key=lambda x: (x[0] is not None, x[0]))
    want = []
    for (key, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        m = len(text) // 2
        other = text[: len(text) - m] + following[:m]
        a, b, c = map(edits.fingerprint, (text, other, following))
        want.append((key, len(text), hashlib.sha256(other.encode()).hexdigest(), a, b, edits.likeness(a, b), edits.likeness(a, c)))
    got = queries.REGISTRY["op13_edit_fingerprints"](spark, str(tmp_path))
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(want, key=repr)


def test_equal_keys_and_rows(spark, tmp_path):
    """Rows with one key follow each other in some fixed order; each is in the result once."""
    rows = [(5, "a b c")] * 30 + [(5, "other words"), (1, "first one")]
    table(spark, tmp_path, rows)
    got = queries.REGISTRY["op13_edit_fingerprints"](spark, str(tmp_path)).collect()
    assert sorted((g.doc_id, g.fingerprint) for g in got) == sorted((k, edits.fingerprint(t)) for k, t in rows)


@pytest.mark.parametrize("group, depth", [(512, 3), (8, 1)])
def test_near_copies(spark, group, depth):
    r = random.Random(6)
    texts = [prose(r, r.randint(80, 400)) for _ in range(25)]
    families = [[edited(r, t, k % 3) for k in range(12)] for t in texts] + [[prose(r, 120)] for _ in range(25)] + [["", "", None]]
    rows = [(i, j, t) for i, f in enumerate(families) for j, t in enumerate(f)]
    df = spark.createDataFrame([(i * 100 + j, t) for i, j, t in rows], "doc_id long, text string").repartition(3)
    prints = edits.fingerprints(df)
    got = {row.key: row.component for row in edits.near_copies(prints, group=group, depth=depth).collect()}
    assert len(got) == len(rows)
    of = {}
    for key, component in got.items():
        of.setdefault(component, set()).add(key // 100)
    assert all(len(members) == 1 for members in of.values())
    together = sum(got[i * 100] == got[i * 100 + j] for i, j, _ in rows)
    assert together > 0.95 * len(rows)


def test_empty(spark, tmp_path):
    table(spark, tmp_path, [], 1)
    assert queries.REGISTRY["op13_edit_fingerprints"](spark, str(tmp_path)).collect() == []
    df = spark.createDataFrame([], "doc_id long, text string")
    assert edits.near_copies(edits.fingerprints(df)).collect() == []
