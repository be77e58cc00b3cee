import random
import re
import zlib
from collections import Counter

import pytest

from tableworks.llm import queries, spelling


def one_edit(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(counts, ratio=5):
    """word -> (form, root, n, n_near, form_n)."""
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = {}
    for w in counts:
        end = w
        while form[end] is not None:
            end = form[end]
        out[w] = (form[w], end, counts[w], len(near[w]), counts.get(form[w]))
    return out


def vocabulary(seed, n):
    """Words of few letters, so that many share signatures; chains of forms, anagrams and accents."""
    r = random.Random(seed)
    words = {"".join(r.choices("abcdeé", k=r.randint(6, 9))) for _ in range(n)}
    for w in list(words)[: n // 2]:
        for _ in range(3):
            i = r.randrange(len(w))
            words.add(r.choice([w[:i] + w[i + 1 :], w[:i] + r.choice("abcÿ") + w[i:], w[:i] + "x" + w[i + 1 :]]))
    words |= {"aaaaaa", "aaaaaaa", "aaaaaaaa", "abcdef", "fedcba", "bbbbbbbbbbbbbbbbbbbbbbbbbb", "bbbbbbbbbbbbbbbbbbbbbbbbbbb"}
    return {w: r.choice([5, 6, 30, 30, 200, 1000, 5000]) for w in words if len(w) >= 5}


@pytest.mark.parametrize("group, parts", [(64, 6), (2, 6), (1, 4)])
def test_variants_are_those_of_all_pairs(spark, group, parts):
    counts = vocabulary(7, 250)
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(df, 5, parts, group).collect()}
    want = plain(counts)
    assert got == want
    assert sum(v[3] for v in want.values()) > 300 and any(v[0] not in (None, v[1]) for v in want.values())


def test_query_on_whole_texts(spark, tmp_path):
    r = random.Random(3)
    some = list(vocabulary(9, 25)) + ["Über", "×÷ÀÖß", "Straße", "ÉCOLES", "écoles", "KelvinK", "İstanbul", "short"]
    rows = [(i, " ".join(r.choices(some, k=r.randint(0, 40))) + r.choice(["", ".\n", "9", "Ω"])) for i in range(120)]
    rows += [(200, None), (201, ""), (None, "aaaaaa bbbbbb"), (202, "writing " * 3000), (202, "writing " * 3000)]
    spark.createDataFrame([(k, t, "clash") for k, t in rows], "doc_id long, text string, word string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    counts = Counter()
    lower = str.maketrans(spelling.UPPER, spelling.UPPER.lower())
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            counts[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    want = plain({w: n for w, n in counts.items() if len(w) >= 6 and n >= 5})
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in queries.REGISTRY["op12_spelling_variants"](spark, str(tmp_path)).collect()}
    assert got == want and {"écoles", "Écoles", "kelvin"} <= set(got)


def test_empty(spark):
    assert spelling.variants(spark.createDataFrame([], "word string, n long")).collect() == []
