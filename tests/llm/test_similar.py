import random

import corpus_pipeline
from tableworks.llm import similar
from tableworks.llm.common import stored


def plain(text, size=5):
    words = "".join(c.lower() if c.isascii() else c for c in (text or "")).encode().split()
    k = min(size, len(words))
    return {b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


def corpus(seed):
    """Texts with edits that leave a similarity on either side of 0.8, a chain and one large family."""
    r = random.Random(seed)
    prose = lambda n: [f"w{r.randint(0, 5000)}" for _ in range(n)]
    texts = [" ".join(prose(r.randint(60, 200))) for _ in range(30)]
    for base in texts[:20]:
        for edits in (1, 3, 4, 8):
            words = base.split()
            for at in r.sample(range(len(words)), edits):
                words[at] = f"x{r.randint(0, 5000)}"
            texts.append(" ".join(words))
    family = prose(150)
    for i in range(40):
        words = list(family)
        words[3 * i] = f"y{i}"
        texts.append(" ".join(words))
    r.shuffle(texts)
    return texts


def test_no_similar_pair_stays_and_none_goes_alone(spark):
    texts = corpus(4)
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    sets = [plain(t) for t in texts]
    alike = [(a, b) for b in range(len(sets)) for a in range(b) if jaccard(sets[a], sets[b]) >= 0.8]
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    assert len(alike) > 100 and not [p for p in alike if set(p) <= kept]
    gone = set(range(len(texts))) - {r.doc_id for r in similar.without_copies(docs).collect()}
    assert all(any(g == b for _, b in alike) for g in gone)


def test_rows_without_words_nulls_and_repeats(spark):
    rows = [(1, "one two"), (2, "One  two"), (3, ""), (4, ""), (5, None), (None, "one two"), (7, "other"), (7, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = similar.without_copies(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect())) == [1, 3, 4, 5, 7]
    assert similar.without_copies(docs.limit(0)).collect() == []


def test_a_similar_document_behind_likelier_ones_is_found(spark):
    """Forty documents look nearer than the one similar document; only their shingles tell."""
    def text(seed, run):
        words = [f"w{i}" for i in range(204)]
        words[100 : 100 + run] = [f"s{seed}x{i}" for i in range(run)]
        return " ".join(words)

    signs = lambda t: list(similar.signature(similar.shingles(t.encode())))
    own = signs(text(0, 0))
    near = lambda t: sum(a == b and c == d for a, b, c, d in zip(own[::2], signs(t)[::2], own[1::2], signs(t)[1::2])) / 100
    decoys = sorted((text(i, 20) for i in range(200)), key=near)[-40:]
    match = min((t for t in (text(i, 18) for i in range(200, 400)) if near(t) >= 0.72), key=near)
    assert jaccard(plain(text(0, 0)), plain(match)) >= 0.8 and near(match) < min(map(near, decoys))
    texts = [*decoys, match, text(0, 0)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in similar.without_copies(docs).collect()} == set(range(41))


def test_parts_and_groups_over_the_bound_are_not_broadcast(spark, monkeypatch):
    """Only the slots, bounded numbers, are broadcast where counted rows are over the bound."""
    plans = []

    def recorded(df, path, **options):
        plans.append((path.rsplit("/", 1)[-1], df._jdf.queryExecution().executedPlan().toString()))
        return stored(df, path, **options)

    monkeypatch.setattr("tableworks.llm.common.SENT", 0, raising=False)
    monkeypatch.setattr(similar, "stored", recorded)
    texts = corpus(4)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    gone = {r.key for r in similar.copies(docs, heads=8).collect()}
    sets = [plain(t) for t in texts]
    assert gone and all(any(jaccard(sets[a], sets[b]) >= 0.8 for a in range(b)) for b in gone)
    wide = [name for name, p in plans if name in ("groups", "ties", "tied") and "BroadcastExchange" in p]
    assert not wide and any(name == "groups" for name, _ in plans)
