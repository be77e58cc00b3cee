import hashlib
import random
import zlib

import pytest

from tableworks.llm import merkle, queries


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes, fan):
    """The root, and the siblings of each leaf level by level as (left, right)."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for p, i in zip(paths, at, strict=True):
            s = i - i % fan
            p.append(("".join(level[s:i]), "".join(level[i + 1 : s + fan])))
        at = [i // fan for i in at]
        level = [h(*level[i : i + fan]) for i in range(0, len(level), fan)]
    return level[0], paths


def plain(rows, fan=3):
    """For each row (doc_id, source, lang, n_chars, text): everything the manifest says."""
    names = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        mine = sorted((r for r in rows if r[1] == name), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((mine, *tree([leaf(r) for r in mine], fan)))
    root, tops = tree([t[1] for t in trees], fan)
    out = []
    for (mine, sub, paths), top in zip(trees, tops, strict=True):
        for r, path in zip(mine, paths, strict=True):
            path = path + top
            even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            node = leaf((*r[:4], r[4].replace("\n", ""))) if even and r[4] is not None else leaf(r)
            for left, right in path:
                node = h(left, node, right)
            out.append((r[0], leaf(r), sub, root, h(*(a + b for a, b in path)), node, node == root))
    return out


def asked(df):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect()), key=repr)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(seed, n):
    """One source with most rows, single rows, NULLs, empty and repeated texts, equal keys."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        source = r.choice(["hot"] * 6 + ["ä", "b", "", None, f"s{i}"])
        text = r.choice([None, "", "one line", "a\nb", f"ü{i}\n\n", "x" * 50_000])
        rows.append((r.choice([i, i, i, 7, None]), source, r.choice(["en", None]), r.choice([i, None]), text))
    return rows + rows[:5]


@pytest.mark.parametrize("n", [1, 130])
def test_query_is_the_plain_tree(spark, tmp_path, n):
    rows = table(n, n)
    spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3]) for r in rows], SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.REGISTRY["op11_merkle_manifest"](spark, str(tmp_path))
    assert asked(got) == sorted(plain(rows), key=repr)


@pytest.mark.parametrize("fan, depth", [(3, 1), (2, 2)])
def test_many_climbs(spark, fan, depth):
    """Blocks much smaller than the trees give the same paths."""
    rows = [r for r in table(4, 90) if r[0] is not None]
    df = spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3]) for r in rows], SCHEMA)
    made = merkle.manifest(df, fan=fan, depth=depth).select("key", "leaf", "subroot", "root", merkle.proof_digest(merkle.F.col("path")).alias("proof"))
    assert sorted(map(tuple, made.collect())) == sorted(r[:5] for r in plain(rows, fan))


def test_one_change_is_seen_and_names_do_not_clash(spark):
    rows = [(i, "a" if i < 40 else "b", i % 3, f"t{i}", i, i) for i in range(50)]
    df = spark.createDataFrame(rows, "pos long, tree string, node long, more string, block long, size long")
    made = merkle.manifest(df, "pos", "tree", ["pos", "node", "more"], {"size": merkle.F.col("size"), "key2": merkle.F.col("more")})
    out = made.collect()
    assert sorted((r.key, r.size, r.key2) for r in out) == [(i, i, f"t{i}") for i in range(50)]
    root = out[0].root
    again = made.select("key", merkle.folded(merkle.F.col("leaf"), merkle.F.col("path")).alias("to"))
    assert {r.to for r in again.collect()} == {root}
    wrong = made.select(merkle.folded(merkle.F.sha2(merkle.F.col("leaf"), 256), merkle.F.col("path")).alias("to"))
    assert root not in {r.to for r in wrong.collect()}


def test_empty(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).collect() == []
