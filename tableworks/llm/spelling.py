"""Spelling variants: words one edit apart, tied to a much more frequent neighbour.

Candidates come from PartEnum signatures.  A word is a binary vector over (letter, how
often it has come before): its multiset of letters.  One inserted or deleted letter
changes one component, a replaced one two, so words one edit apart have a Hamming distance
of two at most.  Components are dealt to ``PARTS`` parts; two differing components lie in
two parts at most, so for each pair of parts a signature leaves it out and keeps the
others exactly: 15 signatures for six parts, and two words one edit apart share one.

Words of a large vocabulary share signatures by hundreds.  Groups over ``GROUP`` words are
cut again, exactly: of two words one edit apart, the shorter's first half starts both or
its second half ends both.  So a word joins four smaller groups, for either half of itself
and for either half of a word one letter shorter.  Rows are joined on these keys, and the
join keeps only pairs that an edit distance of one verifies.

A word's form is its neighbour with the largest count, if that is ``ratio`` times its own.
Counts grow along a chain of forms, which therefore ends; roots are found by doubling the
steps, in as many rounds as the logarithm of the longest chain.

Runs of letters are matched in whole texts; NULL and empty texts have none.  NULL keys
count as the empty key.  Repeated rows count again.  Ties between neighbours go to the
smaller word.  An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tableworks.llm.common import new_folder, remove, stored

PARTS = 6
GROUP = 64
RATIO = 5
LEAST_LENGTH = 6
LEAST_COUNT = 5
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def runs(documents: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, run``: the runs of Latin letters, A-Z in lower case."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    # Lower-casing a whole text is quicker, but changes accented capitals and a few signs too.
    small = F.when(body.rlike(r"[\p{Lu}&&[^A-Z]]"), F.translate(body, UPPER, UPPER.lower())).otherwise(F.lower(body))
    found = F.regexp_extract_all(small, F.lit(r"[a-zÀ-ÿ]+"), F.lit(0))
    return documents.select(F.col(f"`{key}`").alias("key"), F.explode(found).alias("run"))


def with_slips(found: DataFrame, every: int) -> DataFrame:
    """``word``: the runs, of which about one in ``every`` has lost a letter, chosen by key and run."""
    h = F.crc32(F.concat(F.coalesce(F.col("key").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    slipped = F.expr("concat(substring(run, 1, cast(h % length(run) as int)), substring(run, cast(h % length(run) as int) + 2))")
    return found.withColumn("h", h).select(F.when(F.col("h") % every == 0, slipped).otherwise(F.col("run")).alias("word"))


def counted(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of the words that are long and frequent enough."""
    long = words.filter(F.length("word") >= least_length)
    return long.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def signatures(word: Column, parts: int = PARTS) -> Column:
    """One number for each pair of parts that is left out."""
    letters = F.array_sort(F.regexp_extract_all(word, F.lit("."), F.lit(0)))
    placed = F.transform(
        letters, lambda c, i: F.struct(c.alias("c"), ((F.ascii(c) * 5 + (i - F.array_position(letters, c)) * 3) % parts).alias("part"))
    )

    def kept(p):
        of = [F.array_join(F.transform(F.filter(p, lambda e: e["part"] == k), lambda e: e["c"]), "") for k in range(parts)]  # noqa: B023
        return F.array(*of)

    part = F.transform(F.array(placed), kept)
    return F.flatten(F.transform(part, lambda p: F.array(*[
        F.xxhash64(F.lit(i * parts + j), *[p[k] for k in range(parts) if k not in (i, j)]) for i, j in combinations(range(parts), 2)
    ])))


def _halves(group: str) -> Column:
    """The keys of the smaller groups: halves of the word, and of one that is a letter shorter."""
    keys = []
    for less in (0, 1):
        m = f"(length(word) - {less})"
        keys += [f"xxhash64({group}, {m}, '<', substring(word, 1, {m} div 2))", f"xxhash64({group}, {m}, '>', right(word, {m} - {m} div 2))"]
    return F.array(*map(F.expr, keys))


def near_words(words: DataFrame, parts: int = PARTS, group: int = GROUP) -> DataFrame:
    """``a, a_n, b, b_n`` with a < b: all pairs of words exactly one edit apart. ``words`` has ``word, n``, each word once."""
    folder = new_folder(words.sparkSession, "spelling")
    keyed = words.withColumn("g", F.explode(signatures(F.col("word"), parts)))
    sized = keyed.withColumn("members", F.count("*").over(Window.partitionBy("g"))).filter("members > 1")
    keys = F.when(F.col("members") <= group, F.array("g")).otherwise(_halves("g"))
    rows = stored(sized.select("word", "n", F.explode(keys).alias("g")), f"{folder}/keyed")
    a = rows.select("g", F.col("word").alias("a"), F.col("n").alias("a_n"))
    b = rows.select("g", F.col("word").alias("b"), F.col("n").alias("b_n"))
    close = F.expr("a < b and abs(length(a) - length(b)) <= 1 and levenshtein(a, b, 1) = 1")
    pairs = stored(a.join(b, "g").filter(close).select("a", "a_n", "b", "b_n").distinct(), f"{folder}/pairs")
    remove(words.sparkSession, f"{folder}/keyed")
    return pairs


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``word, form``: the end of each chain."""
    spark, folder = forms.sparkSession, new_folder(forms.sparkSession, "roots")
    now = stored(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("open")), f"{folder}/0")
    k = 0
    while not now.filter("open").isEmpty():
        following = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        k += 1
        now = stored(
            now.join(following, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("open")),
            f"{folder}/{k}",
        )
        remove(spark, f"{folder}/{k - 1}")
    return now.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO, parts: int = PARTS, group: int = GROUP) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for ``word, n``; ``ratio`` is over 1."""
    folder = new_folder(words.sparkSession, "variants")
    words = stored(words.select("word", "n"), f"{folder}/words")
    pairs = near_words(words, parts, group)
    ways = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("n")),
    )).alias("w")).select("w.*")
    best = ways.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("least"), F.col("other").alias("word"))).alias("best")
    )
    better = -F.col("best.least") >= ratio * F.col("n")
    each = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(better, F.col("best.word")).alias("form"), F.when(better, -F.col("best.least")).alias("form_n"),
    )
    each = stored(each, f"{folder}/forms")
    roots = _roots(each.filter("form is not null").select("word", "form"))
    return each.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
