"""Quality rules: one projection of counts and ratios held against a threshold table.

Everything is a built-in expression: no shuffle, no user function, one pass over
the text.  A document is judged from its own text alone.

NULL and empty texts have no words and fail the base rule.  Very long texts are
read whole.  Repeated rows get equal verdicts.  Other columns are passed on by
``judge``; the names it adds start with ``q_``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tableworks.llm.common import WORD, let, words_of

#: Common words of the languages served (fixed values).
STOP_WORDS = (
    "the of and to in a is that for it on as with be was at by this are from "
    "de la le et les des un une que qui est du pas pour dans sur "
    "der die das und ist von zu den mit nicht ein eine auf sich dem für "
    "el los las y en se del por con una su para es no lo"
)
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """A document passes if ``low <= signal <= high``; shorter ones than ``from_words`` pass."""

    signal: str
    low: float | None = None
    high: float | None = None
    from_words: int = 0


#: Parameters: the usual bounds for web prose.
RULES = (
    Rule("mean_word_chars", 2.0, 15.0),
    Rule("symbols_per_word", high=0.1),
    Rule("shouts_per_word", high=0.2),
    Rule("stop_word_share", low=0.02, from_words=50),
    Rule("dup_line_share", high=0.3),
    Rule("bullet_line_share", high=0.9),
    Rule("ellipsis_line_share", high=0.3),
)


def _repeat_words(words: Column) -> Column:
    """Words inside windows of five that occur twice or more.

    Windows are compared by a 64-bit hash.  Only where hashes repeat are they
    sorted to find the positions; the covered words are then the sum of the steps
    between these positions, at most a window each.
    """
    one = lambda h: F.transform(
        F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[h[i + k] for k in range(WINDOW)])
    )

    def covered(w):
        order = F.array_sort(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        at = lambda s, j: F.try_element_at(s, j + 1)["h"]
        again = lambda s: F.filter(
            s, lambda e, j: ((j > 0) & (at(s, F.greatest(j - 1, F.lit(0))) == e["h"]))
            | F.coalesce(at(s, j + 1) == e["h"], F.lit(False)),
        )
        places = F.array_sort(F.transform(let(order, again), lambda e: e["i"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(
            places, start,
            lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")),
            lambda a: a["n"],
        )

    windows = let(F.transform(words, lambda w: F.xxhash64(w)), one)
    found = let(windows, lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), covered(w)).otherwise(0))
    return F.when(F.size(words) < WINDOW, 0).otherwise(found)


def counts(text: Column, words: Column) -> dict[str, Column]:
    """The counts that rules and the base rule are made of."""
    body = F.coalesce(text, F.lit(""))
    n = lambda c: c.cast("long")
    only = lambda keep: F.length(F.regexp_replace(body, f"[^{keep}]+", ""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD))
    stop = F.size(F.filter(words, lambda w: w.isin(*dict.fromkeys(STOP_WORDS.split()))))
    return {
        "n_words": n(F.size(words)),
        "word_chars": n(F.length(F.regexp_replace(body, r"[\x20\x09-\x0D]+", ""))),
        "n_symbols": n(only("#*$%&|<>")),
        "n_shouts": n(only("!")),
        "n_stop_words": n(stop),
        "n_repeat_words": n(_repeat_words(words)),
        "lines": lines,
    }


def ratios() -> dict[str, Column]:
    """Signals of the threshold table, from the columns of ``counts``."""
    c = lambda name: F.col(f"q_{name}")
    share = lambda a, b: a / F.greatest(b, F.lit(1))
    n_lines = F.size(c("lines"))
    like = lambda pattern: F.size(F.filter(c("lines"), lambda x: x.rlike(pattern)))
    return {
        "mean_word_chars": share(c("word_chars"), c("n_words")),
        "symbols_per_word": share(c("n_symbols"), c("n_words")),
        "shouts_per_word": share(c("n_shouts"), c("n_words")),
        "stop_word_share": share(c("n_stop_words"), c("n_words")),
        "dup_line_share": share(c("n_dup_lines"), n_lines),
        "bullet_line_share": share(like(r"^[\x20\x09]*[-*•]"), n_lines),
        "ellipsis_line_share": share(like(r"(\.\.\.|…)[\x20\x09-\x0D]*$"), n_lines),
    }


def judge(documents: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``documents`` with counts, ``q_base_failed``, ``q_kept`` and the names of the failed rules."""
    with_words = documents.withColumn("q_words", words_of(F.col(text)))
    counted = with_words.withColumns({f"q_{k}": v for k, v in counts(F.col(text), F.col("q_words")).items()})
    counted = counted.withColumn(
        "q_n_dup_lines", (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long")
    )
    signal = ratios()
    tests = []
    for r in rules:
        bad = F.lit(False)
        if r.low is not None:
            bad = bad | (signal[r.signal] < r.low)
        if r.high is not None:
            bad = bad | (signal[r.signal] > r.high)
        tests.append(F.when(bad & (F.col("q_n_words") >= r.from_words), F.lit(r.signal)))
    failed = F.filter(F.array(*tests), lambda x: x.isNotNull()) if tests else F.array().cast("array<string>")
    base = (F.col("q_n_words") < 10) | (100 * F.col("q_n_repeat_words") > 20 * F.col("q_n_words"))
    return (
        counted.withColumn("q_failed", failed)
        .withColumn("q_base_failed", base)
        .withColumn("q_kept", ~F.col("q_base_failed") & (F.size("q_failed") == 0))
        .drop("q_words", "q_lines")
    )


def good_documents(documents: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``documents`` that pass, with their own columns, whatever their names."""
    names = [F.col(f"`{c}`") for c in documents.columns]
    own = documents.select(F.struct(*names).alias("own"), F.col(f"`{text}`").alias("text"))
    # The row number holds the filter above the projection; below it, each use of a count
    # would be worked out again.
    judged = judge(own, "text", rules).withColumn("at", F.monotonically_increasing_id())
    return judged.filter("q_kept AND at >= 0").select("own.*")
