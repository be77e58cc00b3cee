"""Tokenising and n-gram expressions; every one stays in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# The character classes of the tokenisers. A word is a run of
# letters, digits and underscores in any script; white space is what Python's
# str.split() splits on; punctuation is the ASCII set without the backslash.
WORD = r"[\p{L}\p{N}_]+"
WHITESPACE = r"[\t-\r\x1c-\x1f\x{85}\p{Z}]+"
PUNCTUATION = r"""[!"#$%&'()*+,\-./:;<=>?@\[\]^_`{|}~]"""
LINE_END = r"\r\n|[\r\n]"
BLANK = "____"
START, END = "<s>", "</s>"

# The English stop words, in their usual order.
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours
yourself yourselves he him his himself she she's her hers herself it it's its
itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down
in out on off over under again further then once here there when where why how
all any both each few more most other some such no nor not only own same so
than too very s t can will just don don't should should've now d ll m o re ve y
ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn
hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't
shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn
wouldn't
""".split()


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def word_runs(text: Column | str) -> Column:
    """All word-like runs of a text, case kept."""
    return F.regexp_extract_all(_column(text), F.lit(WORD), F.lit(0))


def split_blanks(text: Column | str) -> Column:
    """Pieces between white space, none of them empty."""
    return F.filter(F.split(_column(text), WHITESPACE), lambda t: t != "")


def without_punctuation(text: Column | str) -> Column:
    return F.regexp_replace(_column(text), PUNCTUATION, "")


def sentence_tokens(line: Column | str) -> Column:
    """Lower case, punctuation removed, split on white space."""
    return split_blanks(without_punctuation(F.lower(_column(line))))


def lines(text: Column | str) -> Column:
    return F.split(_column(text), LINE_END)


def without_words(tokens: Column | str, stop: Sequence[str]) -> Column:
    return F.filter(_column(tokens), lambda t: ~t.isin(*stop)) if stop else _column(tokens)


def marked(tokens: Column | str, before: int = 1, after: int = 1,
           start: str = START, end: str = END) -> Column:
    """A sentence with start and end marks round it."""
    return F.concat(
        F.array_repeat(F.lit(start), before), _column(tokens), F.array_repeat(F.lit(end), after)
    )


def ngrams(tokens: Column | str, n: int, width: int | None = None) -> Column:
    """Each run of ``n`` neighbouring items as a struct ``g1 … gn``; none when the
    list is shorter.

    Shifted copies of the list are zipped, which is compiled code, where a lambda
    per item would be interpreted. ``width`` pads with NULL members, so that runs
    of several lengths can share one list; ``size`` then tells them apart.
    """
    items = _column(tokens)
    count = F.greatest(F.size(items) - (n - 1), F.lit(0))
    members = [F.slice(items, i + 1, count).alias(f"g{i + 1}") for i in range(n)]
    if width:
        empty = F.lit(None).cast("string")
        members += [F.array_repeat(empty, count).alias(f"g{i + 1}") for i in range(n, width)]
        members.append(F.array_repeat(F.lit(n), count).alias("size"))
    return F.arrays_zip(*members)


def fill_blank(tokens: Column | str, word: Column | str, blank: str = BLANK) -> Column:
    filler = _column(word)
    return F.transform(_column(tokens), lambda t: F.when(t == blank, filler).otherwise(t))


def cloze_tokens(tokens: Column | str) -> Column:
    """Strip punctuation inside tokens and drop the last one if nothing is left."""
    stripped = F.transform(_column(tokens), without_punctuation)
    last_empty = F.element_at(stripped, -1) == ""
    return F.when(F.size(stripped) == 0, stripped).otherwise(
        F.when(last_empty, F.slice(stripped, 1, F.size(stripped) - 1)).otherwise(stripped)
    )
