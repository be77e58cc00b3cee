"""Reproducible randomness: a seeded hash of a row key.

Unlike ``sample`` and ``randomSplit`` the outcome does not depend on how rows are
partitioned, survives retries, and can be repeated by any SQL engine with md5.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

BUCKETS = 2**32


def key_text(key: str | Sequence[str]) -> Column:
    """Key columns as one text; NULL takes part as an empty member."""
    names = [key] if isinstance(key, str) else list(key)
    parts = [F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names]
    return parts[0] if len(parts) == 1 else F.concat_ws(":", *parts)


def shuffle_key(key: str | Sequence[str], seed: int) -> Column:
    """md5 of ``seed:key`` as hex text; ordering by it is a seeded shuffle."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key_text(key)))


def bucket(key: str | Sequence[str], seed: int) -> Column:
    """A whole number in [0, 2^32) from the first eight hex digits."""
    return F.conv(F.substring(shuffle_key(key, seed), 1, 8), 16, 10).cast("bigint")


def unit(key: str | Sequence[str], seed: int) -> Column:
    """The same as a double in [0, 1)."""
    return bucket(key, seed) / F.lit(float(BUCKETS))
