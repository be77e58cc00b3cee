"""Token counts by rank-synchronous merging.

Texts are cut at special strings and then into pre-tokens by the tokenizer's pattern.
New pre-tokens of a batch are laid out as one ragged numpy array of byte symbols.  In
each round every pre-token applies its own lowest-ranked pair, all of them at once; a
pre-token without a ranked pair is finished.  What remains is counted.  Counts of
pre-tokens are kept from batch to batch, in a table that starts anew at a fixed size.

The vocabulary file's path is a parameter; the file must exist on all executors, as
the installed package does.  No shuffle: rows stay where they are.

NULL texts are empty and have no tokens.  Very long texts are counted whole.  Repeated
rows get equal counts.  An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: The byte-level pre-tokenizer's pattern (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KNOWN_MAX = 300_000
BATCH_BYTES = 2 << 20


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it can be
    printed, else the next unused one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, unused = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in letters:
            letters[b], unused = chr(unused), unused + 1
    return [letters[b] for b in range(256)]


class Merges:
    """The ranked pairs of a byte-level vocabulary.  Symbols: bytes, then 256 + rank."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        symbol = {c: b for b, c in enumerate(byte_letters())}
        left, right = [], []
        for rank, pair in enumerate(model["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left.append(symbol[a])
            right.append(symbol[b])
            symbol.setdefault(a + b, 256 + rank)
        self.width = 256 + len(left)
        keys = np.array(left, np.int64) * self.width + np.array(right, np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.none = len(left)
        self.pattern = regex.compile(PATTERN)
        special = [t["content"] for t in model.get("added_tokens", [])]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.known: dict[str, int] = {}

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(a), self.none)
        key = a * self.width + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.none)

    def count(self, parts: list[bytes]) -> np.ndarray:
        """Symbols left of each byte string, all strings merged together."""
        sizes = np.array([len(p) for p in parts], np.int64)
        left = np.zeros(len(parts), np.int64)
        sym = np.frombuffer(b"".join(parts), np.uint8).astype(np.int64)
        own = np.repeat(np.arange(len(parts)), sizes)
        while len(sym):
            ranks = np.full(len(sym), self.none, np.int64)
            inside = own[1:] == own[:-1]
            ranks[:-1][inside] = self.rank(sym[:-1][inside], sym[1:][inside])
            first = np.flatnonzero(np.append(True, ~inside))
            lowest = np.minimum.reduceat(ranks, first)
            size = np.diff(np.append(first, len(sym)))
            done = lowest == self.none
            left[own[first[done]]] = size[done]
            going = np.repeat(~done, size)
            merge = (ranks == np.repeat(lowest, size)) & going
            # In a run of equal symbols every second pair goes, from the left.
            at = np.flatnonzero(merge)
            if len(at):
                start = np.append(True, np.diff(at) != 1)
                run = np.arange(len(at)) - np.maximum.accumulate(np.where(start, np.arange(len(at)), 0))
                at = at[run % 2 == 0]
                sym[at] = 256 + ranks[at]
                going[at + 1] = False
            sym, own = sym[going], own[going]
        return left

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        totals, split = [0] * len(texts), []
        for i, t in enumerate(texts):
            pieces = [t]
            if self.special is not None and self.special.search(t):
                pieces = self.special.split(t)
                totals[i] = len(pieces) - 1
            split.append([w for p in pieces for w in self.pattern.findall(p)])
        if len(self.known) > KNOWN_MAX:
            self.known = {}
        known = self.known
        new = list({w for words in split for w in words if w not in known})
        for i in range(0, len(new), 100_000):
            part = new[i : i + 100_000]
            known.update(zip(part, self.count([w.encode() for w in part]).tolist(), strict=True))
        return [n + sum(map(known.__getitem__, words)) for n, words in zip(totals, split, strict=True)]


@functools.lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


def token_counts(documents: DataFrame, vocabulary: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, n_bytes, n_tokens`` of each document."""

    def counted(batches):
        table = merges(vocabulary)
        for batch in batches:
            found, held, size = [], [], 0
            for t in batch.column(1):
                held.append(t.as_py())
                size += len(held[-1])
                if size >= BATCH_BYTES:
                    found += table.counts(held)
                    held, size = [], 0
            found += table.counts(held)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found, pa.int64())], ["key", "n_bytes", "n_tokens"]
            )

    body = F.coalesce(F.col(text), F.lit(""))
    rows = documents.select(F.col(key).alias("key"), body.alias("body"), F.octet_length(body).cast("long").alias("n_bytes"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(counted, f"key {kind}, n_bytes long, n_tokens long")
