"""Document fingerprints by a randomised edit embedding.

A walk reads a text from the left.  At each step it looks at the character it stands on;
a random bit, shared by all texts and given by the step and the character, says whether it
goes on to the next one.  The characters seen, step by step, are the embedding.  After an
inserted or deleted character two walks are out of step, and the shared bits soon bring
them together again: texts at a small edit distance have embeddings at a small Hamming
distance, texts that differ do not agree more often than by chance.  There are ``WALKS``
walks, and the best one counts, since a walk may only find too many differences.

A fingerprint samples the embedding.  Steps are cut into stretches of 2^level, one step is
drawn from each, and four bits of a hash of the character seen there are kept as a hex
digit.  The level follows the length of the text, so that 128 to 256 digits are kept.  The
step of a stretch is that of one of its halves, so a fingerprint can be thinned to any
higher level, and texts of any two lengths can be compared.

``likeness`` is the share of equal digits above those equal by chance, over the longer
fingerprint; ``near_copies`` finds candidates by bands of sampled digits and verifies them
by the likeness of whole fingerprints.

Texts are read whole, by code points; NULL is the empty text.  Equal texts have equal
fingerprints; two empty texts have likeness 1, an empty one and another 0.  NULL keys come
first in the order of documents, rows with one key are ordered by their text's hash, and
equal rows follow each other.  A single document is its own next one.  An empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tableworks.llm.common import new_folder, remove, stored
from tableworks.llm.components import components

WALKS = 2
#: The random bits of a walk repeat after so many steps.
PERIOD = 256
DIGITS = 256
SEED = 71
LIKENESS = 0.8
#: Banding: digits in a band, bands of a walk for each level and range.
ROWS = 8
BANDS = 8
#: Groups of more members are cut by further bands.
GROUP = 512
HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A hash of whole numbers."""
    x = (x.astype(np.uint64) + np.uint64(SEED)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=None)
def _table(walk: int) -> tuple[tuple[int, ...], ...]:
    """For each class of characters: the step (mod PERIOD) after a character that is met at a step."""
    ids = np.arange(256 * PERIOD).reshape(256, PERIOD) + (walk << 20)
    goes = (_mixed(ids) >> np.uint64(63)).astype(bool)
    rows = []
    for bits in goes:
        at = np.flatnonzero(np.concatenate([bits, bits]))
        ahead = at[np.searchsorted(at, np.arange(PERIOD))]
        rows.append(tuple(((ahead + 1) % PERIOD).tolist()))
    return tuple(rows)


def _walked(classes: bytes, at: int, walk: int) -> np.ndarray:
    """The step (mod PERIOD) after each character, beginning at step ``at``."""
    table = _table(walk)
    return np.frombuffer(bytes([at := table[c][at] for c in classes]), np.uint8)


@lru_cache(maxsize=256)
def _drawn(level: int, to: int, n: int) -> np.ndarray:
    """The stretch of level ``to`` that each of the first ``n`` stretches of ``level`` draws; level 0 is a step."""
    at = np.arange(n, dtype=np.int64)
    for k in range(level, to, -1):
        at = 2 * at + (_mixed((at << 6) | k) >> np.uint64(63)).astype(np.int64)
    return at


def _level(n: int) -> int:
    return max(0, (2 * n - 1).bit_length() - (DIGITS.bit_length() - 1)) if n else 0


def _sampled(chars: np.ndarray, after: np.ndarray, level: int) -> bytes:
    """The hex digits of a walk: ``after`` has the step after each character, mod PERIOD."""
    if not len(after):
        return b""
    # Bytes wrap round as the walk's bits do.
    before = np.concatenate([np.zeros(1, np.uint8), after[:-1]])
    ends = np.cumsum((after - before - np.uint8(1)).astype(np.int64) + 1)
    n = int(ends[-1] >> level) + 1
    drawn = _drawn(level, 0, 1 << (n - 1).bit_length())[:n]
    drawn = drawn[drawn < ends[-1]]
    seen = chars[np.searchsorted(ends, drawn, side="right")]
    return HEX[(_mixed((drawn << 21) | seen) >> np.uint64(60)).astype(np.int64)].tobytes()


class Walked:
    """A text with its walks, print and bands; another text with the same beginning need not walk there again."""

    def __init__(self, text: str, begun: Walked | None = None, shared: int = 0):
        """``shared``: so many first characters are those of ``begun``."""
        self.text = text
        self.chars = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
        classes = np.where(self.chars < 128, self.chars, (self.chars * 40503 >> 4) & 255).astype(np.uint8)[shared:].tobytes()
        self.after = []
        for walk in range(WALKS):
            old = begun.after[walk][:shared] if shared else np.zeros(0, np.uint8)
            self.after.append(np.concatenate([old, _walked(classes, int(old[-1]) if shared else 0, walk)]))
        level = _level(len(text))
        self.print = (level, [_sampled(self.chars, after, level) for after in self.after])
        self.bands = frozenset(_bands(self.print))


def _written(print_: tuple[int, list[bytes]]) -> str:
    return ".".join([f"{print_[0]:02x}", *[d.decode() for d in print_[1]]])


def _read(text: str) -> tuple[int, list[bytes]]:
    level, *digits = text.split(".")
    return int(level, 16), [d.encode() for d in digits]


def _thinned(digits: bytes, level: int, to: int) -> np.ndarray:
    """The digits that the fingerprint at the higher level ``to`` would have."""
    own = np.frombuffer(digits, np.uint8)
    if level == to or not len(own):
        return own
    n = (len(own) - 1 >> (to - level)) + 1
    at = _drawn(to, level, 1 << (n - 1).bit_length())[:n]
    return own[at[at < len(own)]]


def _likeness(a: tuple[int, list[bytes]], b: tuple[int, list[bytes]]) -> float:
    to, best = max(a[0], b[0]), 0.0
    for x, y in zip(a[1], b[1], strict=True):
        x, y = _thinned(x, a[0], to), _thinned(y, b[0], to)
        m, most = min(len(x), len(y)), max(len(x), len(y))
        if not most:
            return 1.0
        equal = int(np.count_nonzero(x[:m] == y[:m]))
        best = max(best, (equal - (m - equal) / 15) / most)
    return best


def fingerprint(text: str | None) -> str:
    """The level as two hex digits, then the digits of each walk, parted by points."""
    return _written(Walked(text or "").print)


def likeness(a: str, b: str) -> float:
    """From 0, not more alike than by chance, to 1."""
    return _likeness(_read(a), _read(b))


@lru_cache(maxsize=1024)
def _places(size: int, walk: int, extra: int) -> np.ndarray:
    """Which of ``size`` digits the bands look at."""
    at = _mixed(np.arange(ROWS * BANDS) + (extra << 30) + (walk << 20) + (size << 8)) % np.uint64(size)
    return at.astype(np.int64)


def _bands(print_: tuple[int, list[bytes]], extra: int = 0) -> list[int]:
    """Keys that two like fingerprints share: drawn digits, at the own level and range, and one below, and thinned."""
    level, keys = print_[0], []
    for to in (level, level + 1):
        for walk, digits in enumerate(print_[1]):
            own = _thinned(digits, level, to)
            top = max(len(own), 1).bit_length() - 1
            for size in {1 << top, 1 << max(top - 1, 0)}:
                part = own[_places(size, walk, extra)].tobytes() if len(own) else bytes(ROWS * BANDS)
                name = b"%d %d %d " % (to, walk, size)
                keys += [xxhash.xxh64_intdigest(name + b"%d " % i + part[i * ROWS : (i + 1) * ROWS], extra) - 2**63 for i in range(BANDS)]
    return keys


def _texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def fingerprints(documents: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, n_chars, fingerprint`` of each document."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _texts(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array([fingerprint(t) for t in texts], pa.string())],
                ["key", "n_chars", "fingerprint"],
            )

    return documents.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text")).mapInArrow(
        made, "key long, n_chars long, fingerprint string"
    )


_PAIR = pa.schema([
    ("key", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ("bands_edited", pa.int64()), ("bands_next", pa.int64()),
])
_PAIR_SQL = (
    "key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
    "near_next double, bands_edited long, bands_next long"
)
_WHOLE, _FIRST, _LAST = 0, 1, 2


def _compared(key: int | None, own: Walked, following: Walked) -> tuple:
    """A document, its second half replaced by the beginning of the next, and that next one."""
    n = len(own.text)
    kept = n - n // 2
    text = own.text[:kept] + following.text[: n // 2]
    edited = Walked(text, own, kept)
    return (
        key, n, hashlib.sha256(text.encode()).hexdigest(), _written(own.print), _written(edited.print),
        _likeness(own.print, edited.print), _likeness(own.print, following.print),
        len(own.bands & edited.bands), len(own.bands & following.bands),
    )


def _table_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document of a sorted slice with its next one; the slice's first and last text for its neighbours."""
    schema = pa.schema([("slice", pa.int32()), ("kind", pa.int32()), *_PAIR, ("text", pa.string())])
    none, held, at = (None,) * (len(_PAIR) - 1), None, None
    for batch in batches:
        rows = []
        for at, key, text in zip(*[batch.column(i).to_pylist() for i in range(2)], _texts(batch.column(2)), strict=True):
            own = Walked(text)
            rows.append((at, _WHOLE, *_compared(held[0], held[1], own), None) if held else (at, _FIRST, key, *none, text))
            held = (key, own)
        yield _table_of(rows, schema)
    if held:
        yield _table_of([(at, _LAST, held[0], *none, held[1].text)], schema)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _table_of([
            _compared(key, Walked(a), Walked(b))
            for key, a, b in zip(batch.column(0).to_pylist(), _texts(batch.column(1)), _texts(batch.column(2)), strict=True)
        ], _PAIR)


def beside_next(documents: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Each document beside the next one by ascending key (after the last: the first) and beside an edited text.

    ``key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    bands_edited, bands_next``: the edited text has its last half replaced by as many first
    characters of the next document; ``bands_`` count the keys both would meet under.

    Texts move once, into slices sorted by key.  What crosses two slices is one text each;
    they are joined by the slice's number.
    """
    spark = documents.sparkSession
    folder = new_folder(spark, "edits")
    docs = documents.select(F.col(f"`{key}`").cast("long").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    # Equal rows are told apart by their number, so that many of them make more than one slice.
    docs = docs.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    order = [F.col("key").asc_nulls_first(), "tie", "row"]
    sorted_ = docs.repartitionByRange(*order).sortWithinPartitions(*order)
    made = sorted_.select(F.spark_partition_id().alias("slice"), "key", "text").mapInArrow(
        _slices, f"slice int, kind int, {_PAIR_SQL}, text string"
    )
    made = stored(made, f"{folder}/slices", compression="zstd")
    first = made.filter(F.col("kind") == _FIRST).select("slice", F.col("text").alias("following"))
    # One number for each slice; the last one is followed by the first.
    by_number = Window.orderBy("slice")
    turn = first.select("slice", F.coalesce(F.lead("slice").over(by_number), F.first("slice").over(by_number)).alias("after"))
    last = made.filter(F.col("kind") == _LAST).select("slice", "key", "text").join(turn, "slice")
    ends = last.join(first.withColumnRenamed("slice", "after"), "after").select("key", "text", "following").mapInArrow(_ends, _PAIR_SQL)
    return made.filter(F.col("kind") == _WHOLE).select(*_PAIR.names).union(ends)


def _tied(least: float):
    """Links inside groups: each member of a set of like ones is tied to the first of them."""

    def ties(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for group in batch.column(0).to_pylist():
                prints = [_read(p["fingerprint"]) for p in group]
                left = list(range(len(group)))
                while left:
                    front, left = [left[0]], left[1:]
                    root = front[0]
                    while front:
                        i = front.pop()
                        alike = {j: _likeness(prints[i], prints[j]) >= least for j in left}
                        near, left = [j for j in left if alike[j]], [j for j in left if not alike[j]]
                        a += [group[root]["node"]] * len(near)
                        b += [group[j]["node"] for j in near]
                        front += near
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return ties


def near_copies(prints: DataFrame, least: float = LIKENESS, group: int = GROUP, depth: int = 3) -> DataFrame:
    """``key, fingerprint, component``: documents linked by a likeness of ``least``, from ``fingerprints``.

    Equal fingerprints are one member.  Groups over ``group`` members are cut by other bands,
    ``depth`` times at most, then by a hash of the member, each part with the group's first
    members: parts of one group are connected through these.
    """
    spark = prints.sparkSession
    folder = new_folder(spark, "bands")
    nodes = stored(prints.groupBy("fingerprint").agg(F.count("*").alias("n")).select(F.xxhash64("fingerprint").alias("node"), "fingerprint"), f"{folder}/nodes")
    rows, found = nodes.select("node", "fingerprint", F.lit(0).cast("long").alias("g")), None
    for level in range(depth + 1):

        def keyed(batches: Iterator[pa.RecordBatch], level=level) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys = [
                    [xxhash.xxh64_intdigest(b"%d %d" % (g, k)) - 2**63 for k in sorted(set(_bands(_read(p), level)))]
                    for p, g in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.list_(pa.int64()))], ["node", "fingerprint", "keys"])

        spread = rows.mapInArrow(keyed, "node long, fingerprint string, keys array<long>")
        spread = spread.select("node", "fingerprint", F.explode("keys").alias("g"))
        sizes = spread.groupBy("g").agg(F.count("*").alias("members"), F.min("node").alias("head")).filter("members > 1")
        here = stored(spread.join(sizes, "g"), f"{folder}/{level}")
        small, rows = here.filter(F.col("members") <= group), here.filter(F.col("members") > group)
        member = F.struct("node", "fingerprint").alias("member")
        sets = small.select("g", member)
        if level == depth:
            heads = rows.filter("node = head").select("g", "members", member)
            parts = F.expr(f"members div {group} + 1")
            sets = sets.union(rows.filter("node <> head").select(F.xxhash64("g", F.pmod(F.xxhash64("node", F.lit(1)), parts)), member)).union(
                heads.select(F.explode(F.transform(F.sequence(F.lit(0).cast("long"), parts - 1), lambda i: F.struct(F.xxhash64("g", i).alias("g")))).alias("at"), "member").select("at.g", "member")
            )
        sets = sets.groupBy("g").agg(F.sort_array(F.collect_list("member")).alias("members")).select("members")
        links = sets.mapInArrow(_tied(least), "a long, b long")
        found = links if found is None else found.union(links)
        rows = rows.select("node", "fingerprint", "g")
        if level == depth or rows.isEmpty():
            break
    known = components(stored(found.distinct(), f"{folder}/links"))
    remove(spark, *[f"{folder}/{k}" for k in range(level + 1)])
    of = nodes.join(known, "node", "left").select("fingerprint", F.coalesce("root", "node").alias("component"))
    return prints.join(of, "fingerprint").select("key", "fingerprint", "component")
