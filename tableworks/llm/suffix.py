"""Repeated-passage removal by blockwise sorting of suffixes with a difference cover.

A byte goes if a passage of ``length`` bytes around it also starts in a document with
a smaller key.  No task ever holds the suffix array of the corpus: suffixes are sorted
one bucket at a time, and buckets are small.

1. Documents are written in chunks of a few MB; every later pass reads chunks.
   Documents that equal one with a smaller key are set aside (all of them goes).
2. *Cover sample.*  Offsets in a document whose remainder by 31 is in a difference
   cover: for any two offsets there is a distance below 31 at which both are in the
   cover.  So two equal passages of 50 bytes share an aligned sample of 20 bytes.  The
   sample's 20-byte strings are ranked bucket by bucket; a string in one document only
   has rank zero.
3. *Long ties.*  Suffixes can tie for the full length only where a covered sample has a
   rank: all others are dropped before any sorting, without looking at their bytes.
4. *Suffix buckets.*  The rest is dealt out by its smallest 8-byte string (so
   neighbouring suffixes travel as one string); each bucket is sorted alone, equal
   passages become neighbours and get the smallest key they occur in.  Suffixes are
   counted per smallest string first (the strings of each chunk are written then, so
   they are found once); where there are ``HOT`` or more (a frequent phrase in ever new
   contexts) each suffix travels alone and is dealt out by a hash of its own
   ``length`` bytes.  So what goes to a bucket together is less than ``HOT`` suffixes, or
   equal passages, one for each chunk.

What goes out and back is one packed row per chunk and bucket: a list of strings out,
one bit per string or suffix back.  A passage in a third of all documents is one entry
per chunk.  Ranks may be too generous (40-bit hashes), never too strict; step 4 compares
bytes.

Bits for a chunk are written under the chunk's number in the shared folder, and the
task that works on the chunk reads them there, so texts are never shuffled.  All of it
can be made again from the chunk table if executors are lost.

NULL texts are empty; texts shorter than ``length`` are left whole.  NULL keys count as
larger than all others.  Rows with equal keys do not remove each other.  Other columns
are kept.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tableworks.llm.common import new_folder, stored

LENGTH = 50
PERIOD = 31
#: A perfect difference cover: every number below 31 is a difference of two members.
COVER = (0, 1, 3, 8, 12, 18)
CHUNK_BYTES = 4 << 20
BUCKET_KEYS = 2_000_000
BUCKET_SUFFIXES = 4_000_000
#: Suffixes of one smallest string that may share a bucket; those split travel as 50 bytes each.
HOT = BUCKET_SUFFIXES // 4
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64((1 << 40) - 1)


def _hash(words, at, size):
    """64-bit hashes of the ``size`` bytes (8 or more) from each of ``at``."""
    h = np.zeros(len(at), np.uint64)
    for o in [*range(0, size - 8, 8), size - 8]:
        h ^= words[at + o]
        h *= _ODD
        h ^= h >> np.uint64(32)
    return h


def _words(data: np.ndarray) -> np.ndarray:
    """The 8-byte word from every byte on."""
    padded = np.zeros(len(data) + 64, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 56,), "<u8", padded, strides=(1,))


class Chunk:
    """The documents of a chunk as one run of bytes."""

    def __init__(self, rows: pa.StructArray, text: str, key: str, copies=()):
        texts = rows.field(text).cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        body = texts.buffers()[2]
        whole = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
        self.data = whole[offsets[0] : offsets[-1]]
        self.ends = offsets[1:] - offsets[0]
        self.starts = offsets[:-1] - offsets[0]
        self.sizes = self.ends - self.starts
        self.keys = np.asarray(rows.field(key).cast(pa.int64()).fill_null(2**63 - 1))
        self.copy = np.zeros(len(rows), bool)
        self.copy[np.asarray(copies, dtype=np.int64)] = True
        self.words = _words(self.data)

    def sample(self, length: int):
        """Places of the cover sample, their documents and hashes."""
        size, places = length - PERIOD + 1, []
        live = np.flatnonzero(~self.copy & (self.sizes >= length))
        rounds = (self.sizes[live] - size) // PERIOD + 1
        doc = np.repeat(live, rounds)
        step = np.arange(len(doc)) - np.repeat(np.cumsum(rounds) - rounds, rounds)
        base = self.starts[doc] + step * PERIOD
        places = (base[:, None] + np.array(COVER)).ravel()
        doc = np.repeat(doc, len(COVER))
        fit = places + size <= self.ends[doc]
        places, doc = places[fit], doc[fit]
        return places, doc, _hash(self.words, places, size)

    def ranked(self, length: int, buckets: int):
        """``(places, group of each place, hashes of groups, groups in many documents, bucket bounds)``."""
        places, doc, h = self.sample(length)
        order = np.argsort(h, kind="stable")
        s, d = h[order], doc[order]
        new = np.ones(len(s), bool)
        new[1:] = s[1:] != s[:-1]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(s)) - 1
        group = np.empty(len(s), np.int64)
        group[order] = np.cumsum(new) - 1
        keys = s[first]
        many = d[first] != d[last] if len(s) else np.zeros(0, bool)
        bucket = ((keys >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)
        return places, group, keys, many, np.searchsorted(bucket, np.arange(buckets + 1))

    def suffixes(self, length: int, buckets: int, bits: dict):
        """Strings of neighbouring suffixes that may be repeated, with one ranked sample at least.

        ``(start, suffixes, hash of the smallest 8 bytes)`` of each string.
        """
        places, group, keys, _, bounds = self.ranked(length, buckets)
        known = np.zeros(len(keys), bool)
        for b, packed in bits.items():
            lo, hi = bounds[b], bounds[b + 1]
            known[lo:hi] = np.unpackbits(np.frombuffer(packed, np.uint8), count=hi - lo).astype(bool)
        n = len(self.data)
        hit = np.zeros(n + 1, np.int32)
        hit[places[known[group]] + 1] = 1
        hit = np.cumsum(hit, dtype=np.int32)
        may = hit[np.minimum(np.arange(n) + PERIOD, n)] > hit[:-1]
        tail = np.zeros(n + 1, np.int32)  # suffixes too short to hold the length
        np.add.at(tail, np.maximum(self.starts, self.ends - length + 1), 1)
        np.add.at(tail, self.ends, -1)
        may &= np.cumsum(tail[:-1]) == 0
        at = np.flatnonzero(may)
        if not len(at):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        doc = np.searchsorted(self.ends, at, side="right")
        # Runs of neighbouring suffixes, laid out one after the other with their last bytes.
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (np.diff(doc) != 0)
        run = np.cumsum(new) - 1
        compact = np.arange(len(at)) + run * (length - 1)
        starts = at[new]
        sizes = np.bincount(run) + length - 1
        where = np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        v = _hash(self.words, where, 8)
        span = length - 7
        least, width = v, 1
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = span - width
        least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
        low = least[compact]
        new[1:] |= low[1:] != low[:-1]
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(at)))
        spread = low[first] * _ODD
        spread ^= spread >> np.uint64(29)
        return at[first], count, spread

    def minima(self, start: np.ndarray, count: np.ndarray, spread: np.ndarray, length: int):
        """Hashes of the smallest 8 bytes and the suffixes that distinct strings have of each."""
        body, known = self.data.tobytes(), {}
        for i, (s, e) in enumerate(zip(start.tolist(), (start + count + length - 1).tolist(), strict=True)):
            known.setdefault(body[s:e], i)
        one = np.fromiter(known.values(), np.int64, len(known))
        least, group = np.unique(spread[one], return_inverse=True)
        total = np.zeros(len(least), np.int64)
        np.add.at(total, group, count[one])
        return least, total

    def dealt(self, start: np.ndarray, count: np.ndarray, spread: np.ndarray, length: int, hot: np.ndarray):
        """``(start, suffixes, hash to deal by, document)`` of each string.

        Strings whose smallest 8 bytes are in ``hot`` (sorted) become their suffixes, each with
        a hash of all its bytes.
        """
        alone = np.isin(spread, hot)
        if alone.any():
            many = np.where(alone, count, 1)
            step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            start, alone = np.repeat(start, many) + step, np.repeat(alone, many)
            count, spread = np.where(alone, 1, np.repeat(count, many)), np.repeat(spread, many)
            spread[alone] = _hash(self.words, start[alone], length)
        return start, count, spread, np.searchsorted(self.ends, start, side="right")

    def strings(self, found: tuple, length: int, out: int, hot: np.ndarray):
        """Distinct suffix strings and their smallest keys by bucket, and where each occurs; ``found`` by ``suffixes``."""
        start, count, spread, doc = self.dealt(*found, length, hot)
        body, known, number = self.data.tobytes(), {}, np.empty(len(start), np.int64)
        for i, (s, e) in enumerate(zip(start.tolist(), (start + count + length - 1).tolist(), strict=True)):
            number[i] = known.setdefault(body[s:e], len(known))
        least = np.full(len(known), 2**63 - 1, np.int64)
        np.minimum.at(least, number, self.keys[doc])
        bucket = np.empty(len(known), np.int64)
        bucket[number] = (spread % np.uint64(out)).astype(np.int64)
        return start, count, doc, number, list(known), least, bucket


def _bits(found: np.ndarray) -> bytes:
    return np.packbits(found).tobytes()


def _fetch(root: str, chunk: int | None) -> pa.Table | None:
    """What was written for a chunk under ``root``, or all that lies there."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(root)
    if chunk is not None:
        path = f"{path}/chunk={chunk}"
    if store.get_file_info(path).type == fs.FileType.NotFound:
        return None
    files = [f.path for f in store.get_file_info(fs.FileSelector(path)) if f.path.endswith(".parquet")]
    tables = [pq.ParquetFile(store.open_input_file(f)).read() for f in sorted(files)]
    return pa.concat_tables(tables) if tables else None


def _answers(root: str, chunk: int) -> dict:
    table = _fetch(root, chunk)
    if table is None:
        return {}
    return dict(zip(table["bucket"].to_pylist(), table["bits"].to_pylist(), strict=True))


def _found(root: str, chunk: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``suffixes`` found in a chunk, as it was written."""
    row = _fetch(root, chunk)
    start, count = (np.frombuffer(row[c][0].as_buffer(), np.int32).astype(np.int64) for c in ("start", "count"))
    return np.cumsum(start), count, np.frombuffer(row["spread"][0].as_buffer(), np.uint64)


def _hot(root: str) -> np.ndarray:
    table = _fetch(root, None)
    found = table["minimum"].to_numpy() if table is not None else np.zeros(0, np.int64)
    return np.sort(found.view(np.uint64))


def _publish(df: DataFrame, path: str) -> None:
    """One folder per chunk."""
    df.repartition("chunk").write.partitionBy("chunk").parquet(path)


class Removal:
    """The passes over one table of documents; ``result`` is read from its shared folder."""

    def __init__(self, documents: DataFrame, text: str, key: str, length: int, chunk_bytes: int):
        if length < PERIOD + 7:
            raise ValueError(f"length must be {PERIOD + 7} or more")
        self.text, self.key, self.length = text, key, length
        self.root = new_folder(documents.sparkSession, "suffixes")
        self.schema = documents.schema
        self.chunks = self._chunked(documents, chunk_bytes)
        total, self.n_chunks = self.chunks.agg(F.sum("bytes"), F.count("*")).first()
        total = total or 0
        self.buckets = int(max(1, -(-total * len(COVER) // PERIOD // BUCKET_KEYS)))
        self.out = int(max(1, -(-total // BUCKET_SUFFIXES)))

    def _chunked(self, documents: DataFrame, chunk_bytes: int) -> DataFrame:
        text, key = self.text, self.key

        def chunked(batches):
            from pyspark import TaskContext

            number = TaskContext.get().partitionId() << 24
            held, size = [], 0

            def row():
                rows = pa.concat_arrays(held)
                texts = rows.field(text).fill_null("").cast(pa.binary())
                digests = [hashlib.sha256(t.as_buffer()).digest() for t in texts]
                n = sum(len(t.as_buffer()) for t in texts)
                keys = rows.field(key).cast(pa.int64()).fill_null(2**63 - 1)
                one = lambda a: pa.ListArray.from_arrays([0, len(a)], a)
                return pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.array([n], pa.int64()), one(keys), one(pa.array(digests, pa.binary())), one(rows)],
                    ["chunk", "bytes", "keys", "digests", "rows"],
                )

            for batch in batches:
                rows = batch.to_struct_array()
                sizes = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
                lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(sizes), 0))
                begin = 0
                for i, n in enumerate(lengths.tolist()):
                    size += n
                    if size >= chunk_bytes:
                        held.append(rows[begin : i + 1])
                        yield row()
                        number, begin, held, size = number + 1, i + 1, [], 0
                if begin < len(rows):
                    held.append(rows[begin:])
            if held:
                yield row()

        import pyarrow.compute  # noqa: F401

        schema = T.StructType([
            T.StructField("chunk", T.LongType()), T.StructField("bytes", T.LongType()),
            T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("digests", T.ArrayType(T.BinaryType())),
            T.StructField("rows", T.ArrayType(self.schema)),
        ])
        return stored(documents.mapInArrow(chunked, schema), f"{self.root}/chunks", compression="zstd")

    def copies(self) -> str:
        """Write the places of documents that equal one with a smaller key."""
        each = self.chunks.select("chunk", F.posexplode(F.arrays_zip("keys", "digests")).alias("at", "d")).select(
            "chunk", "at", F.col("d.keys").alias("key"), F.col("d.digests").alias("digest")
        )
        first = each.groupBy("digest").agg(F.min("key").alias("least"), F.max("key").alias("most"))
        # Written, so that the join shuffles both sides for itself and can split a hot digest.
        known = stored(first.filter("least < most").select("digest", "least"), f"{self.root}/originals")
        later = each.join(known, "digest").filter("key > least")
        path = f"{self.root}/copies"
        _publish(later.groupBy("chunk").agg(F.collect_list("at").alias("copies")), path)
        return path

    def _chunk_of(self):
        """A function that opens the rows of a batch as chunks."""
        text, key, copies = self.text, self.key, f"{self.root}/copies"

        def opened(batch):
            for i in range(batch.num_rows):
                number = batch.column(0)[i].as_py()
                rows = batch.column(1)[i].values
                table = _fetch(copies, number)
                yield number, rows, Chunk(rows, text, key, table["copies"][0].as_py() if table is not None else ())

        return opened

    def ranks(self) -> str:
        """Write which sample strings of each chunk occur in two documents or more."""
        length, buckets, opened = self.length, self.buckets, self._chunk_of()

        def out(batches):
            for batch in batches:
                for number, _, c in opened(batch):
                    _, _, keys, many, bounds = c.ranked(length, buckets)
                    packed = (keys & _LOW).view(np.uint8).reshape(-1, 8)[:, :5]
                    full = [b for b in range(buckets) if bounds[b] < bounds[b + 1]]
                    parts = [slice(bounds[b], bounds[b + 1]) for b in full]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(full, pa.int32()), pa.array([number] * len(full), pa.int64()),
                         pa.array([packed[p].tobytes() for p in parts], pa.binary()),
                         pa.array([_bits(many[p]) for p in parts], pa.binary())],
                        ["bucket", "chunk", "keys", "many"],
                    )

        def ranked(table: pa.Table) -> pa.Table:
            lists = [np.frombuffer(b, np.uint8).reshape(-1, 5) for b in table["keys"].to_pylist()]
            sizes = [len(x) for x in lists]
            wide = np.zeros((sum(sizes), 8), np.uint8)
            wide[:, :5] = np.concatenate(lists)
            keys = wide.view(np.uint64).ravel()
            many = np.concatenate([
                np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool)
                for b, n in zip(table["many"].to_pylist(), sizes, strict=True)
            ])
            order = np.argsort(keys, kind="stable")
            s = keys[order]
            same = s[1:] == s[:-1]
            twice = np.zeros(len(s), bool)
            twice[1:] |= same
            twice[:-1] |= same
            many[order[twice]] = True
            found = np.split(many, np.cumsum(sizes)[:-1])
            some = [i for i, f in enumerate(found) if f.any()]
            return pa.table({
                "chunk": table["chunk"].take(pa.array(some, pa.int64())).cast(pa.int64()),
                "bucket": table["bucket"].take(pa.array(some, pa.int64())).cast(pa.int32()),
                "bits": pa.array([_bits(found[i]) for i in some], pa.binary()),
            })

        sent = self.chunks.select("chunk", "rows").mapInArrow(out, "bucket int, chunk long, keys binary, many binary")
        path = f"{self.root}/ranks"
        _publish(sent.groupBy("bucket").applyInArrow(ranked, "chunk long, bucket int, bits binary"), path)
        return path

    def hot(self) -> str:
        """Write the strings of each chunk, and the smallest strings that ``HOT`` suffixes or more may have.

        Later passes read the strings of a chunk and need not find them again.  A chunk
        leaves out what it has less than ``least`` of; in all chunks together that is less
        than half of ``HOT``, and the other half is the limit of what is counted.
        """
        length, buckets, opened = self.length, self.buckets, self._chunk_of()
        ranks, least = f"{self.root}/ranks", max(1, HOT // 2 // max(1, self.n_chunks))

        def counted(batches):
            for batch in batches:
                for number, _, c in opened(batch):
                    start, count, spread = c.suffixes(length, buckets, _answers(ranks, number))
                    minimum, n = c.minima(start, count, spread, length)
                    some = n >= least
                    one = lambda a: pa.ListArray.from_arrays([0, len(a)], pa.array(a, pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number], pa.int64()), pa.array([np.diff(start, prepend=0).astype(np.int32).tobytes()], pa.binary()),
                         pa.array([count.astype(np.int32).tobytes()], pa.binary()), pa.array([spread.tobytes()], pa.binary()),
                         one(minimum[some].view(np.int64)), one(n[some])],
                        ["chunk", "start", "count", "spread", "minimum", "n"],
                    )

        sent = self.chunks.select("chunk", "rows").mapInArrow(
            counted, "chunk long, start binary, count binary, spread binary, minimum array<long>, n array<long>"
        )
        found, path = f"{self.root}/strings", f"{self.root}/hot"
        sent.write.partitionBy("chunk").parquet(found, compression="zstd")
        each = sent.sparkSession.read.schema("minimum array<long>, n array<long>").parquet(found)
        each = each.select(F.explode(F.arrays_zip("minimum", "n")).alias("m")).select("m.*")
        sums = each.groupBy("minimum").agg(F.sum("n").alias("n"))
        sums.filter(F.col("n") >= HOT // 2).select("minimum").write.parquet(path)
        return path

    def _sent(self) -> DataFrame:
        """The strings of each chunk by bucket."""
        length, out_buckets, opened = self.length, self.out, self._chunk_of()
        found, hot_path = f"{self.root}/strings", f"{self.root}/hot"

        def out(batches):
            hot = _hot(hot_path)
            for batch in batches:
                for number, _, c in opened(batch):
                    _, _, _, _, strings, least, bucket = c.strings(_found(found, number), length, out_buckets, hot)
                    order = np.argsort(bucket, kind="stable")
                    full, first = np.unique(bucket[order], return_index=True)
                    parts = np.split(order, first[1:]) if len(full) else []
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(full, pa.int32()), pa.array([number] * len(full), pa.int64()),
                         pa.array([b"".join(strings[i] for i in p.tolist()) for p in parts], pa.binary()),
                         pa.array([np.array([len(strings[i]) for i in p.tolist()], np.int32).tobytes() for p in parts], pa.binary()),
                         pa.array([least[p].tobytes() for p in parts], pa.binary())],
                        ["bucket", "chunk", "body", "sizes", "least"],
                    )

        return self.chunks.select("chunk", "rows").mapInArrow(
            out, "bucket int, chunk long, body binary, sizes binary, least binary"
        )

    def repeats(self) -> str:
        """Write which suffixes of each chunk's strings start in a smaller document too."""
        length = self.length

        def sort_bucket(table: pa.Table) -> pa.Table:
            body = np.frombuffer(b"".join(table["body"].to_pylist()), np.uint8)
            sizes = [np.frombuffer(b, np.int32).astype(np.int64) for b in table["sizes"].to_pylist()]
            per = [int((s - length + 1).sum()) for s in sizes]
            size = np.concatenate(sizes)
            least = np.concatenate([np.frombuffer(b, np.int64) for b in table["least"].to_pylist()])
            count = size - length + 1
            at = np.arange(count.sum()) + np.repeat((np.cumsum(size) - size) - (np.cumsum(count) - count), count)
            key = np.repeat(least, count)
            words = _words(body)
            h = _hash(words, at, length)
            order = np.argsort(h, kind="stable")
            head = _heads(words, at[order], h[order], length)
            if head is None:  # two strings with one hash: sort by all bytes
                order = np.lexsort([words[at + o] for o in [length - 8, *range(0, length - 8, 8)][::-1]])
                head = _heads(words, at[order], None, length)
            group = np.cumsum(head) - 1
            small = np.minimum.reduceat(key[order], np.flatnonzero(head))
            found = np.empty(len(at), bool)
            found[order] = small[group] < key[order]
            parts = np.split(found, np.cumsum(per)[:-1])
            some = [i for i, f in enumerate(parts) if f.any()]
            return pa.table({
                "chunk": table["chunk"].take(pa.array(some, pa.int64())).cast(pa.int64()),
                "bucket": table["bucket"].take(pa.array(some, pa.int64())).cast(pa.int32()),
                "bits": pa.array([_bits(parts[i]) for i in some], pa.binary()),
            })

        path = f"{self.root}/repeats"
        _publish(self._sent().groupBy("bucket").applyInArrow(sort_bucket, "chunk long, bucket int, bits binary"), path)
        return path

    def result(self, keep_text: bool) -> DataFrame:
        """The documents with what was removed; with ``keep_text`` their text is what is left."""
        length, out_buckets, opened = self.length, self.out, self._chunk_of()
        found, repeats, text = f"{self.root}/strings", f"{self.root}/repeats", self.text
        hot_path = f"{self.root}/hot"
        extra = [("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string")]
        fields = [f for f in self.schema.fields if keep_text or f.name != text]
        schema = T.StructType(fields + [T.StructField(f"r_{n}", T.LongType() if t == "long" else T.StringType()) for n, t in extra])
        names = [f.name for f in fields]

        def out(batches):
            hot = _hot(hot_path)
            for batch in batches:
                for number, rows, c in opened(batch):
                    start, count, doc, no, strings, least, bucket = c.strings(_found(found, number), length, out_buckets, hot)
                    answers = _answers(repeats, number)
                    wins = np.array([len(s) - length + 1 for s in strings], np.int64)
                    # Bits come bucket by bucket, in the order in which strings were sent.
                    order = np.argsort(bucket, kind="stable")
                    first = np.zeros(len(strings), np.int64)
                    ends = np.cumsum(wins[order])
                    first[order] = ends - wins[order]
                    flags = np.zeros(int(wins.sum()), bool)
                    ranges, dealt = ends - wins[order], bucket[order]
                    for b, packed in answers.items():
                        i, j = np.searchsorted(dealt, b), np.searchsorted(dealt, b, side="right") - 1
                        lo, n = ranges[i], int(ends[j] - ranges[i])
                        flags[lo : lo + n] = np.unpackbits(np.frombuffer(packed, np.uint8), count=n).astype(bool)
                    place = np.arange(count.sum()) + np.repeat(start - (np.cumsum(count) - count), count)
                    bit = flags[np.arange(count.sum()) + np.repeat(first[no] - (np.cumsum(count) - count), count)]
                    gone = bit | np.repeat(c.keys[doc] > least[no], count)
                    edge = np.zeros(len(c.data) + 1, np.int32)
                    np.add.at(edge, place[gone], 1)
                    np.add.at(edge, place[gone] + length, -1)
                    removed = np.cumsum(edge[:-1]) > 0
                    for i in np.flatnonzero(c.copy & (c.sizes >= length)):
                        removed[c.starts[i] : c.ends[i]] = True
                    begins = removed.copy()
                    begins[1:] &= ~removed[:-1]
                    at_start = c.starts[c.sizes > 0]
                    begins[at_start] = removed[at_start]
                    total, spans = np.append(0, np.cumsum(removed)), np.append(0, np.cumsum(begins))
                    kept = [c.data[s:e][~removed[s:e]].tobytes() for s, e in zip(c.starts.tolist(), c.ends.tolist(), strict=True)]
                    columns = [
                        pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()) if n == text else rows.field(n)
                        for n in names
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, pa.array(c.sizes, pa.int64()), pa.array(total[c.ends] - total[c.starts], pa.int64()),
                         pa.array(spans[c.ends] - spans[c.starts], pa.int64()),
                         pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())],
                        [f.name for f in schema.fields],
                    )

        return self.chunks.select("chunk", "rows").mapInArrow(out, schema)


def _heads(words, at, h, length):
    """Where sorted suffixes differ from the one before; None if a hash hides a difference."""
    head = np.ones(len(at), bool)
    if len(at) > 1:
        differ = np.zeros(len(at) - 1, bool)
        for o in [*range(0, length - 8, 8), length - 8]:
            w = words[at + o]
            differ |= w[1:] != w[:-1]
        if h is not None and (differ & (h[1:] == h[:-1])).any():
            return None
        head[1:] = differ
    return head


def remove_repeats(
    documents: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH,
    keep_text: bool = True, chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``documents`` with ``r_n_bytes, r_n_removed, r_n_spans, r_kept_sha256``.

    With ``keep_text`` the text is what remains (a character cut in two goes whole);
    otherwise the text column is left out.  The result is read from tables in the shared
    folder.
    """
    work = Removal(documents, text, key, length, chunk_bytes)
    work.copies()
    work.ranks()
    work.hot()
    work.repeats()
    return work.result(keep_text)


def without_repeats(documents: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``documents`` with what remains of their texts; their columns may have any name."""
    columns = documents.columns
    names = [f"c{i}" for i in range(len(columns))]
    left = remove_repeats(documents.toDF(*names), names[columns.index(text)], names[columns.index(key)])
    return left.select(*names).toDF(*columns)
