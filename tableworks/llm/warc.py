"""A deterministic sharded WARC writer, and its reader.

Records are put in the order of (key, payload digest).  The running total of payload
bytes in that order gives each record's shard, so shards are near equal in bytes and do
not depend on how the input or the cluster is partitioned.  Pages are shuffled once, to
their shard; inside it they are sorted and written as gzip members, a new file beginning
when the compressed size is reached.  All headers and digests are made anew from the
payload.

Of records with equal payloads the one with the smallest key is a response; the others
are revisits that name it.  Which ones is decided on digests alone; the notes about
revisits meet their pages in the shard, just before them in the sort order.

A task writes under a temporary name that only it uses.  The rows it returns are the
manifest, written as a table, so attempts that failed leave no trace in it.  A second
job then gives the listed files their final names (doing so twice is harmless), and the
list of final names is written last: archives without it are not read.

NULL payloads are empty.  NULL keys come last; they are written as ``null`` and are
responses only if no other record has the payload.  Repeated rows are written each; they
have the type of their twins.  URLs are written with odd characters percent-encoded; a
NULL URL is replaced by the record's own name.  An empty table gives an empty list.
"""

from __future__ import annotations

import base64
import hashlib
import urllib.parse
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tableworks.llm.common import new_folder, remove, stored

SHARD_BYTES = 32 << 20
FILE_BYTES = 8 << 20
LEVEL = 6
LAST = 2**63 - 1
_URL_SAFE = "".join(chr(c) for c in range(33, 127))


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _header(fields: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def _name(key: int, digest: str, n: int) -> str:
    return f"<urn:page:{'null' if key == LAST else key}:{digest}:{n}>"


def record(key: int, n: int, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC record; ``n`` tells records of the same page and payload apart."""
    digest = base32(hashlib.sha1(payload).digest())
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = _name(key, digest, n)
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", name), ("WARC-Date", date),
        ("WARC-Target-URI", urllib.parse.quote(url, safe=_URL_SAFE) if url else name[1:-1]),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{base32(hashlib.sha1(block).digest())}"),
    ]
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", _name(refers_to, digest, 0)),
        ]
    fields.append(("Content-Length", str(len(block))))
    return _header(fields) + block + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class _Files:
    """The files of one shard, written under temporary names."""

    def __init__(self, root: str, shard: int, file_bytes: int, date: str):
        from pyarrow import fs

        self.store, self.path = fs.FileSystem.from_uri(root)
        self.shard, self.file_bytes, self.date = shard, file_bytes, date
        self.part, self.out, self.done = 0, None, []

    def add(self, data: bytes) -> None:
        if self.out is None:
            self.name = f"shard-{self.shard:06d}-{self.part:05d}.warc.gz"
            self.temporary = f"_temporary/{self.name}.{uuid.uuid4().hex}"
            self.out = self.store.open_output_stream(f"{self.path}/{self.temporary}", compression=None)
            self.size, self.records, self.sum = 0, 0, hashlib.sha256()
            text = b"software: tableworks\r\nformat: WARC File Format 1.1\r\n"
            info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:file:{self.name}>"), ("WARC-Date", self.date),
                    ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(text)))]
            self._put(_header(info) + text + b"\r\n\r\n")
        self._put(data)
        self.records += 1
        if self.size >= self.file_bytes:
            self.close()

    def _put(self, data: bytes) -> None:
        packed = _gzip(data)
        self.out.write(packed)
        self.sum.update(packed)
        self.size += len(packed)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.shard, self.part, self.name, self.temporary, self.records, self.size, self.sum.hexdigest()))
            self.part, self.out = self.part + 1, None


_MANIFEST = "shard int, part int, name string, temporary string, records long, bytes long, sha256 string"


def _starts(index: DataFrame, shard_bytes: int, folder: str) -> list:
    """The first (key, digest) of each shard, from the exact running total of bytes."""
    slices = stored(
        index.repartitionByRange("key", "digest").withColumn("slice", F.spark_partition_id()), f"{folder}/slices"
    )
    sums = slices.groupBy("slice").agg(F.sum(F.col("bytes") + 512).alias("n"))
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("slice").orderBy("key", "digest").rowsBetween(Window.unboundedPreceding, -1)
    at = slices.withColumn("inner", F.coalesce(F.sum(F.col("bytes") + 512).over(inside), F.lit(0))).join(F.broadcast(base), "slice")
    shard = F.expr(f"(base + inner) div {shard_bytes}")
    first = at.groupBy(shard.alias("shard")).agg(F.min(F.struct("key", "digest")).alias("first"))
    return [r["first"] for r in first.orderBy("shard").collect()]


def _shard_of(starts: list):
    """The shard of (key, digest): a binary search among the shards' first records."""
    if len(starts) < 2:
        return F.lit(0)
    rows = ", ".join(f"named_struct('key', {s['key']}L, 'digest', '{s['digest']}')" for s in starts)
    steps = len(starts).bit_length()
    middle = "cast((s.lo + s.hi) / 2 as int)"
    step = (
        f"if(s.hi - s.lo <= 1, s, if(element_at(array({rows}), {middle} + 1) <= named_struct('key', key, 'digest', digest), "
        f"named_struct('lo', {middle}, 'hi', s.hi), named_struct('lo', s.lo, 'hi', {middle})))"
    )
    return F.expr(
        f"aggregate(sequence(1, {steps}), named_struct('lo', 0, 'hi', {len(starts)}), (s, i) -> {step}, s -> s.lo)"
    )


def write_archives(
    pages: DataFrame, root: str | None = None, key: str = "page_id", url: str = "url", body: str = "html",
    shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES, revisit_from: int = 0, date: str = "2000-01-01T00:00:00Z",
) -> str:
    """Write ``pages`` as archives under ``root`` (by default a new shared folder), and return it.

    Payloads of ``revisit_from`` bytes or more are written once.
    """
    spark = pages.sparkSession
    root = root or new_folder(spark, "archives")
    work = new_folder(spark, "archive-plan")
    payload = F.encode(F.coalesce(F.col(body), F.lit("")), "utf-8")
    rows = pages.select(
        F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("key"), F.sha1(payload).alias("digest"),
        F.col(url).alias("url"), payload.alias("payload"),
    )
    index = stored(rows.select("key", "digest", F.octet_length("payload").cast("long").alias("bytes")), f"{work}/index")
    heads = index.filter(F.col("bytes") >= revisit_from).groupBy("digest").agg(F.min("key").alias("head"), F.max("key").alias("most"))
    notes = index.join(heads.filter("head < most"), "digest").filter("key > head").select("key", "digest", "head").distinct()
    starts = _starts(index, shard_bytes, work)
    shards = max(1, len(starts))
    nothing = lambda kind: F.lit(None).cast(kind)
    both = rows.select("key", "digest", F.lit(1).alias("kind"), "url", "payload", nothing("long").alias("head")).union(
        notes.select("key", "digest", F.lit(0), nothing("string"), nothing("binary"), "head")
    )
    placed = both.withColumn("shard", _shard_of(starts)).repartitionById(shards, F.col("shard"))
    placed = placed.sortWithinPartitions("shard", "key", "digest", "kind", "url")

    def write(batches):
        files, note, last, n = None, None, None, 0
        for batch in batches:
            for r in range(batch.num_rows):
                k, digest, kind, link, data, head, shard = (c[r] for c in batch.columns)
                here = (k.as_py(), digest.as_py())
                if kind.as_py() == 0:
                    note = (*here, head.as_py())
                    continue
                n = n + 1 if here == last else 0
                last = here
                revisit = note is not None and note[:2] == here
                if files is None or files.shard != shard.as_py():
                    if files is not None:
                        files.close()
                        yield listed(files.done)
                    files = _Files(root, shard.as_py(), file_bytes, date)
                files.add(_gzip_ready(here[0], n, link.as_py(), data.as_py(), note[2] if revisit else None, revisit))
        if files is not None:
            files.close()
            yield listed(files.done)

    def _gzip_ready(k, n, link, data, head, revisit):
        return record(k, n, link, data, head, revisit, date)

    def listed(done):
        names = [f.split()[0] for f in _MANIFEST.split(", ")]
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], kinds[i]) for i in range(7)], names)

    def place(batches):
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(root)
        for batch in batches:
            for name, temporary in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if store.get_file_info(f"{path}/{temporary}").type != fs.FileType.NotFound:
                    store.move(f"{path}/{temporary}", f"{path}/{name}")
            yield batch

    _folder(spark, f"{root}/_temporary")
    manifest = stored(placed.mapInArrow(write, _MANIFEST), f"{root}/_written")
    stored(manifest.mapInArrow(place, _MANIFEST).drop("temporary"), f"{root}/_manifest")
    remove(spark, f"{root}/_temporary", f"{root}/_written", work)
    return root


def _folder(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(at)


def _members(stream):
    """The gzip members of a stream, unpacked one by one."""
    z, held, data = zlib.decompressobj(31), [], stream.read(1 << 20)
    while data:
        held.append(z.decompress(data))
        if z.eof:
            yield b"".join(held)
            data, z, held = z.unused_data, zlib.decompressobj(31), []
            if data:
                continue
        data = stream.read(1 << 20)


def _records(member: bytes):
    """Header and block of each record of a member; usually there is one."""
    at = 0
    while at < len(member):
        end = member.index(b"\r\n\r\n", at)
        h = _fields(member[at:end])
        stop = end + 4 + int(h["Content-Length"])
        yield h, member[end + 4 : stop]
        at = stop + 4


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if line)


def _page(name: str | None) -> int | None:
    text = name.split(":")[2] if name else "null"
    return None if text == "null" else int(text)


def read_archives(spark: SparkSession, root: str, payloads: bool = False) -> DataFrame:
    """The page records of committed archives.

    Digests are compared with the bytes; a difference is an error.  A revisit has no
    payload; its length is what the stored HTTP header says.
    """
    manifest = spark.read.parquet(f"{root}/_manifest")
    shards = (manifest.agg(F.max("shard")).first()[0] or 0) + 1
    files = manifest.select("shard", "name").repartitionById(shards, F.col("shard"))
    names = ["page_id", "record_type", "refers_to", "payload_digest", "payload_bytes", "target_uri", "record_id", "payload"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]

    def read(batches):
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(root)
        for batch in batches:
            for name in batch.column(1).to_pylist():
                with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    rows, size = [], 0
                    for h, block in (r for member in _members(stream) for r in _records(member)):
                        if h["WARC-Type"] == "warcinfo":
                            continue
                        http, payload = block.split(b"\r\n\r\n", 1)
                        digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                        response = h["WARC-Type"] == "response"
                        sound = h["WARC-Block-Digest"] == f"sha1:{base32(hashlib.sha1(block).digest())}"
                        if not sound or response and base32(hashlib.sha1(payload).digest()) != digest:
                            raise ValueError(f"{name}: {h['WARC-Record-ID']} does not have its digest")
                        rows.append((
                            _page(h["WARC-Record-ID"][1:-1]), h["WARC-Type"], _page(h.get("WARC-Refers-To", "")[1:-1]), digest,
                            len(payload) if response else int(_fields(http)["Content-Length"]), h["WARC-Target-URI"],
                            h["WARC-Record-ID"], payload if payloads and response else None,
                        ))
                        size += len(payload) if payloads else 200
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(8)], names)
                            rows, size = [], 0
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(8)], names)

    found = files.mapInArrow(
        read, "page_id long, record_type string, refers_to long, payload_digest string, payload_bytes long, "
        "target_uri string, record_id string, payload binary"
    )
    return found if payloads else found.drop("payload")
