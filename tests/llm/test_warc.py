import base64
import glob
import gzip
import hashlib

import pytest

from tableworks.llm import warc

SCHEMA = "page_id long, url string, html string, key int, digest string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def pages():
    rows = [(i, f"http://h/{i}", f"<p>page {i} " + "é" * (i * 37 % 900)) for i in range(60)]
    rows += [(100, "http://x y/ü\r\nInjected: 1", rows[3][2]), (2000, None, rows[3][2]), (90, "u", None), (95, "u", ""), (1, "u", "other html of page 1")]
    rows += [(None, "n", rows[3][2]), (None, "n", "only without a key"), rows[7], (100, "again", rows[3][2]), (10**12, "far", "x" * 300_000)]
    return rows


def read(spark, root):
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted((tuple(r) for r in warc.read_archives(spark, root).select(*cols).collect()), key=str)


def expected(rows):
    big = 2**63 - 1
    head = {}
    for k, _, h in rows:
        d = digest(h)
        head[d] = min(head.get(d, big), big if k is None else k)
    out = []
    for k, _, h in rows:
        first = head[digest(h)] == (big if k is None else k)
        out.append((k, len((h or "").encode()), digest(h), "response" if first else "revisit", None if first else head[digest(h)]))
    return sorted(out, key=str)


@pytest.mark.parametrize("shard,file", [(10_000, 1_000), (1 << 25, 1 << 23)])
def test_round_trip(spark, tmp_path, shard, file):
    rows = pages()
    df = spark.createDataFrame([(*r, 1, "d") for r in rows], SCHEMA)
    a = warc.write_archives(df.repartition(5), str(tmp_path / "a"), shard_bytes=shard, file_bytes=file)
    assert read(spark, a) == expected(rows)
    b = warc.write_archives(df.repartition(2), str(tmp_path / "b"), shard_bytes=shard, file_bytes=file)
    names = sorted(f.rsplit("/", 1)[1] for f in glob.glob(f"{a}/*.warc.gz"))
    assert names == sorted(f.rsplit("/", 1)[1] for f in glob.glob(f"{b}/*.warc.gz"))
    assert all(open(f"{a}/{n}", "rb").read() == open(f"{b}/{n}", "rb").read() for n in names)
    assert len(names) > 10 if file == 1_000 else len(names) == 1
    raw = b"".join(gzip.open(f"{a}/{n}").read() for n in names)
    assert raw.count(b"WARC-Type: re") == len(rows) and b"\nInjected" not in raw
    payloads = {r.page_id: bytes(r.payload) for r in warc.read_archives(spark, a, payloads=True).collect() if r.record_type == "response"}
    assert payloads[5] == rows[5][2].encode()


def test_small_payloads_are_written_each(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcd" * 9), (4, "u", "abcd" * 9)], "page_id long, url string, html string")
    root = warc.write_archives(df, str(tmp_path / "a"), revisit_from=10)
    assert [r[3:] for r in read(spark, root)] == [("response", None)] * 3 + [("revisit", 3)]


def test_empty(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert read(spark, warc.write_archives(df, str(tmp_path / "a"))) == []


def test_broken_archive_is_an_error(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "some page")], "page_id long, url string, html string")
    root = warc.write_archives(df, str(tmp_path / "a"))
    [name] = glob.glob(f"{root}/*.warc.gz")
    text = gzip.open(name).read().replace(b"some page", b"same page")
    with open(name, "wb") as f:
        f.write(gzip.compress(text))
    with pytest.raises(Exception):
        read(spark, root)
