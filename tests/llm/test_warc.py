import hashlib
from collections import Counter

import pytest

from tests.llm.helpers import everything_is_skewed, final_plan
from tillroll.llm import warc as W
from tillroll.llm.common import new_path

SCHEMA = "page_id bigint, url string, html string"
BIG = "<p>café\r\n\r\nWARC/1.1\r\n" + "x" * 1500


def rows():
    return [(1, "http://a/1", BIG), (5, "http://a/5", BIG), (3, "http://a/3", BIG), (2, None, "small"),
            (4, "http://a/4", "small"), (6, "http://a/6", None), (7, "http://a/7", ""), (8, "bad \r\nurl", "y" * 999),
            (9, "u", "y" * 999), (10, "u", "z" * 1000), (10, "u", "z" * 1000), (None, "u", "n" * 2000),
            (None, "v", BIG), (11, "long", "é" * 3_000_000)]


def round_trip(spark, data, **options):
    from pyspark.sql import functions as F
    pages = spark.createDataFrame(data, SCHEMA).withColumns({c: F.lit("clash") for c in ("key", "digest", "record_id", "copy")})
    path = new_path(spark, "test-archives")
    W.write_archives(pages, path, **options)
    return path, W.resolve(W.read_archives(spark, path)).collect()


def test_round_trip(spark):
    path, out = round_trip(spark, rows(), file_bytes=4_000_000)
    got = Counter((r["page_key"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_key"]) for r in out)
    want = Counter()
    for page, _, html in rows():
        data = (html or "").encode()
        kind, of = "response", None
        if html == BIG and page != 5:
            kind, of = "revisit", "5"
        key = None if page is None else str(page)
        want[key, len(data), hashlib.sha1(data).hexdigest(), kind, of] += 1
    twice = ("10", 1000, hashlib.sha1(b"z" * 1000).hexdigest())
    want[(*twice, "response", None)] = 1  # a repeated row is revisited by its repeats
    want[(*twice, "revisit", "10")] = 1
    assert got == want
    assert len({r["record_id"] for r in out}) == len(out)


def test_revisits_carry_no_payload(spark):
    path, _ = round_trip(spark, rows()[:3])
    import zlib
    records = [r for f in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()
               for r in W.parse(zlib.decompress(bytes(f["content"]), wbits=31))]
    assert sum(len(block) for _, block in records) < 2 * len(BIG.encode())
    for headers, block in records:
        assert int(headers["Content-Length"]) == len(block)
        assert (headers["WARC-Type"] == "revisit") == ("WARC-Refers-To" in headers)


def test_empty_table(spark):
    assert round_trip(spark, [])[1] == []


def test_broken_archives_are_refused():
    with pytest.raises(ValueError, match="cut off"):
        list(W.parse(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"))
    with pytest.raises(ValueError, match="no WARC record"):
        list(W.parse(b"HTTP/1.1 200\r\n\r\n"))


def test_unresolved_revisit_raises(spark):
    path, _ = round_trip(spark, rows()[:3])
    lonely = W.read_archives(spark, path).where("record_type = 'revisit'")
    with pytest.raises(Exception, match="unresolved revisit"):
        W.resolve(lonely).collect()


def test_reads_every_member(spark, tmp_path):
    """One gzip member a record, all records in one member, no compression: the same records."""
    import base64
    import gzip
    blocks = [b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n" + bytes([65 + i]) * (70_000 * i) for i in range(6)]
    records = []
    for i, block in enumerate(blocks):
        payload = block.partition(b"\r\n\r\n")[2]
        sha = hashlib.sha1(payload)
        digest = ["sha1:" + sha.hexdigest(), "sha1:" + base64.b32encode(sha.digest()).decode(), None][i % 3]
        head = ["WARC/1.0", "WARC-Type: response", f"WARC-Record-ID: <urn:x:{i}>", "Content-Type: application/http; msgtype=response",
                f"Content-Length:{len(block)}"] + ([f"WARC-Payload-Digest: {digest}"] if digest else [])
        records.append("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:x:info>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    records.insert(0, info)
    for name, data in (("each", b"".join(map(gzip.compress, records))), ("one", gzip.compress(b"".join(records))),
                       ("mixed", gzip.compress(records[0]) + gzip.compress(b"".join(records[1:])) + b"\0" * 9),
                       ("plain", b"".join(records))):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "a.warc.gz").write_bytes(data)
        got = W.read_archives(spark, str(folder), "*.warc.gz").collect()
        assert [r["record_id"] for r in got] == ["urn:x:info"] + [f"urn:x:{i}" for i in range(6)]
        assert [r["payload_bytes"] for r in got] == [3] + [70_000 * i for i in range(6)]
        assert all(r["block_digest"] == r["header_digest"] for r in got)
    (folder / "a.warc.gz").write_bytes(gzip.compress(records[1])[:-9])
    with pytest.raises(Exception, match="cut off"):
        W.read_archives(spark, str(folder), "*.warc.gz").collect()


def test_a_hot_digest_is_split(spark):
    heads = spark.createDataFrame([(f"k{i}", str(i), i, "same" if i % 3 else f"d{i}", 2_000, f"u{i}") for i in range(20_000)],
                                  "key string, page_key string, page_id bigint, digest string, n_bytes bigint, url string")
    with everything_is_skewed(spark):
        planned = W.plan_records(heads)
        assert "skew=true" in final_plan(planned)
    types = [(r["record_type"], r["digest"]) for r in planned.collect()]
    assert sum(t == "revisit" for t, _ in types) == sum(d == "same" for _, d in types) - 1
