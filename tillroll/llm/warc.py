"""WARC archives with payload de-duplication: records are written, read back and resolved."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import materialize, new_path, table

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"
#: Payloads of fewer bytes are always stored in full.
MIN_REVISIT_BYTES = 1000
#: Uncompressed bytes of an archive file, about.
FILE_BYTES = 32 << 20
SLICE = 1 << 16  # bytes fed to the decompressor at once
READ_SCHEMA = ("record_id string, record_type string, page_key string, refers_to string, "
               "block_digest string, header_digest string, payload_bytes bigint")


def _record_id(key: Column) -> Column:
    """A UUID made of the key's md5, so that reruns name records alike."""
    h = F.md5(key)
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *parts))


def captures(pages: DataFrame, id_col: str, payload_col: str, url_col: str) -> DataFrame:
    """(page_key, page_id, digest, n_bytes, url, key): a row's identity without its payload.

    ``page_key`` is the id as text, empty for a null id; ``key`` joins it with the digest.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    digest, page_key = F.sha1(payload), F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return pages.select(page_key.alias("page_key"), F.col(id_col).alias("page_id"), digest.alias("digest"),
                        F.octet_length(payload).cast("long").alias("n_bytes"), F.col(url_col).alias("url"),
                        F.concat_ws("|", page_key, digest).alias("key"))


def plan_records(heads: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """One row per record: key, page_key, digest, n_bytes, url, record_id,
    record_type and refers_to (a record id).

    Only headers move.  Of equal payloads of at least ``min_bytes``, the one
    with the largest page id is the response and all others revisit it; a null
    id is below every other, the greater url decides between rows of one id,
    and of fully repeated rows (copies 1, 2, ...) the first.  The originals
    are stored, so that the join on a digest of very many pages can be split.
    """
    url = F.coalesce("url", F.lit(""))
    copies = heads.groupBy("key", "page_key", "page_id", "digest", "n_bytes", url.alias("url")).agg(
        F.count("*").alias("copies"))
    rows = copies.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    originals = materialize(copies.where(F.col("n_bytes") >= min_bytes).groupBy("digest").agg(
        F.max(F.struct(F.col("page_id").isNotNull(), "page_id", "key", "url")).alias("o")), "originals")
    rows = rows.join(originals, "digest", "left")
    same = (F.col("key") == F.col("o.key")) & (F.col("url") == F.col("o.url")) & (F.col("copy") == 1)
    revisit = F.col("o").isNotNull() & ~same
    return rows.select(
        "key", "page_key", "digest", "n_bytes", "url",
        _record_id(F.concat_ws("|", "key", "url", F.col("copy").cast("string"))).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, _record_id(F.concat_ws("|", "o.key", "o.url", F.lit("1")))).alias("refers_to"))


def _header(lines: list[tuple[str, Column]]) -> Column:
    """Header lines; a null value leaves its line out."""
    return F.concat(*(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit("")) for name, value in lines))


def _record(payload: Column) -> Column:
    """A record without its closing blank lines, which the writer adds as line separator."""
    response = F.col("record_type") == "response"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("n_bytes").cast("string"), F.lit(CRLF + CRLF))
    size = F.octet_length(http) + F.when(response, F.col("n_bytes")).otherwise(0)
    url = F.regexp_replace("url", r"[\x00-\x20]+", "%20")
    head = _header([
        ("WARC-Type", F.col("record_type")), ("WARC-Record-ID", F.concat(F.lit("<"), F.col("record_id"), F.lit(">"))),
        ("WARC-Date", F.lit(DATE)), ("WARC-Target-URI", F.when(url != "", url)),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("WARC-Refers-To", F.concat(F.lit("<"), F.col("refers_to"), F.lit(">"))),
        ("WARC-Profile", F.when(~response, F.lit(PROFILE))), ("Page-Key", F.when(F.col("page_key") != "", F.col("page_key"))),
        ("Content-Type", F.lit("application/http; msgtype=response")), ("Content-Length", size.cast("string"))])
    return F.concat(F.lit("WARC/1.1" + CRLF).cast("binary"), head.cast("binary"), F.lit(CRLF).cast("binary"),
                    http.cast("binary"), F.when(response, payload).otherwise(F.lit(b"")))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", payload_col: str = "html",
                   url_col: str = "url", min_bytes: int = MIN_REVISIT_BYTES, file_bytes: int = FILE_BYTES) -> None:
    """Write one record per row of ``pages`` to gzip archives under ``path``.

    Payloads (text in UTF-8 or bytes; null is empty) cross the network once;
    revisits are written with headers alone.  Spark's own writer makes the
    files, so that a lost or repeated task leaves no half archive, on any file
    system.  Files hold about ``file_bytes`` before compression, dealt by a
    hash of id and digest.
    """
    heads = materialize(captures(pages, id_col, payload_col, url_col), "captures")
    records = materialize(plan_records(heads, min_bytes), "records")
    total = records.where("record_type = 'response'").agg(F.sum("n_bytes")).first()[0] or 0
    files = max(1, -(-int(total) // file_bytes))
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    key = F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.sha1(payload))
    payloads = pages.select(key.alias("key"), payload.alias("payload")).mapInArrow(
        _first_of_key, "key string, payload binary").repartition(files, "key")
    payloads = payloads.groupBy("key").agg(F.first("payload").alias("payload"))
    full = records.where("record_type = 'response'").repartition(files, "key").join(payloads.hint("merge"), "key").select(
        _record(F.col("payload")).alias("record"))
    short = records.where("record_type = 'revisit'").select(_record(F.lit(b"")).alias("record"))
    lines = full.unionByName(short).select(F.col("record").cast("string").alias("value"))
    lines.write.option("lineSep", CRLF + CRLF).option("compression", "gzip").text(path)


def _first_of_key(batches):
    """Rows of each key's first occurrence in the task, so that a capture
    repeated in a third of all rows leaves every task once."""
    seen = set()
    for batch in batches:
        keep = []
        for key in batch.column(0).to_pylist():
            keep.append(key not in seen)
            seen.add(key)
        yield batch.filter(pa.array(keep, pa.bool_()))


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record; blocks are cut by Content-Length, whatever they contain."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split(CRLF)
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {name.strip(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        start = end + 4
        stop = start + int(headers["Content-Length"])
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is cut off")
        yield headers, data[start:stop]
        at = stop + 4


def unzip(data: bytes) -> bytes:
    """All gzip members of a file, one after the other; a file that isn't gzip as it is.

    Archives usually hold one member a record.  The file is fed in slices, so
    that what a member leaves over is never more than a slice.
    """
    if data[:2] != b"\x1f\x8b":
        return data
    out, at, view = [], 0, memoryview(data)
    while at < len(data):
        if data[at:at + 1] == b"\0":  # padding behind a member
            at += 1
            continue
        member = zlib.decompressobj(wbits=31)
        while not member.eof:
            if at >= len(data):
                raise ValueError("the last gzip member is cut off")
            part = view[at:at + SLICE]
            out.append(member.decompress(part))
            at += len(part) - len(member.unused_data)
    return b"".join(out)


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """The payload: what follows the HTTP headers of an HTTP message, else the block."""
    if not headers.get("Content-Type", "").startswith("application/http"):
        return block
    return block.partition(b"\r\n\r\n")[2]


def sha1_hex(value: str | None) -> str | None:
    """A header's SHA-1 in lower-case hex, whether written in hex or base32; None where there is none."""
    label, _, digest = (value or "").partition(":")
    if label.lower() != "sha1":
        return None
    return digest.lower() if len(digest) == 40 else base64.b32decode(digest.upper()).hex()


def read_archives(spark: SparkSession, path: str, pattern: str = "part-*") -> DataFrame:
    """Rows of READ_SCHEMA, one per record of any type: digest and length are
    those of the payload found in the block.

    Files are gzip with any number of members, or plain.  A record without a
    payload digest gets that of its payload, and one without Page-Key (only
    this module writes it) has none.  A record or member that is cut off is an error.
    """
    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for headers, block in parse(unzip(content.as_py())):
                    payload = payload_of(headers, block)
                    found = hashlib.sha1(payload).hexdigest()
                    rows.append({
                        "record_id": headers["WARC-Record-ID"].strip("<>"), "record_type": headers["WARC-Type"],
                        "page_key": headers.get("Page-Key"), "refers_to": headers.get("WARC-Refers-To", "").strip("<>") or None,
                        "block_digest": found,
                        "header_digest": sha1_hex(headers.get("WARC-Payload-Digest")) or found,
                        "payload_bytes": len(payload)})
                yield pa.RecordBatch.from_pylist(rows, schema=target)

    target = pa.schema([(c.split()[0], pa.int64() if c.endswith("bigint") else pa.string())
                        for c in READ_SCHEMA.split(", ")])
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("content")
    return files.mapInArrow(run, READ_SCHEMA)


def resolve(records: DataFrame) -> DataFrame:
    """Records with the payload length and digest of what they stand for, and
    the page key of the response that a revisit refers to.

    Raises when a response's payload doesn't have the digest of its header, or
    a revisit's response is missing or has another digest.
    """
    sound = F.when(F.col("block_digest") != F.col("header_digest"),
                   F.raise_error(F.concat(F.lit("payload digest differs: "), F.col("record_id")))
                   ).otherwise(F.col("header_digest"))
    responses = records.where("record_type = 'response'").select(
        "record_id", "page_key", sound.alias("payload_digest"), "payload_bytes")
    of = responses.select(F.col("record_id").alias("refers_to"), F.col("page_key").alias("refers_key"),
                          F.col("payload_digest").alias("of_digest"), F.col("payload_bytes").alias("of_bytes"))
    revisits = records.where("record_type = 'revisit'").select("record_id", "page_key", "refers_to", "header_digest")
    revisits = revisits.join(of, "refers_to", "left")
    digest = F.when(F.col("of_digest").eqNullSafe(F.col("header_digest")), F.col("of_digest")).otherwise(
        F.raise_error(F.concat(F.lit("unresolved revisit: "), F.col("record_id"))))
    return responses.select("record_id", "page_key", "payload_bytes", "payload_digest",
                            F.lit("response").alias("record_type"), F.lit(None).cast("string").alias("refers_key")
                            ).unionByName(revisits.select(
                                "record_id", "page_key", F.col("of_bytes").alias("payload_bytes"),
                                digest.alias("payload_digest"), F.lit("revisit").alias("record_type"), "refers_key"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as it comes back from the archives written of all pages."""
    path = new_path(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), path)
    out = resolve(read_archives(spark, path))
    return out.select(F.col("page_key").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
                      "record_type", F.col("refers_key").cast("long").alias("refers_to"), "record_id")


OP3_SQL = """
WITH p AS (SELECT page_id, url, COALESCE(html, '') AS html FROM pages),
h AS (SELECT page_id, url, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
o AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN MAX(page_id) OVER (PARTITION BY payload_digest) END AS original
      FROM h)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN original <> page_id THEN original END AS refers_to,
       'urn:uuid:' || substr(u, 1, 8) || '-' || substr(u, 9, 4) || '-' || substr(u, 13, 4) || '-' || substr(u, 17, 4)
       || '-' || substr(u, 21, 12) AS record_id
FROM (SELECT *, md5(page_id || '|' || payload_digest || '|' || COALESCE(url, '') || '|1') AS u FROM o)
"""
