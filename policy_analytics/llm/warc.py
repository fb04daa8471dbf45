"""Operator 3: WARC archives, with a reader that salvages what follows damage.

The writer makes one gzip member per record and lets Spark's text sink put them into
archives: the "line separator" between records is an empty gzip member, so every file is a
valid multi-member ``.warc.gz``. The reader checks every member, header, length and digest;
after a failed check it searches for the next valid member or version line, goes on from
there and logs the bytes between as a quarantined gap.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, saved, table

VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"          # of every record, so that reruns agree
RECORDS_PER_ARCHIVE = 2000
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
PIECE = 1 << 16              # bytes that are decompressed at once
HAS_DIGEST = re.compile(rb"(?i)\r\nWARC-Block-Digest:")
START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
READ_SCHEMA = ("archive string, kind string, start long, end long, inner_start long, inner_end long, reason string, record_id string, record_type string, "
               "refers_to string, target_uri string, payload_bytes long, payload_digest string, payload binary")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _one_line(value: str) -> str:
    """A header value: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def build_record(record_id: str, uri: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One record, CRLF CRLF at its end; a revisit holds the HTTP header but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [VERSION, f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{record_id}>",
             f"WARC-Date: {DATE}", "Content-Type: application/http; msgtype=response"]
    if uri is not None:
        lines.append(f"WARC-Target-URI: {_one_line(uri)}")
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{refers_to}>"]
    lines += [f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
              f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int) -> tuple[dict | None, int, str]:
    """``(record, end, "")`` of the record at ``at``, or ``(None, at, reason)``."""
    head_end = data.find(b"\r\n\r\n", at)
    if head_end < 0:
        return None, at, "header without end"
    lines = data[at:head_end].split(b"\r\n")
    if not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        return None, at, "no version line"
    head = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None, at, "header line without colon"
        head[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    length = head.get("content-length", "")
    if not re.fullmatch(r"[0-9]{1,18}", length):
        return None, at, "no content length"
    start = head_end + 4
    end = start + int(length)
    if data[end:end + 4] != b"\r\n\r\n":
        return None, at, "block cut short" if end + 4 > len(data) else "no record end after the block"
    block = data[start:end]
    if (digest := head.get("warc-block-digest")) and digest != f"sha1:{base32_sha1(block)}":
        return None, at, "block digest differs"
    kind = head.get("warc-type", "")
    payload = block
    size = len(block)
    if head.get("content-type", "").startswith("application/http"):
        http, gap, payload = block.partition(b"\r\n\r\n")
        if not gap:
            return None, at, "HTTP header without end"
        stated = re.search(rb"(?i)\r\nContent-Length: ?(\d+)", http)
        size = int(stated[1]) if kind == "revisit" and stated else len(payload)
    digest = head.get("warc-payload-digest")
    if kind != "revisit":
        if digest and digest != f"sha1:{base32_sha1(payload)}":
            return None, at, "payload digest differs"
        digest = digest or f"sha1:{base32_sha1(payload)}"
    clean = lambda v: v[1:-1] if v and v[:1] == "<" and v[-1:] == ">" else v
    return {"record_id": clean(head.get("warc-record-id")), "record_type": kind, "refers_to": clean(head.get("warc-refers-to")),
            "target_uri": head.get("warc-target-uri"), "payload_bytes": size,
            "payload_digest": (digest or "").removeprefix("sha1:") or None, "payload": payload}, end + 4, ""


def _member(data: bytes, at: int) -> tuple[bytes, int, str]:
    """Contents and end of the gzip member at ``at``; the checksum is checked.

    Of a damaged or cut member the contents up to the damage, with ``at`` as end.
    """
    unzip, out, view = zlib.decompressobj(31), [], memoryview(data)
    for start in range(at, len(data), PIECE):
        piece, before = view[start:start + PIECE], unzip.copy()
        try:
            out.append(unzip.decompress(piece))
        except zlib.error as e:
            unzip = before                                # what lies before the damaged byte still counts
            try:
                for i in range(len(piece)):
                    out.append(unzip.decompress(piece[i:i + 1]))
            except zlib.error:
                pass
            return b"".join(out), at, f"member damaged: {e}"[:80]
        if unzip.eof:
            return b"".join(out), start + len(piece) - len(unzip.unused_data), ""
    return b"".join(out), at, "member cut short"


def salvage(data: bytes) -> Iterator[dict]:
    """Records and gaps of an archive in order; no byte is passed over without a log.

    Handles plain archives, a member per record, and members with several records. ``start``
    and ``end`` are bytes of the archive, ``inner_start`` and ``inner_end`` of the member's contents (null
    outside members). Of a damaged member of several records every record whose stated block digest holds is kept;
    the bytes of the member are a gap all the same, and so is what it held besides, as far
    as it could be read. An empty archive gives nothing.
    """
    at, bad_from, why = 0, None, ""
    while at < len(data):
        found, reason = [], "no member or version line"
        end = at
        if data[at:at + 3] == b"\x1f\x8b\x08":
            inner, end, reason = _member(data, at)
            found = list(_records_of_member(inner, checked=end == at))
            if end == at and len(found) < 2:              # one record: its member is quarantined whole
                found = []
        elif data[at:at + 5] == b"WARC/":
            record, end, reason = parse_record(data, at)
            found = [record] if record else []
        if end > at:                                      # a valid member or record
            if bad_from is not None:
                yield {"kind": "gap", "start": bad_from, "end": at, "reason": why}
                bad_from = None
            for x in found:
                yield {"kind": "record", "start": at, "end": end, "reason": None} | x
            at = end
            continue
        nxt = START.search(data, at + 1)
        end = nxt.start() if nxt else len(data)
        if any(x.get("kind") != "gap" for x in found):    # records of a damaged member
            if bad_from is not None:
                yield {"kind": "gap", "start": bad_from, "end": at, "reason": why}
                bad_from = None
            for x in found:
                yield {"kind": "record", "start": at, "end": end, "reason": None} | x
        if bad_from is None:
            bad_from, why = at, reason
        at = end
    if bad_from is not None:
        yield {"kind": "gap", "start": bad_from, "end": len(data), "reason": why}


def _records_of_member(inner: bytes, checked: bool = False) -> Iterator[dict]:
    """Records inside a member; damage inside it is a gap with its place in the contents.

    With ``checked`` only records with a block digest count, which :func:`parse_record` has compared.
    """
    at, bad_from, why = 0, None, ""
    while at < len(inner):
        record, end, reason = parse_record(inner, at)
        if record and checked and not HAS_DIGEST.search(inner[at:inner.find(b"\r\n\r\n", at)]):
            record, reason = None, "no block digest in a damaged member"
        if record:
            if bad_from is not None:
                yield {"kind": "gap", "reason": why, "inner_start": bad_from, "inner_end": at}
                bad_from = None
            yield record | {"inner_start": at, "inner_end": end}
            at = end
            continue
        if bad_from is None:
            bad_from, why = at, f"in a member at {at}: {reason}"
        nxt = START.search(inner, at + 1)
        at = nxt.start() if nxt else len(inner)
    if bad_from is not None:
        yield {"kind": "gap", "reason": why, "inner_start": bad_from, "inner_end": len(inner)}


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", body: str = "html",
                   least: int = 0, records_per_archive: int = RECORDS_PER_ARCHIVE) -> None:
    """One record per row of ``pages``; equal payloads of ``least`` bytes or more are kept once.

    Of such rows the one with the largest key is the response (null keys are smallest; of
    repeated rows one), the others revisit it. A null body is an empty payload, a null url
    gives no target. Only the columns named are read.
    """
    staged = saved(pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(url).alias("url"),
        F.coalesce(F.col(body), F.lit("")).cast("binary").alias("payload"))
        .withColumn("sha", F.unhex(F.sha2("payload", 256))).withColumn("size", F.octet_length("payload")), "staged")
    groups = saved(staged.where(F.col("size") >= least).groupBy("sha", "size").agg(
        F.max(F.struct("key", "row")).alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1")
        .select(F.col("sha").alias("of"), F.col("size").alias("of_size"), "top"), "groups")
    same = (F.col("sha") == F.col("of")) & (F.col("size") == F.col("of_size"))
    rows = staged.join(groups, same, "left").select(
        "key", "url", "payload", (F.col("top").isNotNull() & (F.col("top.row") != F.col("row"))).alias("revisit"),
        F.col("top.key").alias("top"))

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name = lambda k: f"urn:page:{'null' if pd.isna(k) else int(k)}"
        for b in batches:
            yield pd.DataFrame({"member": [
                gzip.compress(build_record(name(k), u, bytes(p), name(t) if r else None), 6, mtime=0)
                for k, u, p, r, t in zip(b["key"].astype("Int64"), b["url"], b["payload"], b["revisit"], b["top"].astype("Int64"), strict=True)]})

    (rows.mapInPandas(records, "member binary").select(F.col("member").cast("string").alias("value"))
     .write.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1")
     .option("maxRecordsPerFile", records_per_archive).text(path))


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records and gaps of all archives below ``path`` (``kind`` tells them apart).

    One archive is read whole by one task, so archives bound the memory; the writer's
    hold ``RECORDS_PER_ARCHIVE`` records.
    """
    names = [f.split(":")[0].strip().split(" ")[0] for f in READ_SCHEMA.split(", ")]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for archive, content in zip(b["path"], b["content"], strict=True):
                part = []
                for x in salvage(bytes(content)):
                    if not with_payload:
                        x["payload"] = None
                    part.append({"archive": archive} | x)
                    if len(part) == 500:
                        yield _frame(part, names)
                        part = []
                yield _frame(part, names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, READ_SCHEMA)


def _frame(part: list[dict], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(part, columns=names)
    return out.astype({c: "Int64" for c in ("start", "end", "inner_start", "inner_end", "payload_bytes")})


def op3_warc_roundtrip(spark, sf_dir: str) -> DataFrame:
    """All ``pages`` written as WARC records and read back; a gap in what was just written is an error."""
    path = fresh_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    number = lambda c: F.expr(f"try_cast(substring({c}, 10) as bigint)")
    lost = F.raise_error(F.concat_ws(" ", F.lit("gap in"), "archive", "start", "reason")).cast("boolean")
    sound = F.when(F.col("kind") == "record", True).otherwise(lost)
    return read_archives(spark, path, with_payload=False).where(sound).select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT t, max(page_id) AS top FROM p GROUP BY t),
k AS (SELECT p.*, g.top, list_transform(range(8), lambda i: ('0x' || substr(h, 1 + 5 * i, 5))::BIGINT) AS parts
      FROM p JOIN g ON p.t = g.t)
SELECT page_id, strlen(t) AS payload_bytes,
       array_to_string(list_transform(parts, lambda v: array_to_string(list_transform([15, 10, 5, 0],
           lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> s) & 31)::INT + 1, 1)), '')), '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM k
"""
