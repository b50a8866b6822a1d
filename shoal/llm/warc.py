"""WARC archives: a writer, and a splittable reader of compressed archives.

Writing: each record is a gzip member of its own.  Equal payloads are found by their SHA-1 in one aggregation; all but the first
become revisit records.  Members are written by Spark's text sink, so that its commit protocol, retries and any Hadoop
file system serve: the sink ends each line with a separator, and every member ends with a zero byte (the top byte
of its length; a member of 16 MB or more is followed by an empty one), so that the separator "\\0" is that byte.

Reading: tasks get byte ranges of archives.  In its range, a task looks for the magic of gzip, takes a candidate as a member if
it decodes to a WARC header, and owns the records of members that start inside, though they may end beyond.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.llm.arrowtext import text_slices

MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of an archive that a task scans, of a read, and that a read may expand to at once.
RANGE_BYTES, READ_BYTES, EXPANDED = 16_000_000, 1_000_000, 4_000_000
#: Rows of one payload that make it a hot key, and keys that its rows are dealt to.
HOT, SALTS = 1_000_000, 64
#: Of the compression of members.
LEVEL = 6
_ID = "urn:page:"

RECORD = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("refers_to_id", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("computed_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(page: int | None, url: str | None, payload: bytes, digest: str, first: int | None, date: str, level: int) -> bytes:
    """A record as a gzip member; ``first``: the page that it revisits."""
    name = "" if page is None else str(page)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first is not None else http + payload
    uri = re.sub(r"[^\x21-\x7e]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode("utf-8", "replace")), url) if url else f"{_ID}{name}"
    lines = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: <{_ID}{name}>", f"WARC-Target-URI: {uri}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}"]
    if first is not None:
        lines += [f"WARC-Refers-To: <{_ID}{first}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    packed = []
    for part in (["\r\n".join(lines).encode() + block + b"\r\n\r\n"], []):
        c = zlib.compressobj(level, zlib.DEFLATED, 31)
        packed.append(b"".join([*map(c.compress, part), c.flush()]))
    return packed[0] if packed[0][-1] == 0 else packed[0] + packed[1]


def revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page, digest, first) of the rows of ``pages`` (page, digest, size) whose payload an earlier page has.

    The number of rows of a payload doesn't matter: the least page is found with partial aggregation, and
    only ids and digests are joined, those of hot payloads (an empty page, a template) by several keys.
    """
    large = pages.where((F.col("size") >= least) & F.col("page").isNotNull()).select("page", "digest")
    firsts = large.groupBy("digest").agg(F.min("page").alias("first"), F.max("page").alias("last"), F.count("*").alias("n")).where("first < last")
    hot = firsts.where(F.col("n") >= HOT).select("digest", F.lit(True).alias("hot"))  # one in ``HOT`` rows at most
    salts = F.when(F.col("n") >= HOT, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    dealt = large.join(F.broadcast(hot), "digest", "left").withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("page"), F.lit(SALTS)).cast("int")).otherwise(F.lit(0)))
    return dealt.join(firsts.select("digest", "first", F.explode(salts).alias("salt")), ["digest", "salt"]).where("page > first").select("page", "digest", "first").distinct()


def write(df: DataFrame, path: str, *, page: str = "page_id", url: str = "url", html: str = "html", least: int = 0, date: str = "2024-01-01T00:00:00Z", level: int = LEVEL) -> None:
    """Writes a record for each row. A null payload is empty.

    Of equal payloads of ``least`` bytes or more, that with the smallest page is a response record, larger pages revisit it; repeated rows of that page are responses too,
    and so are rows whose page is null (their record id has no number). Without rows, the archives are empty.
    """
    rows = df.select(F.col(f"`{page}`").cast("bigint").alias("page"), F.col(f"`{url}`").cast("string").alias("url"), F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("html")).withColumn("digest", F.sha1("html"))
    earlier = revisits(rows.select("page", "digest", F.octet_length("html").alias("size")), least)
    marked = rows.join(earlier, ["page", "digest"], "left").select("page", "url", "html", "digest", "first")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "html"):
            page, url, html, digest, first = (c.to_pylist() for c in part.columns)
            out = [member(p, u, h.encode("utf-8", "replace"), base64.b32encode(bytes.fromhex(d)).decode(), f, date, level)[:-1] for p, u, h, d, f in zip(page, url, html, digest, first, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    members = marked.mapInArrow(pack, "member binary")
    members.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").option("compression", "none").text(path)


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", re.sub(r"^file:/(?!/)", "file:///", path)))


def reachable(path: str) -> bool:
    """Whether tasks can open a path by themselves. Other file systems only Spark reads, a whole archive at a time."""
    try:
        opened(path)
    except (pa.ArrowException, OSError, ValueError):
        return False
    return True


def taken(content: bytearray, ended: bool) -> Iterator[tuple[dict[str, str], bytes]]:
    """Takes the records from the start of a member's contents that are there in full, or if it has ended also the rest: headers, by lower-case name, and block."""
    while True:
        while content[:2] == b"\r\n":
            del content[:2]
        split = content.find(b"\r\n\r\n")
        if split < 0 or not content.startswith(b"WARC/"):
            return
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in content[:split].decode("utf-8", "replace").split("\r\n")[1:])}
        stated = headers.get("content-length", "0")
        end = split + 4 + (int(stated) if stated.isdecimal() else 0)
        if len(content) < end and not ended:
            return
        yield headers, bytes(content[split + 4 : end])
        del content[:end]


def records(source, start: int, end: int, size: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset of the member, headers and block of the records of gzip members that start in a byte range and decode to WARC records.

    A record is given as soon as it is decoded, so that a member of any size takes no more memory than its largest record. What can't be decoded is left out.
    """
    buffer, base = b"", start  # bytes of the file from base on

    def more() -> bool:
        nonlocal buffer
        at = base + len(buffer)
        if at >= size:
            return False
        source.seek(at)
        buffer += (got := source.read(min(READ_BYTES, size - at)))
        return bool(got)

    at = start
    while at < end:
        found = buffer.find(MAGIC, at - base)
        if found < 0:
            at = max(at, base + len(buffer) - len(MAGIC) + 1)
            buffer, base = buffer[at - base :], at
            if not more():
                return
            continue
        at = base + found
        if at >= end:
            return
        buffer, base = buffer[found:], at
        unpack, content, fed, valid, data = zlib.decompressobj(31), bytearray(), 0, False, b""
        try:
            while not unpack.eof:
                if not data:
                    if valid:  # there is no way back
                        buffer, base, fed = buffer[fed:], base + fed, 0
                    if fed == len(buffer) and not more():
                        break
                    data, fed = buffer[fed:], len(buffer)
                content += unpack.decompress(data, EXPANDED)
                data = unpack.unconsumed_tail
                if not valid and len(content) >= 5:
                    if not content.startswith(b"WARC/"):
                        break
                    valid = True
                if valid:
                    for headers, block in taken(content, unpack.eof):
                        yield at, headers, block
        except zlib.error:
            valid = False
        if unpack.eof and (valid or not content):  # an empty member has no record
            at = base + fed - len(unpack.unused_data)
        else:
            at += 1
        if at < base:
            buffer, base = b"", at


def read(spark: SparkSession, path: str, *, payload: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of all archives below a path; see ``RECORD``. Without ``payload`` that column is null, but still checked.

    ``payload_bytes`` is the length of the full payload, which a revisit record states only; ``computed_digest`` is null there. Records without a type, id or digest have nulls;
    empty archives and files without a member have no records. On file systems that only Spark can open, an archive is the range of one task, of 2 GB at most.
    """
    # content isn't asked for, so no file is read here
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    some = files.first()
    if some is None or reachable(some["path"]):
        ranges = files.where("length > 0").select("path", "length", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(range_bytes).cast("bigint"))).alias("start"), F.lit(None).cast("binary").alias("content"))
        dealt = ranges.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    else:
        dealt = spark.read.format("binaryFile").load(path).select("path", "length", F.lit(0).cast("bigint").alias("start"), "content")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length, start, content in zip(*batch.columns, strict=True):
                path, length, start = path.as_py(), length.as_py(), start.as_py()
                rows, weight = [], 0
                if content.is_valid:
                    source, end = pa.BufferReader(content.as_buffer()), length
                else:
                    system, name = opened(path)
                    source, end = system.open_input_file(name), start + range_bytes
                with source:
                    for offset, headers, block in records(source, start, end, length):
                        http, _, body = block.partition(b"\r\n\r\n")
                        stated = re.search(rb"(?im)^content-length:\s*(\d+)", http)
                        own = headers.get("warc-type") != "revisit"
                        digest = headers.get("warc-payload-digest", "")
                        rows.append((path, offset, headers.get("warc-type"), headers.get("warc-record-id", "").strip("<>"), headers.get("warc-target-uri"), headers["warc-refers-to"].strip("<>") if "warc-refers-to" in headers else None, digest.rpartition(":")[2] or None, base32_sha1(body) if own else None, len(body) if own else int(stated[1]) if stated else None, body if own and payload else None))
                        weight += len(body)
                        if weight > 4_000_000 or len(rows) >= 2000:
                            yield packed(rows)
                            rows, weight = [], 0
                yield packed(rows)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64() if isinstance(f.dataType, T.LongType) else pa.binary() if isinstance(f.dataType, T.BinaryType) else pa.string() for f in RECORD]
        columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=RECORD.names)

    return dealt.mapInArrow(scan, RECORD)


def page_records(found: DataFrame) -> DataFrame:
    """What ``write`` has stored, from the records read: page_id, payload_bytes, payload_digest, record_type, refers_to, and whether the payload still has its digest."""
    number = lambda c: F.expr(f"try_cast(substring({c}, {len(_ID) + 1}) as bigint)")
    return found.select(number("record_id").alias("page_id"), "payload_bytes", F.coalesce("computed_digest", "payload_digest").alias("payload_digest"), "record_type", number("refers_to_id").alias("refers_to"), F.coalesce(F.col("computed_digest") == F.col("payload_digest"), F.lit(True)).alias("intact"))
