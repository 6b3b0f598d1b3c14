"""Operator 1: WARC archives with segmented records, written and read back.

Writing: every page is an HTTP response with chunked transfer framing. A block longer than
``segment`` bytes is split: the first part is the response record with segment number 1, the others
are continuation records that name their origin and number, the last one also the total length. Of
payloads that are equal (SHA-256) and long enough, the smallest page id is the response, others are
revisit records that refer to it. The files are written by Spark's text writer, whose line
separator is the record separator, so the archive can lie in any store.

Reading: files are parsed by their Content-Length fields; records in one piece are decoded at once,
segments are grouped by origin, ordered by number, checked to be complete and as long as announced,
joined and decoded. Only segments of segmented records are shuffled. A group is the segments
of one record, so its size is that of one page.

Defined results: null html is an empty payload; a null page id is always a response that refers
to nothing and to which nothing refers; rows that repeat the smallest page id are responses all;
a url's line breaks and other control characters are percent-encoded; an empty table
gives an archive without records and an empty result; other columns are not read. Records that are
broken (a missing segment, wrong total length, bad chunk framing, a digest that
differs) come back with ``ok`` false and the payload that could be read.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm.common import cut
from flowlens.session import shared_path

SEGMENT = 8 * 1024
CHUNK = 2 * 1024
RECORDS_PER_FILE = 4096
MIN_REVISIT = 100
#: most groups of equal payloads that are broadcast (about 100 bytes each)
BROADCAST_GROUPS = 50_000

_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_SEP = b"\r\n\r\n"


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    parts = []
    for lo in range(0, len(payload), size):
        piece = payload[lo : lo + size]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunk(body: bytes) -> tuple[bytes, bool]:
    """The payload of a chunked body (extensions and trailers allowed) and whether it was whole."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return b"".join(parts), False
        try:
            n = int(body[at:end].split(b";")[0].strip(), 16)
        except ValueError:
            return b"".join(parts), False
        at = end + 2
        if n == 0:
            return b"".join(parts), body[at:].endswith(b"\r\n")
        parts.append(body[at : at + n])
        if n < 0 or body[at + n : at + n + 2] != b"\r\n":
            return b"".join(parts), False
        at += n + 2


def http_payload(block: bytes) -> tuple[bytes, bool]:
    """The payload of an HTTP message, its transfer framing removed."""
    head, sep, body = block.partition(_SEP)
    fields = dict(x.partition(b":")[::2] for x in head.lower().split(b"\r\n")[1:])
    if fields.get(b"transfer-encoding", b"").strip() == b"chunked":
        return dechunk(body)
    return body, bool(sep)


def _header(fields: list[tuple[str, str]], length: int) -> bytes:
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in fields], f"Content-Length: {length}"]
    return "\r\n".join(lines).encode() + _SEP


def _clean(url) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{x:02X}" for x in c.encode()) for c in url or "")


def _records(run_id: str, segment: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        number = 0
        for b in batches:
            out, held = [], 0
            cols = [b.column(c) for c in ("page_id", "url", "digest", "refers_to")]
            payloads = b.column("payload")
            for i, (page, url, digest, refers) in enumerate(zip(*(c.to_pylist() for c in cols))):
                number += 1
                name = lambda k: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{run_id}/{task}/{number}/{k}')}>"  # noqa: B023, E731
                common = [("WARC-Date", "2020-01-01T00:00:00Z"), ("WARC-Target-URI", _clean(url) or "about:blank")]
                if page is not None:
                    common.append(("X-Page-ID", str(page)))
                first = [("WARC-Record-ID", name(1)), *common, ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response")]
                if refers is not None:
                    head = [("WARC-Type", "revisit"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                            ("WARC-Refers-To", f"<urn:page:{refers}>"), *first]
                    block = _HTTP + b"\r\n"
                    out.append(_header(head, len(block)) + block)
                    continue
                block = _HTTP + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payloads[i].as_py())
                pieces = [block[lo : lo + segment] for lo in range(0, len(block), segment)]
                for k, piece in enumerate(pieces, 1):
                    if k == 1:
                        head = [("WARC-Type", "response"), *first]
                        head += [("WARC-Segment-Number", "1")] if len(pieces) > 1 else []
                    else:
                        head = [("WARC-Type", "continuation"), ("WARC-Record-ID", name(k)), *common, ("WARC-Segment-Origin-ID", name(1)), ("WARC-Segment-Number", str(k))]
                        head += [("WARC-Segment-Total-Length", str(len(block)))] if k == len(pieces) else []
                    out.append(_header(head, len(piece)) + piece)
                    held += len(piece)
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    return make


def write_archive(pages: DataFrame, path: str, segment: int = SEGMENT, min_revisit: int = MIN_REVISIT) -> None:
    """Write page_id, url, html as WARC files (gzip) under ``path``."""
    p = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload"))
    p = p.withColumn("digest", F.sha2("payload", 256)).withColumn("n", F.octet_length("payload"))
    long = p.where((F.col("n") >= min_revisit) & F.col("page_id").isNotNull())
    same = cut(long.groupBy("digest").agg(F.min("page_id").alias("origin"), F.count(F.lit(1)).alias("c")).where("c > 1").select("digest", "origin"))
    if same.count() <= BROADCAST_GROUPS:
        same = F.broadcast(same)
    # short payloads would meet in one partition under few digests: give them keys of their own
    key = F.when(F.col("n") >= min_revisit, F.col("digest")).otherwise(F.concat(F.lit("-"), F.monotonically_increasing_id()))
    rows = p.withColumn("_k", key).join(same.withColumnRenamed("digest", "_k"), "_k", "left")
    rows = rows.withColumn("refers_to", F.when(F.col("origin") != F.col("page_id"), F.col("origin")))
    records = rows.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(_records(uuid.uuid4().hex, segment), "record binary")
    (records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\r\n\r\n")
     .option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def parse(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """(fields with lower-case names, block) of each record; stops at the first that is cut off."""
    at = 0
    while True:
        at = data.find(b"WARC/", at)
        end = data.find(_SEP, at)
        if at < 0 or end < 0:
            return
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        n = int(fields.get("content-length", "0"))
        block = data[end + 4 : end + 4 + n]
        yield fields, block
        at = end + 4 + n


_READ = "page_id bigint, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, ok boolean, origin string, number int, total bigint, declared string, block binary"


def _row(fields: dict, block: bytes) -> tuple:
    page = fields.get("x-page-id")
    page = int(page) if page else None
    declared = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    kind, number = fields.get("warc-type"), fields.get("warc-segment-number")
    if kind == "revisit":
        refers = int(fields["warc-refers-to"].strip("<>").rpartition(":")[2])
        return page, kind, refers, None, declared, True, None, None, None, declared, None
    if number is not None:
        origin = fields.get("warc-segment-origin-id") or fields.get("warc-record-id")
        total = fields.get("warc-segment-total-length")
        return page, kind, None, None, None, None, origin, int(number), int(total) if total else None, declared, block
    payload, ok = http_payload(block)
    digest = hashlib.sha256(payload).hexdigest()
    return page, kind, None, len(payload), digest, ok and digest == declared, None, None, None, declared, None


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in _READ.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(b.num_rows):
            data = b.column(0)[i].as_py()
            data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
            rows, held = [], 0
            for fields, block in parse(data):
                if fields.get("warc-type") not in ("response", "revisit", "continuation"):
                    continue
                rows.append(_row(fields, block))
                held += len(rows[-1][-1] or b"")
                if len(rows) >= 2000 or held > 4 << 20:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)


def _reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per origin with its sorted segments -> the decoded record."""
    names = ["page_id", "record_type", "payload_bytes", "payload_digest", "ok"]
    for b in batches:
        rows = []
        for i in range(b.num_rows):
            segs = b.column("segments")[i].as_py()
            block = b"".join(s["block"] for s in segs)
            whole = [s["number"] for s in segs] == list(range(1, len(segs) + 1)) and segs[-1]["total"] == len(block)
            payload, ok = http_payload(block)
            digest = hashlib.sha256(payload).hexdigest()
            declared = segs[0]["declared"]
            rows.append((segs[0]["page_id"], "response", len(payload), digest, whole and ok and digest == declared))
        if rows:
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, ok) per page record of the archive."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    records = cut(files.mapInArrow(_read, _READ))
    segments = records.where("origin is not null").groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("number", "total", "page_id", "declared", "block"))).alias("segments"))
    joined = segments.select("segments").mapInArrow(
        _reassemble, "page_id bigint, record_type string, payload_bytes bigint, payload_digest string, ok boolean")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "ok"]
    whole = records.where("origin is null and record_type = 'response'").select(*names)
    responses = cut(whole.unionByName(joined.select(*names)))
    # a revisit has the payload of the response that it refers to
    known = cut(responses.where("page_id is not null").groupBy("page_id").agg(
        F.max("payload_bytes").alias("payload_bytes"), F.max("payload_digest").alias("_d"))).withColumnRenamed("page_id", "refers_to")
    revisits = records.where("record_type = 'revisit'").select("page_id", "refers_to", "record_type", "payload_digest")
    resolved = revisits.join(known, "refers_to", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", F.col("payload_digest").eqNullSafe(F.col("_d")).alias("ok"))
    return responses.withColumn("refers_to", F.lit(None).cast("bigint")).unionByName(resolved).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "ok")


def archive_round_trip(pages: DataFrame, segment: int = SEGMENT) -> DataFrame:
    spark = pages.sparkSession
    path = shared_path(spark, "llm-warc", uuid.uuid4().hex)
    write_archive(pages, path, segment)
    return read_archive(spark, path)
