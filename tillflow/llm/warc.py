"""WARC archives: written with segments and revisits, read back by segment reassembly.

Writing: each page is a response record whose block is an HTTP message with
chunked transfer framing, or a revisit record when an equal, long enough
payload is archived under a larger page id. A block longer than a segment is
continued in continuation records. Archives are gzip files in shared storage.

Reading: records are parsed by their headers. Continuation records are grouped
with their first segment by origin identifier, ordered by segment number, and
the total length is verified. Then the chunked framing is decoded.

Defined cases: a NULL payload is empty. A NULL page id is always a response.
Rows that share the largest id of a payload are all responses; repeated rows
are archived as often as they occur. A missing, repeated-but-different or
wrongly sized segment gives intact = false and no payload. An empty table
gives empty archives. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm.common import prepare, shared_folder, table, written

REVISIT_FROM = 1000
SEGMENT_BYTES = 16 * 1024
CHUNK_BYTES = 4096
RECORDS_PER_FILE = 20_000

# The formats' names.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

PARSED = ("kind string, page_id string, refers_to string, record_id string, origin string, segment int, "
          "total long, payload_bytes long, payload_digest string, block binary")


def header(fields: list[tuple[str, str]], length: int) -> bytes:
    lines = [VERSION.decode(), *[f"{k}: {v}" for k, v in fields], f"Content-Length: {length}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(payload[i:i + size]), payload[i:i + size]) for i in range(0, len(payload), size)]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """Payload of a chunked body: chunk extensions are skipped, trailers ignored."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if len(body) < at + size + 2 or body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunk cut short")
        out.append(body[at:at + size])
        at += size + 2


def record_id(page, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{digest}')}>"


def page_records(page, url, payload: bytes, digest: str, refers, segment: int = SEGMENT_BYTES):
    """The records of one page, each without its last line end."""
    name, b32 = record_id(page, digest), base64.b32encode(bytes.fromhex(digest)).decode()
    base = [("WARC-Record-ID", name), ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{b32}"),
            *([("X-Page-Id", str(page))] if page is not None else []),
            *([("WARC-Target-URI", " ".join(url.split()))] if url else []),
            ("Content-Type", "application/http; msgtype=response")]
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers is not None:
        block = f"{http}Content-Length: {len(payload)}\r\n\r\n".encode()
        fields = [("WARC-Type", "revisit"), *base, ("WARC-Profile", PROFILE),
                  ("WARC-Refers-To", record_id(refers, digest)), ("X-Refers-To-Page", str(refers))]
        yield header(fields, len(block)) + block + b"\r\n"
        return
    block = f"{http}Transfer-Encoding: chunked\r\n\r\n".encode() + chunked(payload)
    first = block[:segment]
    more = [("WARC-Segment-Number", "1")] if len(block) > segment else []
    yield header([("WARC-Type", "response"), *base, *more], len(first)) + first + b"\r\n"
    for k, at in enumerate(range(segment, len(block), segment), 2):
        part = block[at:at + segment]
        last = [("WARC-Segment-Total-Length", str(len(block)))] if at + segment >= len(block) else []
        fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}:{k}')}>"),
                  ("WARC-Date", DATE), ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", str(k)), *last]
        yield header(fields, len(part)) + part + b"\r\n"


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", body: str = "html",
                   revisit_from: int = REVISIT_FROM) -> None:
    """One or more WARC records per row, as gzip archives below path."""
    payload = F.coalesce(F.col(body).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("string").alias("page"), F.col(key).alias("k"), F.col(url).cast("string").alias("url"),
                        payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("bytes", F.octet_length("payload"))
    same = written(rows.where(F.col("bytes") >= revisit_from).groupBy(F.col("digest").alias("d"), F.col("bytes").alias("b")).agg(
        F.max("k").alias("response"), F.count("*").alias("n")).where("n > 1").drop("n"), "same")
    # a written table on the right and always a merge join: payloads that many pages share can be split
    joined = rows.join(same.hint("merge"), (F.col("digest") == F.col("d")) & (F.col("bytes") == F.col("b")), "left")
    refers = F.when(F.col("response") != F.col("k"), F.col("response").cast("string"))

    def run(batches):
        info = b"software: tillflow\r\nformat: WARC File Format 1.1\r\n"
        fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE),
                  ("Content-Type", "application/warc-fields")]
        yield pa.RecordBatch.from_arrays([pa.array([header(fields, len(info)) + info + b"\r\n"], pa.binary())], names=["r"])
        for b in batches:
            out = [r for page, u, p, d, to in zip(*[c.to_pylist() for c in b.columns])
                   for r in page_records(page, u, p, d, to)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["r"])

    records = joined.select("page", "url", "payload", "digest", refers.alias("refers")).mapInArrow(run, "r binary")
    # the text sink writes the bytes of each record as they are; the line separator ends the record
    records.select(F.col("r").cast("string")).write.mode("overwrite").option("lineSep", "\r\n").option(
        "compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def parse_records(chunks):
    """(headers, block) of every record of one archive, from its inflated parts."""
    buffer = b""
    for part in chunks:
        buffer += part
        at = 0
        while True:
            end = buffer.find(b"\r\n\r\n", at)
            if end < 0:
                break
            lines = buffer[at:end].split(b"\r\n")
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.decode("utf-8", "replace").partition(":") for x in lines[1:])}
            if lines[0] != VERSION:
                raise ValueError(f"not a record: {lines[0][:40]!r}")
            size = int(fields["content-length"])
            if len(buffer) < end + 8 + size:
                break
            yield fields, buffer[end + 4:end + 4 + size]
            at = end + 8 + size
        buffer = buffer[at:]
    if buffer.strip():
        raise ValueError("archive cut short")


def inflate(data: bytes, step: int = 1 << 20):
    """Inflated parts of a gzip file of one or more members."""
    view = memoryview(data)
    machine = zlib.decompressobj(31)
    for at in range(0, len(view), step):
        part = bytes(view[at:at + step])
        while part:
            yield machine.decompress(part)
            part = machine.unused_data
            if machine.eof:
                machine = zlib.decompressobj(31)


def decode_http(block: bytes) -> tuple[bytes, dict]:
    head, _, body = block.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.decode("latin-1").partition(":") for x in head.split(b"\r\n")[1:])}
    if fields.get("transfer-encoding", "").lower() == "chunked":
        body = dechunked(body)
    return body, fields


def hex_digest(field: str | None) -> str | None:
    if not field or ":" not in field:
        return None
    try:
        return base64.b32decode(field.split(":", 1)[1]).hex()
    except ValueError:
        return None


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Parsed records below path. Whole responses are decoded; segments keep their block."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")

    def run(batches):
        for b in batches:
            for content in b.column(0):
                rows = []
                for fields, block in parse_records(inflate(content.as_buffer())):
                    kind = fields["warc-type"]
                    if kind not in ("response", "revisit", "continuation"):
                        continue
                    segment = int(fields.get("warc-segment-number", 0))
                    row = {"kind": kind, "page_id": fields.get("x-page-id"), "refers_to": fields.get("x-refers-to-page"),
                           "record_id": fields["warc-record-id"], "segment": segment,
                           "origin": fields.get("warc-segment-origin-id") or (fields["warc-record-id"] if segment else None),
                           "total": int(fields["warc-segment-total-length"]) if "warc-segment-total-length" in fields else None}
                    if kind == "revisit":
                        _, http = decode_http(block)
                        row |= {"payload_bytes": int(http["content-length"]), "payload_digest": hex_digest(fields.get("warc-payload-digest"))}
                    elif segment:
                        row["block"] = block
                    else:
                        row |= decoded(block)
                    rows.append(row)
                    if len(rows) >= 500:
                        yield pa.RecordBatch.from_pylist(rows, schema=target)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=target)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    target = to_arrow_schema(StructType.fromDDL(PARSED))
    return files.mapInArrow(run, PARSED)


def decoded(block: bytes) -> dict:
    try:
        payload, _ = decode_http(block)
    except ValueError:
        return {"payload_bytes": None, "payload_digest": None}
    return {"payload_bytes": len(payload), "payload_digest": hashlib.sha1(payload).hexdigest()}


def reassemble(parts: list[dict]) -> bytes | None:
    """Block of one origin's segments, or None if they are not whole."""
    by_number: dict[int, bytes] = {}
    for p in parts:
        if by_number.setdefault(p["segment"], p["block"]) != p["block"]:
            return None
    totals = {p["total"] for p in parts if p["total"] is not None}
    if len(totals) != 1 or sorted(by_number) != list(range(1, len(by_number) + 1)):
        return None
    block = b"".join(by_number[k] for k in sorted(by_number))
    return block if len(block) == totals.pop() else None


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, intact) of every archived page, ids as text."""
    parsed = written(read_records(spark, path), "records")
    whole = parsed.where("origin IS NULL").select("page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to")
    # one group is one page's block; a repeated row repeats its segments, hence the count of first segments
    grouped = parsed.where("origin IS NOT NULL").groupBy("origin").agg(
        F.max("page_id").alias("page_id"), F.sum(F.when(F.col("segment") == 1, 1).otherwise(0)).alias("copies"),
        F.collect_set(F.struct("segment", "total", "block")).alias("parts"))

    def run(batches):
        for b in batches:
            found = [decoded(x) if (x := reassemble(p)) is not None else {"payload_bytes": None, "payload_digest": None}
                     for p in b.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("copies"),
                                              pa.array([x["payload_bytes"] for x in found], pa.int64()),
                                              pa.array([x["payload_digest"] for x in found], pa.string())],
                                             names=["page_id", "copies", "payload_bytes", "payload_digest"])

    joined = grouped.mapInArrow(run, "page_id string, copies long, payload_bytes long, payload_digest string")
    joined = joined.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.greatest("copies", F.lit(1)))))
    joined = joined.select("page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"),
                           F.lit(None).cast("string").alias("refers_to"))
    return whole.unionByName(joined).withColumn("intact", F.col("payload_digest").isNotNull())


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract result: all pages written as WARC archives and read back."""
    pages = table(prepare(spark), sf_dir, "pages")
    kind = dict(pages.dtypes)["page_id"]
    path = shared_folder(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path).select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"), "intact")
