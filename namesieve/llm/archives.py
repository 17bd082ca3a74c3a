"""WARC archives: writing pages as records, and reassembling records from their segments.

Records leave through Spark's text writer (the record separator of the format is its line separator), so archives lie in
whatever store the path names. Reading takes each archive as one bounded binary row, parses records by their lengths,
sends only the segments of split records through a shuffle, orders them by number, checks numbers and total length, and
decodes the chunked transfer framing.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namesieve.plans.storage import shared_folder, written

END = "\r\n\r\n"
RECORDS_PER_FILE = 4096
#: A block longer than this is split into a first record and continuations; a chunk is at most as long as the second.
SEGMENT_BYTES, CHUNK_BYTES = 16384, 4096
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
PARSED = "kind string, page_id {id}, refers_to {id}, digest string, payload_bytes bigint, payload binary, origin string, number int, total bigint"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def slices(data: bytes, size: int) -> list[bytes]:
    """``data`` (UTF-8) in parts of at most ``size`` bytes, at least four, that do not cut a character."""
    out, at = [], 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        out.append(data[at:end])
        at = end
    return out


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    return b"".join(b"%x\r\n%b\r\n" % (len(part), part) for part in slices(payload, size)) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload in chunked framing; extensions and trailers are passed over, broken framing is an error."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        out.append(body[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    if any(x.split(b":")[0].strip().lower() == b"transfer-encoding" and b"chunked" in x.lower() for x in head.split(b"\r\n")[1:]):
        return unchunked(body)
    return body


def _record(fields: list[tuple[str, object]], block: str) -> str:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block.encode())}\r\n\r\n{block}"


def records_of(page_id, url: str | None, html: str | None, digest: str, first, segment: int, chunk: int) -> Iterator[str]:
    """The records of one page, without the separator: a revisit if ``first`` names another page, else a response in segments."""
    name = f"<urn:uuid:{uuid.uuid4()}>"
    uri = None if url is None else "".join(c if c > " " else f"%{ord(c):02X}" for c in url)
    common = [("WARC-Record-ID", name), ("WARC-Date", DATE), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Page-Id", page_id)]
    if first is not None and first != page_id:
        yield _record([("WARC-Type", "revisit"), *common, ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("Refers-To-Page-Id", first)], "")
        return
    parts = slices(HTTP + chunked((html or "").encode(), chunk), segment)
    total = sum(map(len, parts))
    for k, part in enumerate(parts, 1):
        kind = [("WARC-Type", "response" if k == 1 else "continuation"), *common]
        if k > 1:
            kind[1:3] = [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE), ("WARC-Segment-Origin-ID", name)]
        if len(parts) > 1:
            kind.append(("WARC-Segment-Number", k))
        if len(parts) > 1 and k == len(parts):
            kind.append(("WARC-Segment-Total-Length", total))
        yield _record([*kind, ("Content-Type", "application/http;msgtype=response")], part.decode())


def write_archives(pages: DataFrame, folder: str, revisit_from: int = 0, segment: int = SEGMENT_BYTES, chunk: int = CHUNK_BYTES) -> None:
    """One WARC record (or its segments) per row of ``pages`` (``page_id``, ``url``, ``html``) into gzip archives under ``folder``.

    Of rows with equal payloads of at least ``revisit_from`` bytes those with the smallest ``page_id`` are responses and the
    others revisit it; smaller payloads are all responses. Null html is an empty payload, a null url is left out, rows
    without ``page_id`` revisit the page that has one. Repeated rows become a record each. An empty table makes an empty folder.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("__sha", F.sha1("html"))
    large = F.octet_length("html") >= revisit_from
    firsts = rows.where(large).groupBy("__sha").agg(F.min("page_id").alias("__first"), F.count("*").alias("__n")).where("__n > 1").select("__sha", "__first")
    rows = rows.join(firsts, "__sha", "left").withColumn("__first", F.when(large, F.col("__first")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "html", "__sha", "__first"))):
                page_id, url, html, sha, first = (x.as_py() for x in row)
                for record in records_of(page_id, url, html, base64.b32encode(bytes.fromhex(sha)).decode(), first, segment, chunk):
                    out.append(record)
                    size += len(record)
                if size > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])

    rows.mapInArrow(run, "value string").write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder)


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Named fields (lower case) and block of each record of a plain or gzip archive."""
    data = gzip.decompress(archive) if archive[:2] == b"\x1f\x8b" else archive
    at = 0
    while at < len(data):
        head = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:head].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        end = head + 4 + int(fields["content-length"])
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where its length says")
        yield fields, data[head + 4 : end]
        at = end + 4


def _row(fields: dict[str, str], block: bytes, number_type, keep: bool) -> tuple:
    number = lambda x: None if x is None else number_type(x)
    page, refers, digest = number(fields.get("page-id")), number(fields.get("refers-to-page-id")), fields.get("warc-payload-digest", "").removeprefix("sha1:")
    kind, segment = fields["warc-type"], fields.get("warc-segment-number")
    if kind == "revisit":
        return ("revisit", page, refers, digest, None, None, None, None, None)
    if segment is not None:
        total = fields.get("warc-segment-total-length")
        return ("segment", page, None, digest, None, block, fields.get("warc-segment-origin-id", fields["warc-record-id"]), int(segment), total and int(total))
    payload = payload_of(block)
    return ("response", page, None, digest_of(payload), len(payload), payload if keep else None, None, None, None)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), schema.types)] if rows else [pa.array([], t) for t in schema.types], schema=schema)


def _assemble(parts: list[tuple], keep: bool) -> tuple:
    """One response from its segments, which must be numbered from 1 without a gap and add up to the stated total."""
    if [p[7] for p in parts] != list(range(1, len(parts) + 1)):
        raise ValueError(f"segments of {parts[0][6]}: {[p[7] for p in parts]}")
    block = b"".join(p[5] for p in parts)
    if parts[-1][8] != len(block):
        raise ValueError(f"segments of {parts[0][6]} hold {len(block)} bytes, not {parts[-1][8]}")
    payload = payload_of(block)
    return ("response", parts[0][1], None, digest_of(payload), len(payload), payload if keep else None, None, None, None)


def read_archives(spark: SparkSession, folder: str, payloads: bool = True, id_type: str = "bigint") -> DataFrame:
    """The records under ``folder``: ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``, ``payload``.

    Digests are computed anew from what was read; of a revisit, digest, size and payload are those of the response that it
    refers to (null if that is missing). Missing or repeated segments and wrong lengths are errors. ``payload`` is null
    unless ``payloads``. A folder without archives gives no row.
    """
    schema = PARSED.format(id=id_type)
    number = str if id_type == "string" else int
    arrow = pa.schema([("kind", pa.string()), ("page_id", pa.string() if id_type == "string" else pa.int64()), ("refers_to", pa.string() if id_type == "string" else pa.int64()), ("digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()), ("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64())])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column("content"):
                rows, size = [], 0
                for fields, block in parse(archive.as_py()):
                    rows.append(_row(fields, block, number, payloads))
                    size += len(rows[-1][5] or b"") + 200
                    if size > 1 << 22:
                        yield _batch(rows, arrow)
                        rows, size = [], 0
                yield _batch(rows, arrow)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        for batch in batches:
            rows = []
            for part in zip(*(c.to_pylist() for c in batch.columns)):
                if parts and parts[-1][6] != part[6]:
                    rows.append(_assemble(parts, payloads))
                    parts = []
                parts.append(part)
            yield _batch(rows, arrow)
        if parts:
            yield _batch([_assemble(parts, payloads)], arrow)

    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content").mapInArrow(records, schema)
    found = written(found, "records")
    segments = found.where("kind = 'segment'").repartition("origin").sortWithinPartitions("origin", "number").mapInArrow(joined, schema)
    responses = found.where("kind = 'response'").unionByName(segments)
    if not payloads:
        responses = responses.withColumn("payload", F.lit(None).cast("binary"))
    # A page that was written twice is one target.
    targets = responses.groupBy(F.col("page_id").alias("refers_to"), "digest").agg(F.first("payload_bytes").alias("payload_bytes"), F.first("payload").alias("payload"))
    again = found.where("kind = 'revisit'").select("page_id", "refers_to", "digest")
    wanted = again.select("refers_to", "digest").distinct()
    revisits = again.join(targets.join(wanted, ["refers_to", "digest"], "left_semi"), ["refers_to", "digest"], "left").withColumn("kind", F.lit("revisit"))
    columns = ["page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), "refers_to", "payload"]
    return responses.select(*columns).unionByName(revisits.select(*columns))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through archives and back."""
    folder = f"{shared_folder(spark)}/namesieve/warc-{uuid.uuid4().hex}"
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    write_archives(pages, folder)
    return read_archives(spark, folder, payloads=False, id_type="bigint").drop("payload")
