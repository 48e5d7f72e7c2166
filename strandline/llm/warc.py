"""WARC: writing captures as request, response or revisit, and metadata records; reading archives and assembling one nested row a capture."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.shared import lookup, shared_folder, table, written

END = "\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"
#: A file is full at so many bytes, so that it fits a reading task; a record that is larger by itself ends its file.
FILE_BYTES = 32 << 20
#: A gzip member holds a record, or so many bytes of one at most: under 2^24, so that its last byte, the highest of its length, is zero.
MEMBER = (16 << 20) - 1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def response_id(page_id: int | None, digest: str) -> str:
    """The record id of a page's response; revisits name it."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}/{digest}')}>"


def record(headers: list[tuple[str, str | None]], block: str) -> str:
    """One WARC record without the two line ends behind it. Header values lose line ends; a header without a value is left out."""
    lines = ["WARC/1.1", *(f"{k}: {' '.join(str(v).split())}" for k, v in headers if v is not None), f"Content-Length: {len(block.encode())}"]
    return "\r\n".join(lines) + END + block


def capture_records(page_id: int | None, url: str | None, html: str, digest: str, first: int | None, revisit: bool, position: str, named: bool = True) -> list[str]:
    """The records of one capture. ``first`` is the page whose response a revisit refers to; ``position`` tells rows apart that repeat page and payload, of whose responses one is ``named`` by page and digest alone."""
    own = lambda part: f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}/{digest}/{position}/{part}')}>"
    payload = len(html.encode())
    about = [("WARC-Target-URI", url), ("WARC-Date", DATE)]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload}{END}"
    sha1 = f"sha1:{digest}"
    name = own("main") if revisit or not named else response_id(page_id, digest)
    main = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", name), *about, ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", sha1)]
    main += [("WARC-Profile", PROFILE), ("WARC-Refers-To", response_id(first, digest))] if revisit else []
    link = ("WARC-Concurrent-To", name)
    request = [("WARC-Type", "request"), ("WARC-Record-ID", own("request")), *about, ("Content-Type", "application/http; msgtype=request"), link]
    metadata = [("WARC-Type", "metadata"), ("WARC-Record-ID", own("metadata")), *about, ("Content-Type", "application/warc-fields"), link]
    known = f"page_id: {page_id}\r\n" if page_id is not None else "page: unnamed\r\n"
    return [record(request, f"GET / HTTP/1.1{END}"), record(main, http + ("" if revisit else html)), record(metadata, known)]


def members(text: str) -> Iterator[bytes]:
    """The gzip members of one record, its two line ends included: one, or for a record over MEMBER bytes as many as it takes, which read on from one another."""
    data = (text + END).encode()
    for at in range(0, len(data), MEMBER):
        c = zlib.compressobj(6, zlib.DEFLATED, 31)
        yield c.compress(data[at : at + MEMBER]) + c.flush()


def write_archives(pages: DataFrame, path: str, least: int = 0) -> None:
    """Writes compressed archives of all ``pages`` (page_id, url, html) under ``path``, each record a gzip member of its own, so that a reader can start at any record.

    Among pages with equal payloads of at least ``least`` bytes, the one with the largest page_id (nulls lowest) is the response and the others revisit it.
    A null html is an empty payload; a null url leaves its header out; a row that repeats page_id and payload is another response.
    A response's record id follows from page and digest (of alike rows, for one of them), so what a revisit refers to is the id of a record.
    Files hold about FILE_BYTES (before compression) each, in folders by their number in the writing task. Spark's text writer writes a member's bytes as they are; its line separator is the zero that ends every member.
    Equal payloads meet through their digest and size alone: the page text isn't shuffled unless over SMALL digests repeat, and then hot digests are broadcast.
    """
    full = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    full = full.withColumn("sha", F.sha1(F.col("html").cast("binary"))).withColumn("bytes", F.octet_length("html"))
    full = written(full.withColumn("row", F.monotonically_increasing_id()), "payloads")  # so that a row has one number, whatever is asked of it
    groups = full.where(F.col("bytes") >= least).groupBy("sha", "bytes").agg(F.max(F.struct("page_id", (-F.col("row")).alias("row"))).alias("top"), F.count("*").alias("n"))
    repeated = groups.where("n > 1").select("sha", F.col("top.page_id").alias("first"), (-F.col("top.row")).alias("named"), "n").dropDuplicates(["sha"])
    total = full.count()
    rows = lookup(full, repeated.withColumn("again", F.lit(True)), ["sha"], "n", total)

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, n, written_bytes = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            for at in range(0, b.num_rows, 256):
                out: list[bytes] = []
                files: list[int] = []
                for page_id, url, html, sha, first, again, size, row, named in zip(*(c.to_pylist() for c in b.slice(at, 256).columns), strict=True):
                    digest = base64.b32encode(bytes.fromhex(sha)).decode()
                    revisit = bool(again) and size >= least and page_id != first
                    made = capture_records(page_id, url, html, digest, first, revisit, f"{task}.{n}", size >= least and (not again or row == named))
                    packed = [m[:-1] for r in made for m in members(r)]
                    out += packed
                    files += [written_bytes // FILE_BYTES] * len(packed)
                    written_bytes += sum(map(len, made)) if revisit else size + 1024
                    n += 1
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(files, pa.int32())], names=["value", "file"])

    texts = rows.select("page_id", "url", "html", "sha", "first", "again", "bytes", "row", "named").mapInArrow(compose, "value binary, file int")
    texts.select(F.col("value").cast("string").alias("value"), "file").write.partitionBy("file").option("lineSep", "\0").option("compression", "none").text(path)


RECORD = "type string, record_id string, concurrent_to string, refers_to string, target_uri string, stated_digest string, payload_bytes long, payload_digest string, fields string"


def parse_records(data: bytes) -> Iterator[tuple]:
    """Rows as RECORD says of an uncompressed archive, each record found by its Content-Length alone. A response's payload is measured and digested."""
    at = 0
    while at < len(data):
        head_end = data.index(b"\r\n\r\n", at)
        headers = dict(line.split(": ", 1) for line in data[at:head_end].decode().split("\r\n")[1:])
        start = head_end + 4
        block = data[start : start + int(headers["Content-Length"])]
        at = start + len(block) + 4
        kind, size, digest, fields = headers["WARC-Type"], None, None, None
        if kind in ("response", "revisit"):
            http, _, payload = block.partition(b"\r\n\r\n")
            stated = next((int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
            size = len(payload) if kind == "response" else stated
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode() if kind == "response" else None
        elif kind == "metadata":
            fields = block.decode()
        get = headers.get
        yield kind, get("WARC-Record-ID"), get("WARC-Concurrent-To"), get("WARC-Refers-To"), get("WARC-Target-URI"), get("WARC-Payload-Digest"), size, digest, fields


def unpacked(data: bytes) -> bytes:
    """What the gzip members of a file hold, one after another, in time that grows with the file: each is fed piece by piece, so what lies behind it isn't copied."""
    view, at, out = memoryview(data), 0, []
    while at < len(view):
        d = zlib.decompressobj(31)
        while not d.eof:
            if at >= len(view):
                raise EOFError("a member is cut off")
            piece = view[at : at + 16_384]
            out.append(d.decompress(piece))
            at += len(piece)
        at -= len(d.unused_data)
    return b"".join(out)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row a record of the archives under ``path``, compressed or not."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string()] * 6 + [pa.int64()] + [pa.string()] * 2
        names = [x.split()[0] for x in RECORD.split(", ")]
        for b in batches:
            for k in range(b.num_rows):
                data = b.column(0)[k].as_py()
                if data[:2] == b"\x1f\x8b":
                    data = unpacked(data)
                if rows := list(parse_records(data)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("content").mapInArrow(read, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row a capture: response (or revisit), request and metadata, joined by the concurrent-to identifiers; a part without a match is null.

    ``intact``: whether a response's payload has the digest that its header states (null for a revisit, which has no payload).
    """
    every = F.struct(*records.columns)
    intact = F.concat(F.lit("sha1:"), "payload_digest") == F.col("stated_digest")
    main = records.where("type in ('response', 'revisit')").select(F.col("record_id").alias("capture"), every.alias("response"), intact.alias("intact"))
    request = records.where("type = 'request'").select(F.col("concurrent_to").alias("capture"), every.alias("request"))
    metadata = records.where("type = 'metadata'").select(F.col("concurrent_to").alias("capture"), every.alias("metadata"))
    return main.join(request, "capture", "left").join(metadata, "capture", "left")


def with_referred(captures: DataFrame) -> DataFrame:
    """Adds page_id (from the metadata), refers_to: the page_id of the response that a revisit names, else null, and payload_digest: that of the payload as read, a revisit's from the response it names."""
    page = F.regexp_extract(F.col("metadata.fields"), r"page_id: (-?\d+)", 1).try_cast("long")
    paged = written(captures.withColumn("page_id", page).withColumn("named", F.col("response.refers_to")), "captures")
    asked = paged.where("named is not null").groupBy("named").agg(F.count("*").alias("n"))
    offered = paged.where("response.type = 'response'").select(F.col("response.record_id").alias("named"), F.col("page_id").alias("refers_to"), F.col("response.payload_digest").alias("named_digest"))
    offered = offered.groupBy("named").agg(F.first("refers_to").alias("refers_to"), F.max("named_digest").alias("named_digest"))  # repeated rows name one capture
    found = asked.join(offered, "named")
    met = lookup(paged, found, ["named"], "n", paged.count())
    return met.withColumn("payload_digest", F.coalesce("response.payload_digest", "named_digest")).drop("named_digest")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(table(spark, sf_dir, "pages"), path)
    captures = with_referred(assemble(written(read_records(spark, path), "records")))
    return captures.select("page_id", F.col("response.payload_bytes").alias("payload_bytes"), "payload_digest", F.col("response.type").alias("record_type"), "refers_to")


OP7_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS hex FROM pages),
g AS (SELECT hex, max(page_id) AS first FROM p GROUP BY 1),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, first, array_to_string(list_transform(range(0, 32), lambda k:
  substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 5 * (k // 4)::INT + 1, 5))::BIGINT >> (15 - 5 * (k % 4))) & 31)::INT, 1)), '') AS payload_digest FROM p JOIN g USING (hex))
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM d
"""
