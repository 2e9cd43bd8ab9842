"""WARC archives compressed record by record with a Zstandard dictionary of their own."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rimsight.llm.files import open_file, whole_file
from rimsight.llm.shared import ship_package

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
FRAME = struct.Struct("<II")
NEVER = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 4 << 20  # of the first records of an archive, from which its dictionary is built
LEVEL = 3


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_uri(page_id: int | None, digest: str) -> str:
    return f"urn:page:{page_id}" if page_id is not None else f"urn:page-digest:{digest}"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A WARC/1.1 record: the whole response, or a revisit with the response's headers alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{record_uri(page_id, digest)}>",
        f"WARC-Date: {NEVER}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
    ]
    if url:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " else "%%%02X" % ord(c) for c in url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{record_uri(refers_to, digest)}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train_dictionary(records: list[bytes]) -> bytes:
    """A dictionary of the records; their start itself where there are too few to train on."""
    if not records:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records, k=1024, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[:DICTIONARY_BYTES]


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def write_archive(out, records: Iterator[bytes]) -> tuple[int, int]:
    """A skippable frame with the dictionary, then one frame for each record; returns counts of records and bytes."""
    first, size = [], 0
    for made in records:
        first.append(made)
        size += len(made)
        if size >= SAMPLE_BYTES:
            break
    raw = train_dictionary(first)
    shared = _dictionary(raw)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_content_size=True) if shared else zstandard.ZstdCompressor(level=LEVEL)
    # the dictionary's own frame is itself compressed
    packed = zstandard.ZstdCompressor(level=19).compress(raw)
    out.write(FRAME.pack(SKIPPABLE, len(packed)) + packed)
    n, written = 0, FRAME.size + len(packed)

    def put(made: bytes) -> None:
        nonlocal n, written
        frame = packer.compress(made)
        out.write(frame)
        n, written = n + 1, written + len(frame)

    for made in first:
        put(made)
    for made in records:
        put(made)
    return n, written


def read_archive(uri: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record, in order, one at a time."""
    file = open_file(uri)
    magic, size = FRAME.unpack(file.read(FRAME.size))
    if magic != SKIPPABLE:
        raise ValueError(f"{uri} does not start with a dictionary frame")
    shared = _dictionary(zstandard.ZstdDecompressor().decompress(file.read(size)))
    opener = zstandard.ZstdDecompressor(dict_data=shared) if shared else zstandard.ZstdDecompressor()
    rest = file.read(1 << 20)
    while rest:
        frame, made = opener.decompressobj(), []
        while not frame.eof:
            if not rest:
                raise ValueError(f"{uri} ends within a record")
            made.append(frame.decompress(rest))
            rest = frame.unused_data if frame.eof else file.read(1 << 20)
        rest = rest or file.read(1 << 20)
        head, _, body = b"".join(made).partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        headers = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines)}
        size = int(headers.get("content-length", -1))
        if version != "WARC/1.1" or body[size:] != b"\r\n\r\n":
            raise ValueError(f"{uri} holds a frame that is no record")
        yield headers, body[:size]


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest_hex and refers_to (null for responses).

    Of equal payloads the record with the smallest page_id is the response. Rows that repeat
    this id are responses too; rows without an id are responses of their own. Only digests
    and ids are grouped; the join that brings the first id back is one that Spark can split
    for a payload many pages share.
    """
    rows = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha1("html"))
    firsts = rows.filter(F.col("page_id").isNotNull()).groupBy("digest").agg(F.min("page_id").alias("first_id"))
    joined = rows.join(firsts, "digest", "left")
    return joined.select("page_id", "url", "html", F.when(F.col("page_id") > F.col("first_id"), F.col("first_id")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write every page as a record; returns the archives: uri, n_records, n_bytes.

    One archive for each task that has rows, each with the dictionary of its own first
    records. A null html is an empty payload; a null url leaves the target out.
    """
    spark = pages.sparkSession
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                page, url, html, refers = (batch.column(k) for k in range(4))
                for k in range(len(batch)):
                    payload = html[k].as_py().encode()
                    yield record(page[k].as_py(), url[k].as_py(), payload, sha1_base32(payload), refers[k].as_py())

        made = records()
        first = next(made, None)
        if first is None:
            return

        def every() -> Iterator[bytes]:
            yield first
            yield from made

        uri = f"{folder}/pages-{TaskContext.get().partitionId():06d}.warc.zst"
        with whole_file(uri) as out:
            n, size = write_archive(out, every())
        yield pa.RecordBatch.from_pydict({"uri": [uri], "n_records": [n], "n_bytes": [size]})

    listed = with_revisits(pages).mapInArrow(run, "uri string, n_records long, n_bytes long").collect()  # a row for each file
    return spark.createDataFrame(listed, "uri string, n_records long, n_bytes long")


def read_archives(archives: DataFrame) -> DataFrame:
    """Every record: page_id, payload_bytes, payload_digest, record_type, refers_to.

    The digest of a response is computed from its payload and must be the one in its header;
    a revisit's length is that in the response headers it repeats.
    """
    kinds = pa.schema(
        [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    )

    def page_of(uri: str | None) -> int | None:
        return int(uri[len("<urn:page:") : -1]) if uri and uri.startswith("<urn:page:") else None

    def rows(uri: str) -> Iterator[tuple]:
        for headers, block in read_archive(uri):
            http, _, payload = block.partition(b"\r\n\r\n")
            said = headers["warc-payload-digest"].removeprefix("sha1:")
            size = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")).split(b":")[1])
            kind = headers["warc-type"]
            if kind == "response" and (len(payload) != size or sha1_base32(payload) != said):
                raise ValueError(f"{uri}: a payload is not what its headers say")
            yield page_of(headers["warc-record-id"]), size, said, kind, page_of(headers.get("warc-refers-to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                kept: list[tuple] = []
                for row in rows(uri):
                    kept.append(row)
                    if len(kept) == 8192:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept), kinds)], schema=kinds)
                        kept = []
                if kept:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept), kinds)], schema=kinds)

    n = max(1, archives.count())
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return archives.select("uri").repartition(n).mapInArrow(run, schema)
