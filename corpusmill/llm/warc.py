"""WARC archives compressed per record with a shared Zstandard dictionary."""

from __future__ import annotations

import base64
import hashlib
import posixpath
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType

from corpusmill.llm.common import broadcast_measured, materialize, utf8
from corpusmill.session import scratch_path

SKIPPABLE = 0x184D2A5D           # magic of the leading frame that carries the dictionary
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
DICTIONARY_BYTES = 32 * 1024
SAMPLE_RECORDS, SAMPLE_BYTES = 512, 16 * 1024   # bound of what the dictionary is built from
ARCHIVE_BYTES = 64 * 1024 * 1024                # a file is closed when it is larger than this
FEWEST_SAMPLES = 32
EPOCH = "1970-01-01T00:00:00Z"                  # archives of the same pages are the same bytes


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One uncompressed WARC/1.1 record; a revisit holds the HTTP head only.

    The head's Content-Length is the length of the payload, also in a revisit.
    """
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http + (payload if refers_to is None else b"")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {EPOCH}",
             f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    if url is not None:
        lines.insert(3, "WARC-Target-URI: " + " ".join(url.split()))
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC headers, HTTP headers, body) of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = _headers(head)
    block = rest[:int(headers["content-length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    return headers, _headers(http), body


def _headers(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode().split("\r\n")[1:])
    return {name.lower(): value.strip() for name, _, value in pairs}


def build_dictionary(records: list[bytes]) -> bytes:
    """A Zstandard dictionary of at most ``DICTIONARY_BYTES``; too few or too uniform records give raw content."""
    if not records:
        return b"WARC/1.1\r\n"
    if len(records) >= FEWEST_SAMPLES:
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, records).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(records)[-DICTIONARY_BYTES:]


def dictionary_of(pages: DataFrame) -> bytes:
    """Dictionary from the archived records of at most ``SAMPLE_RECORDS`` distinct payloads, lowest hash first.

    The choice is made on digests; only the chosen payloads reach the driver,
    ``SAMPLE_BYTES`` of each at most.
    """
    chosen = [r["hex"] for r in pages.groupBy("hex").agg(F.xxhash64("hex").alias("order")).orderBy("order", "hex").limit(SAMPLE_RECORDS).collect()]
    sample = pages.where(F.col("hex").isin(chosen)).groupBy("hex").agg(
        F.min(F.struct("page_id", "url", F.substring("payload", 1, SAMPLE_BYTES).alias("payload"))).alias("p")).orderBy("hex").select("p.*").collect()
    return build_dictionary([record_bytes(r.page_id, r.url, bytes(r.payload), sha1_base32(bytes(r.payload)), None)[:SAMPLE_BYTES] for r in sample])


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def write_archives(pages: DataFrame, folder: str, dictionary: bytes, level: int = 3) -> DataFrame:
    """Write (page_id, url, payload, refers_to) rows as ``.warc.zst`` files; returns (archive, records, bytes).

    Every file starts with the dictionary in a skippable frame, then one
    Zstandard frame per record. A task writes under a name of its own and the
    caller reads only files that a finished task has returned, so a repeated
    or lost attempt leaves at most an unread file behind.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _place(folder)
        fs.create_dir(root, recursive=True)
        compressor = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=True)
        out, done = None, []

        def close():
            nonlocal out
            if out is not None:
                done.append((name, count, out.tell()))
                out.close()
                out = None

        for batch in batches:
            columns = batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), batch.column(3).to_pylist()
            for page_id, url, payload, refers_to in zip(*columns):
                if out is None:
                    name, count = posixpath.join(root, f"{uuid.uuid4().hex}.warc.zst"), 0
                    out = fs.open_output_stream(name, compression=None)
                    out.write(struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary)
                out.write(compressor.compress(record_bytes(page_id, url, payload, sha1_base32(payload), refers_to)))
                count += 1
                if out.tell() > ARCHIVE_BYTES:
                    close()
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
                                             ["archive", "records", "bytes"])

    return pages.select("page_id", "url", "payload", "refers_to").mapInArrow(run, "archive string, records bigint, bytes bigint")


def iter_records(stream) -> Iterator[bytes]:
    """Uncompressed records of one archive, a frame at a time; the dictionary comes from the file itself."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != SKIPPABLE:
        raise ValueError("no dictionary frame")
    dictionary = zstandard.ZstdCompressionDict(stream.read(size))
    context = zstandard.ZstdDecompressor(dict_data=dictionary)
    rest = b""
    while True:
        if not rest:
            rest = stream.read(1 << 20)
            if not rest:
                return
        frame, parts = context.decompressobj(), []
        while not frame.eof:
            if not rest:
                rest = stream.read(1 << 20)
                if not rest:
                    raise ValueError("truncated record")
            parts.append(frame.decompress(rest))
            rest = frame.unused_data if frame.eof else b""
        yield b"".join(parts)


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) from the files named in ``archives``.

    Response payloads are hashed again; a mismatch with the header raises.
    """
    schema = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"
    names = [f.split()[0] for f in schema.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def number(urn: str | None):
        return int(urn[10:-1]) if urn and urn != "<urn:page:>" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = _place(folder)
        for name in (n for b in batches for n in b.column(0).to_pylist()):
            rows, held = [], 0
            with fs.open_input_stream(name, compression=None) as stream:
                for data in iter_records(stream):
                    head, http, body = parse_record(data)
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    if head["warc-type"] == "response" and sha1_base32(body) != digest:
                        raise ValueError(f"payload of {head['warc-record-id']} does not match its digest")
                    rows.append((number(head["warc-record-id"]), head.get("warc-target-uri"), int(http["content-length"]), digest,
                                 head["warc-type"], number(head.get("warc-refers-to")), body if head["warc-type"] == "response" else None))
                    held += len(data)
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    return archives.select("archive").mapInArrow(run, schema)


def archive_pages(pages: DataFrame, folder: str | None = None, smallest_revisit: int = 0) -> tuple[DataFrame, str]:
    """Archive ``pages`` (page_id, url, html) and return the files table and their folder.

    Of pages with equal payloads of at least ``smallest_revisit`` bytes the
    one with the largest id is stored, the others become revisit records that
    refer to it; rows that repeat that id too are stored as well. A null html
    is empty, a null url gives no target header, a null id counts as smaller
    than any. Extra columns are ignored; no pages give no file. Only digests
    and ids are shuffled to find copies; a payload that fills a third of all
    rows is counted on the map side.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast(LongType()).alias("page_id"), "url", payload.alias("payload"), F.sha1(payload).alias("hex"))
    large = F.when(F.octet_length("payload") >= smallest_revisit, F.col("hex"))
    copies = materialize(rows.select(large.alias("same"), "page_id").where("same IS NOT NULL").groupBy("same").agg(
        F.max("page_id").alias("kept"), F.min(F.coalesce("page_id", F.lit(-(1 << 63)))).alias("least")).where(
        "kept IS NOT NULL AND least < kept").select("same", "kept"), "copied-payloads")
    dictionary = dictionary_of(rows)
    marked = rows.join(broadcast_measured(copies, 64), large == F.col("same"), "left").withColumn(
        "refers_to", F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("kept")), F.col("kept")))
    return materialize(write_archives(marked, folder, dictionary), "archives"), folder


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives, then read every record back (see ``archive_pages``, ``read_archives``)."""
    archives, folder = archive_pages(pages)
    return read_archives(archives.repartition(max(1, archives.sparkSession.sparkContext.defaultParallelism), "archive"), folder)


ARCHIVE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
 m AS (SELECT html, max(page_id) AS kept FROM p GROUP BY html),
 d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS hex, kept, page_id < kept OR (page_id IS NULL AND kept IS NOT NULL) AS again FROM p JOIN m USING (html)),
 b AS (SELECT *, list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        (('0x' || substr(hex, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8)) & 31)::INT + 1, 1)) AS letters FROM d)
SELECT page_id, payload_bytes, array_to_string(letters, '') AS payload_digest,
    CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN kept END AS refers_to FROM b"""
