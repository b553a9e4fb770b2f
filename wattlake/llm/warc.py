"""WARC archives of pages: one Zstandard frame per record, a shared dictionary in a leading skippable frame."""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm.shared import hash_sample, new_path, register, stored, table

#: Fixed values of the format.
DICTIONARY_FRAME = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MIN_PAYLOAD = 0
#: A new archive file begins behind so many compressed bytes.
FILE_BYTES = 16 << 20
#: The dictionary is built from about so many records, of so many bytes at most each.
SAMPLE_RECORDS, SAMPLE_BYTES = 1000, 16 << 10
DICTIONARY_BYTES = 64 << 10
DATE = "1970-01-01T00:00:00Z"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to=None, date: str = DATE) -> bytes:
    """One WARC record; with ``refers_to`` a revisit, which has no payload.

    ``X-Page-Id``, ``X-Refers-To-Page`` and ``X-Payload-Length`` keep what a record id or an absent payload can't tell."""
    name = lambda x: f"<urn:x-page:{'none' if x is None else x}>"
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {date}",
        f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}", f"X-Payload-Length: {len(payload)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {name(refers_to)}", f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers in lower case, payload) of each record of a decompressed archive."""
    while first := stream.readline():
        if first.strip() != b"WARC/1.1":
            raise ValueError(f"no record begins here: {first[:40]!r}")
        head: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            key, _, value = line.decode().partition(":")
            head[key.strip().lower()] = value.strip()
        block = stream.read(int(head["content-length"]))
        if len(block) != int(head["content-length"]) or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"{head.get('warc-record-id')}: the record is cut off")
        yield head, block.partition(b"\r\n\r\n")[2]


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A Zstandard dictionary, or nothing if there are too few records to train one."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if samples else b""
    except zstandard.ZstdError:
        return b""


def read_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of one archive file."""
    import zstandard

    magic, size = struct.unpack("<II", data[:8])
    if magic != DICTIONARY_FRAME:
        raise ValueError("the leading frame is missing")
    dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + size]) if size else None
    reader = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(io.BytesIO(memoryview(data)[8 + size :]), read_across_frames=True)
    yield from parse_records(io.BufferedReader(reader, 1 << 18))


def write_archives(pages: DataFrame, path: str, min_payload: int = MIN_PAYLOAD, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row into files below ``path`` and return their index (file, offset, length).

    Payload is the html in UTF-8 (null: empty).  Among rows of equal payloads of at least
    ``min_payload`` bytes, those with the smallest page_id are responses (more than one only if that id is
    repeated, or all ids are null); the others revisit it.  Shorter payloads are all responses.  File names carry the
    task attempt, so a lost or repeated task never touches another's files, and only files of the
    index count.  Columns besides page_id, url and html are not looked at.  An empty table gives no file.
    """
    html = F.coalesce("html", F.lit(""))
    keyed = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("sha"), F.octet_length(html).alias("bytes"))
    firsts = keyed.where(F.col("bytes") >= min_payload).groupBy(F.col("sha").alias("of"), F.col("bytes").alias("size")).agg(F.min("page_id").alias("first"))
    sample = hash_sample(pages, ["page_id"], SAMPLE_RECORDS)
    sample = sample.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("sha"))
    rows = sample.limit(2 * SAMPLE_RECORDS).select("page_id", "url", F.encode(F.col("html"), "UTF-8").substr(1, SAMPLE_BYTES).alias("html"), "sha").collect()  # bounded
    b32 = lambda sha: base64.b32encode(bytes.fromhex(sha)).decode()
    dictionary = train_dictionary([record(r.page_id, r.url, bytes(r.html), b32(r.sha)) for r in rows])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyarrow import fs

        given = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        press = zstandard.ZstdCompressor(level=3, **given)
        system, folder = fs.FileSystem.from_uri(path)
        context = TaskContext.get()
        system.create_dir(folder, recursive=True)
        out, name, at, files = None, "", 0, 0
        try:
            for batch in batches:
                index: list[tuple[str, int, int]] = []
                columns = [batch.column(c) for c in ("page_id", "url", "html", "sha", "first")]
                for k in range(batch.num_rows):
                    page, url, text, sha, first = (c[k].as_py() for c in columns)
                    if out is None or at >= file_bytes:
                        if out is not None:
                            out.close()
                        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{files:04d}.warc.zst"
                        out, files = system.open_output_stream(f"{folder}/{name}", compression=None), files + 1
                        lead = struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary
                        out.write(lead)
                        at = len(lead)
                    frame = press.compress(record(page, url, text.encode(), b32(sha), first if first != page else None))
                    out.write(frame)
                    index.append((name, at, len(frame)))
                    at += len(frame)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i[0] for i in index], pa.string()), pa.array([i[1] for i in index], pa.int64()), pa.array([i[2] for i in index], pa.int64())],
                    ["file", "offset", "length"],
                )
        finally:
            if out is not None:
                out.close()

    joined = keyed.join(firsts, (F.col("sha") == F.col("of")) & (F.col("bytes") == F.col("size")), "left")
    return stored(joined.select("page_id", "url", "html", "sha", "first").mapInArrow(write, "file string, offset long, length long"), "warc-index")


def read_archives(spark: SparkSession, path: str, index: DataFrame, id_type: str = "long") -> DataFrame:
    """(page_id, url, record_type, payload, payload_bytes, payload_digest, refers_to) of each record of the
    files that ``index`` names.  Digests of responses are taken from the payload as read and must
    equal the header's; revisits have no payload and carry the header's."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, folder = fs.FileSystem.from_uri(path)
        names = ["page_id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to"]
        kinds = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string()]
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with system.open_input_stream(f"{folder}/{name}", compression=None) as source:
                    data = source.read()
                rows: list[tuple] = []
                held = 0
                for head, payload in read_archive(data):
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    if head["warc-type"] == "response":
                        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if found != digest:
                            raise ValueError(f"{name}: {head['warc-record-id']} has another payload than its digest says")
                    size = int(head["x-payload-length"])
                    rows.append((head.get("x-page-id"), head["warc-target-uri"], head["warc-type"], payload, size, digest, head.get("x-refers-to-page")))
                    held += len(payload)
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = index.select("file").distinct().repartition(tasks, "file")
    out = files.mapInArrow(read, "page_id string, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to string")
    return out.withColumn("page_id", F.col("page_id").cast(id_type)).withColumn("refers_to", F.col("refers_to").cast(id_type))


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
SQL = f"""
WITH keyed AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages),
marked AS (SELECT *, min(page_id) OVER (PARTITION BY sha) AS first FROM keyed)
SELECT page_id, strlen(html) AS payload_bytes,
       array_to_string([substr('{_LETTERS}', 1 + CAST(
         (CAST('0x' || substr(sha, 1 + 5 * (i // 4), 5) AS BIGINT) // [32768, 1024, 32, 1][1 + i % 4]) % 32 AS INTEGER), 1) FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM marked
"""


@register("op8_warc", SQL)
def op8_warc(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    path = new_path(spark, "warc")
    index = write_archives(pages, path)
    records = read_archives(spark, path, index, pages.schema["page_id"].dataType.simpleString())
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
