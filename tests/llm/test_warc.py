"""WARC archives: exact round trip, revisits, random access by the index."""

import base64
import hashlib
import io

from pyspark.sql import functions as F

from wattlake.llm.shared import new_path
from wattlake.llm.warc import parse_records, read_archives, write_archives

ROWS = [(5, "http://a/\r\nb", "same"), (3, "http://b", "same"), (9, None, "same"), (1, "http://c", None), (2, "http://d", ""), (4, "http://é", "é" * 50000), (None, "http://e", "lonely"), (None, "http://f", "same"), (7, "u", "twice"), (7, "u", "twice")]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, sha string, first int")


def test_round_trip(spark):
    path = new_path(spark, "warc-test")
    index = write_archives(pages(spark, ROWS), path)
    got = [tuple(r) for r in read_archives(spark, path, index).select("page_id", "record_type", F.decode("payload", "UTF-8"), "payload_bytes", "payload_digest", "refers_to").collect()]
    first = {"same": 3, "": 1, "twice": 7}
    want = []
    for i, _, html in ROWS:
        html = html or ""
        digest = base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        to = first.get(html)
        revisit = to is not None and i != to
        want.append((i, "revisit" if revisit else "response", "" if revisit else html, len(html.encode()), digest, to if revisit else None))
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_records_are_frames_of_their_own(spark):
    import zstandard

    path = new_path(spark, "warc-test")
    index = write_archives(pages(spark, [(i, f"http://x/{i}", f"<p>page {i} of some length</p>" * 30) for i in range(200)]), path, file_bytes=4000)
    rows = index.collect()
    assert len({r.file for r in rows}) > 1
    seen = set()
    for r in rows:
        with open(f"{path.removeprefix('file:')}/{r.file}", "rb") as f:
            data = f.read()
        size = int.from_bytes(data[4:8], "little")
        assert data[:4] == bytes([0x5D, 0x2A, 0x4D, 0x18])
        unpress = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size])) if size else zstandard.ZstdDecompressor()
        (head, payload), = parse_records(io.BytesIO(unpress.decompress(data[r.offset : r.offset + r.length])))
        seen.add((int(head["x-page-id"]), payload))
    assert seen == {(i, (f"<p>page {i} of some length</p>" * 30).encode()) for i in range(200)}


def test_empty_table_and_short_payloads(spark):
    path = new_path(spark, "warc-test")
    index = write_archives(pages(spark, []), path)
    assert read_archives(spark, path, index).collect() == []
    path = new_path(spark, "warc-test")
    short = write_archives(pages(spark, [(1, "a", "xy"), (2, "b", "xy"), (3, "c", "long one"), (4, "d", "long one")]), path, min_payload=3)
    assert {r.page_id: r.record_type for r in read_archives(spark, path, short).collect()} == {1: "response", 2: "response", 3: "response", 4: "revisit"}
