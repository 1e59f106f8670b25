import base64
import hashlib
import struct

import pyarrow.fs as fs
import zstandard

from riskflow.llm import warc
from riskflow.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string, bundle string, frame string"


def sha1(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def rows_of(spark, tmp_path, pages, **sizes):
    df = spark.createDataFrame([(*p, "x", "y") for p in pages], SCHEMA)
    index = warc.write_archives(df, str(tmp_path / "warc"), **sizes)
    return index, warc.read_archives(index).collect()


PAGES = [
    (3, "http://a/", "<p>same</p>"),
    (1, "http://b/é x\r\nWARC-Type: fake", "<p>same</p>"),
    (2, None, None),
    (9, "http://c/", ""),
    (4, "http://d/", "é漢😀\r\n\r\nWARC/1.1\r\n" * 50),
    (5, "http://e/", "long " * 100_000),
    (6, "http://f/", "<p>same</p>"),
]


def test_round_trip_and_revisits(spark, tmp_path):
    _, rows = rows_of(spark, tmp_path, PAGES, frame_bytes=4096)
    by = {r.page_id: r for r in rows}
    assert len(rows) == len(PAGES) and all(r.intact for r in rows)
    for page, _, html in PAGES:
        assert by[page].payload_bytes == len((html or "").encode())
        assert by[page].payload_digest == sha1(html)
    assert {p: r.refers_to for p, r in by.items()} == {1: None, 2: None, 3: 1, 4: None, 5: None, 6: 1, 9: 2}
    assert all((r.record_type == "revisit") == (r.refers_to is not None) for r in rows)


def test_frames_are_independent_and_the_footer_finds_them(spark, tmp_path):
    index, _ = rows_of(spark, tmp_path, PAGES, frame_bytes=4096)
    for row in index.select("bundle").distinct().collect():
        raw = open(row.bundle, "rb").read()
        count, flags, magic = struct.unpack("<IBI", raw[-9:])
        assert magic == 0x8F92EAB1 and flags == 0
        file = fs.LocalFileSystem().open_input_file(row.bundle)
        places = warc.frames_of(file)
        assert len(places) == count
        whole = b""
        for start, packed, plain in places:
            part = zstandard.ZstdDecompressor().decompress(raw[start : start + packed], max_output_size=plain)
            assert len(part) == plain
            whole += part
        # An ordinary reader skips the seek table.
        with zstandard.ZstdDecompressor().stream_reader(open(row.bundle, "rb"), read_across_frames=True) as r:
            assert r.read() == whole


def test_single_records_by_seek(spark, tmp_path):
    index, _ = rows_of(spark, tmp_path, PAGES, frame_bytes=4096, bundle_bytes=1)
    wanted = spark.createDataFrame([("urn:page:4",), ("urn:page:1",), ("urn:page:77",)], "record_id string")
    got = {r.page_id: bytes(r.payload) for r in warc.fetch(index, wanted).collect()}
    assert got == {4: PAGES[4][2].encode(), 1: b"<p>same</p>"}


def test_nulls_repeats_and_empty_table(spark, tmp_path):
    pages = [(None, None, "x"), (None, None, "x"), (5, None, "x"), (5, None, "x"), (7, None, "x"), (8, None, None)]
    _, rows = rows_of(spark, tmp_path, pages)
    assert len(rows) == 6
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in rows)
    assert kinds == [(0, "response", None)] * 2 + [(5, "response", None)] * 2 + [(7, "revisit", 5), (8, "response", None)]
    index = warc.write_archives(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"))
    assert index.count() == 0 and warc.read_archives(index).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = QUERIES["op8_seekable_warc"](spark, folder).collect()
    assert len(rows) == len(pages)
    assert all(r.payload_digest == sha1(pages[r.page_id]) and r.intact for r in rows)
