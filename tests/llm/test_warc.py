import base64
import hashlib
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from starmart.llm import warc

SCHEMA = "page_id long, url string, html string, record_type string"


def pages(spark, n=60):
    rows = [(i, f"https://h{i % 7}.example/{i}", f"<p>é {'x' * (i % 11)}</p>", "odd") for i in range(n)]
    rows += [(100, None, None, None), (101, "bad\r\nurl here", "", None), (102, "u", "long " * 40000, None)]
    return spark.createDataFrame(rows, SCHEMA), rows


@pytest.mark.parametrize("bundle_bytes,frame_bytes", [(8 << 20, 128 << 10), (500, 600)])
def test_round_trip(spark, bundle_bytes, frame_bytes):
    table, rows = pages(spark)
    got = {r.page_id: r for r in warc.read(warc.write(table, bundle_bytes=bundle_bytes, frame_bytes=frame_bytes)).collect()}
    payload = {r[0]: (r[2] or "").encode() for r in rows}
    last = {}
    for i, p in payload.items():
        last[p] = max(i, last.get(p, -1))
    assert len(got) == len(rows)
    for i, p in payload.items():
        r = got[i]
        assert r.payload_bytes == len(p) and r.payload_digest == base64.b32encode(hashlib.sha1(p).digest()).decode()
        if last[p] == i:
            assert (r.record_type, r.refers_to, bytes(r.payload)) == ("response", None, p)
        else:
            assert (r.record_type, r.refers_to, r.payload) == ("revisit", last[p], None)
    assert "\n" not in got[101].url and got[100].url == "urn:unknown"


def test_smaller_payloads_are_all_responses(spark):
    table = spark.createDataFrame([(1, "a", "xx"), (2, "b", "xx"), (3, "c", "xxx"), (4, "d", "xxx")], "page_id long, url string, html string")
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.read(warc.write(table, min_bytes=3)).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}


def test_repeats_and_null_ids(spark):
    table = spark.createDataFrame([(5, "a", "z"), (5, "a", "z"), (None, "n", "z"), (None, "m", "q"), (None, "k", "q")],
                                  "page_id long, url string, html string")
    got = sorted(((r.page_id, r.payload_digest[:2], r.record_type, r.refers_to) for r in warc.read(warc.write(table)).collect()), key=repr)
    z, q = (base64.b32encode(hashlib.sha1(x).digest()).decode()[:2] for x in (b"z", b"q"))
    assert got == sorted([(5, z, "response", None), (5, z, "revisit", 5), (None, z, "revisit", 5),
                          (None, q, "response", None), (None, q, "revisit", None)], key=repr)
    assert warc.read(warc.write(table.limit(0))).count() == 0


def test_seek_table_and_frames(spark):
    """Any reader of the format opens the bundle; an index entry is enough
    to read one record from its frame alone."""
    table, _ = pages(spark)
    archives = warc.write(table, frame_bytes=2000)
    for row in archives.collect():
        data = bytes(row.data)
        count, _, magic = struct.unpack("<IBI", data[-9:])
        assert magic == 0x8F92EAB1 and count > 1
        whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        places = warc.frames(data)
        assert len(places) == count
        parts = [zstandard.ZstdDecompressor().decompress(data[a:a + n]) for a, n in places]
        assert b"".join(parts) == whole
        for r in row.records:
            raw = parts[r.frame][r.offset:r.offset + r.length]
            assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")
            assert warc.parse(raw)[0]["WARC-Record-ID"] == f"<{r.record_id}>"


def test_reading_some_records(spark):
    table, _ = pages(spark)
    archives = warc.write(table, bundle_bytes=2000, frame_bytes=600)
    index = archives.select(F.explode("records").alias("r")).select("r.*")
    only = index.filter("page_id IN (3, 17, 101)")
    assert {r.page_id for r in warc.read(archives, only).collect()} == {3, 17, 101}


def test_export(spark, tmp_path):
    table, _ = pages(spark)
    files = warc.export(warc.write(table, bundle_bytes=3000), str(tmp_path / "out")).collect()
    assert len(files) > 1 and sorted(f.file for f in files) == sorted(str(p) for p in (tmp_path / "out").iterdir())
