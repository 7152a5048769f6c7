"""WARC records in seekable Zstandard bundles.

Pages are dealt into bundles.  A bundle groups its records into independent
Zstandard frames and ends with a seek table (a skippable frame that lists the
compressed and decompressed size of every frame), so any reader of the
seekable format can open it; each row also maps its record ids to a frame, an
offset in the decompressed frame and a length.  A bundle is one row of a
Parquet table: Spark's committer makes retries and lost executors safe on any
store.  ``export`` writes the bundles as files where tasks share a folder.

Of equal payloads of at least ``min_bytes`` bytes the page with the largest
id is the response and all others are revisits of it; equality and largest id
come from a grouped aggregate over SHA-1 digests.

Nulls and ties: a null html is an empty payload, a null url is urn:unknown.
A null id counts as smaller than every id.  Repeated rows (equal id and
payload) are one response and revisits of it; where all ids of a payload are
null, the first is the response and the others revisit null.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import write_table
from starmart.llm.joins import join_counted

BUNDLE_BYTES = 4 << 20  # of payload per bundle, about
READ_BYTES = 1 << 20  # of payload handed on at a time
FRAME_BYTES = 128 << 10  # of records per frame, at least one record
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = "struct<record_id:string,page_id:bigint,frame:int,offset:bigint,length:bigint>"
_BUNDLE = f"bundle long, data binary, records array<{_RECORD}>"
_READ = ("record_id string, page_id long, record_type string, url string, refers_to long, "
         "payload_digest string, payload_bytes long, payload binary")
# the seekable format's fixed numbers
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1


def _escape(url: str | None) -> str:
    """A url that cannot break a header line."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "") or "urn:unknown"


def record(record_id: str, page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str,
           refers_id: str | None, refers_to: int | None) -> bytes:
    """One WARC/1.1 record.  A revisit keeps the HTTP head only."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {_escape(url)}", f"WARC-Payload-Digest: sha1:{digest}"]
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{refers_id}>"]
        if refers_to is not None:
            head.append(f"Refers-To-Page-ID: {refers_to}")
    else:
        block += payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (WARC and, prefixed by http:, HTTP) and payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    out = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(out["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    out |= {f"http:{k}": v for k, v in (line.split(": ", 1) for line in http.decode().split("\r\n")[1:])}
    return out, payload


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The footer: a skippable frame with both sizes of every frame."""
    body = b"".join(struct.pack("<II", *s) for s in sizes) + struct.pack("<IBI", len(sizes), 0, _SEEKABLE)
    return struct.pack("<II", _SKIPPABLE, len(body)) + body


def frames(data: bytes | memoryview) -> list[tuple[int, int]]:
    """(start, compressed size) of every frame, from the footer alone."""
    count, flags, magic = struct.unpack("<IBI", data[-9:])
    entry = 12 if flags & 0x80 else 8
    if magic != _SEEKABLE:
        raise ValueError("no seek table")
    start, out = 0, []
    base = len(data) - 9 - entry * count
    for i in range(count):
        size = struct.unpack_from("<I", data, base + entry * i)[0]
        out.append((start, size))
        start += size
    return out


def write(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0,
          bundle_bytes: int = BUNDLE_BYTES, frame_bytes: int = FRAME_BYTES, level: int = 3) -> DataFrame:
    """Write the bundles; returns the written table (bundle, data, records)."""
    html = F.coalesce(F.encode(F.col(html_col), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        html.alias("payload"))
    total = rows.agg(F.sum(F.length("payload"))).first()[0] or 0
    bundles = max(1, -(-total // bundle_bytes))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload"))).withColumn(
        "bundle", F.pmod(F.xxhash64(F.coalesce("page_id", F.xxhash64("digest"))), F.lit(bundles)))
    marks = write_table(rows.filter(F.length("payload") >= min_bytes).select("bundle", "page_id", "digest"), "digests")
    groups = write_table(marks.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("c"))
                         .filter("c > 1"), "payloads")
    revisits = join_counted(marks, groups, "digest", "c", "page_id", "inner").distinct()

    def build(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        import zstandard

        if not left.num_rows:
            return _bundle_table([])
        first = {(r["page_id"], r["digest"]): r["refers_to"] for r in right.to_pylist()}
        coder = zstandard.ZstdCompressor(level=level)
        data, sizes, records, held, fill = [], [], [], [], 0

        def close() -> None:
            nonlocal fill
            raw = b"".join(held)
            data.append(coder.compress(raw))
            sizes.append((len(data[-1]), len(raw)))
            held.clear()
            fill = 0

        seen: dict = {}
        for r in sorted(left.to_pylist(), key=lambda r: (r["page_id"] is None, r["page_id"] or 0, r["digest"], r["url"] or "")):
            page, same = r["page_id"], (r["page_id"], r["digest"])
            n = seen[same] = seen.get(same, -1) + 1  # how many equal rows came before
            digest = base32(r["digest"])
            name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page}/{digest}/{n}").urn
            revisit = same in first and (first[same] != page or n > 0)
            target = first.get(same)
            refers = uuid.uuid5(uuid.NAMESPACE_URL, f"{target}/{digest}/0").urn if revisit else None
            raw = record(name, page, r["url"], r["payload"], digest, "revisit" if revisit else "response", refers,
                         target if revisit else None)
            if held and fill + len(raw) > frame_bytes:
                close()
            records.append({"record_id": name, "page_id": page, "frame": len(sizes), "offset": fill, "length": len(raw)})
            held.append(raw)
            fill += len(raw)
        close()
        return _bundle_table([{"bundle": key[0].as_py(), "data": b"".join(data) + seek_table(sizes), "records": records}])

    left = rows.select("bundle", "page_id", "url", "payload", "digest").groupBy("bundle")
    return write_table(left.cogroup(revisits.groupBy("bundle")).applyInArrow(build, _BUNDLE), "warc")


def _bundle_table(rows: list[dict]) -> pa.Table:
    record_type = pa.struct([("record_id", pa.string()), ("page_id", pa.int64()), ("frame", pa.int32()),
                             ("offset", pa.int64()), ("length", pa.int64())])
    return pa.Table.from_pylist(rows, schema=pa.schema(
        [("bundle", pa.int64()), ("data", pa.binary()), ("records", pa.list_(record_type))]))


def read(archives: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """The records of the bundles, read through seek table and index; with
    ``only`` (record_id), just those, and only their frames are opened."""
    if only is not None:
        wanted = archives.select("bundle", F.explode("records").alias("r")).join(
            only.select("record_id").distinct(), F.col("r.record_id") == F.col("record_id"), "left_semi")
        wanted = wanted.groupBy("bundle").agg(F.collect_list("r").alias("records"))
        archives = archives.select("bundle", "data").join(wanted, "bundle")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        coder = zstandard.ZstdDecompressor()
        for b in batches:
            for data, records in zip(b.column(0), b.column(1)):
                blob = memoryview(data.as_buffer())
                places, out, held, current, raw = frames(blob), [], 0, -1, b""
                for r in sorted(records.as_py(), key=lambda r: (r["frame"], r["offset"])):
                    if r["frame"] != current:
                        current = r["frame"]
                        start, size = places[current]
                        raw = coder.decompress(blob[start:start + size])
                    head, payload = parse(raw[r["offset"]:r["offset"] + r["length"]])
                    kind = head["WARC-Type"]
                    whole = kind == "response"
                    digest = base32(hashlib.sha1(payload).digest()) if whole else head["WARC-Payload-Digest"][5:]
                    page, refers = head.get("Page-ID"), head.get("Refers-To-Page-ID")
                    out.append({"record_id": head["WARC-Record-ID"][1:-1], "page_id": int(page) if page else None,
                                "record_type": kind, "url": head["WARC-Target-URI"],
                                "refers_to": int(refers) if refers else None, "payload_digest": digest,
                                "payload_bytes": len(payload) if whole else int(head["http:Content-Length"]),
                                "payload": payload if whole else None})
                    held += len(payload)
                    if held >= READ_BYTES:
                        yield pa.RecordBatch.from_pylist(out, schema=_READ_SCHEMA)
                        out, held = [], 0
                yield pa.RecordBatch.from_pylist(out, schema=_READ_SCHEMA)

    return archives.select("data", "records").mapInArrow(run, _READ)


_READ_SCHEMA = pa.schema([
    ("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("url", pa.string()),
    ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def export(archives: DataFrame, folder: str) -> DataFrame:
    """Write each bundle as ``folder``/bundle-N.warc.zst from the task that
    holds it; ``folder`` must be shared by all executors.  A file appears
    whole, so a repeated task does no harm.  Returns (bundle, file, bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(folder, exist_ok=True)
        for b in batches:
            out = []
            for bundle, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                name = os.path.join(folder, f"bundle-{bundle:08d}.warc.zst")
                part = f"{name}.{uuid.uuid4().hex}"
                with open(part, "wb") as f:
                    f.write(data)
                os.replace(part, name)
                out.append({"bundle": bundle, "file": name, "bytes": len(data)})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                [("bundle", pa.int64()), ("file", pa.string()), ("bytes", pa.int64())]))

    return archives.select("bundle", "data").mapInArrow(run, "bundle long, file string, bytes long")
