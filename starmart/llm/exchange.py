"""Which 64-bit hashes occur more than once in a corpus, without a row each.

Documents are dealt into blocks of bounded bytes.  A block sends, per hash
range, its sorted distinct hashes as one packed cell; the reducer of a range
adds the counts up and returns to every block those of its hashes that the
corpus holds at least twice.  A range covers a fixed share of the hash space,
so no key is hot whatever the texts hold.  Within a range a hash is known by
its next 32 bits: two hashes that fall together only make a count too high,
so callers use the counts to order or preselect and verify afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 4 << 20  # text per block
RANGE_ITEMS = 1 << 21  # hashes per range, about

CELL = "rng int, block long, lows binary, counts binary"


def layout(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """(blocks, range bits) for the bytes that ``docs`` holds."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    return int(blocks), int(max(0, (total // 6 // RANGE_ITEMS).bit_length()))


def block_of(blocks: int, key: str = "doc_id", text: str = "text") -> Column:
    """A row's block.  Rows without a key are spread by their text."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("long"), F.xxhash64(text))), F.lit(blocks))


def pack(values: np.ndarray) -> bytes:
    """uint32 values as differences in byte planes, compressed."""
    d = np.diff(values, prepend=np.uint32(0)).astype("<u4")
    planes = np.ascontiguousarray(d.view(np.uint8).reshape(-1, 4).T).tobytes()
    return len(values).to_bytes(4, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:4], "little")
    planes = np.frombuffer(pa.decompress(blob[4:], n * 4, codec="zstd", asbytes=True), np.uint8)
    d = np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel()
    return np.cumsum(d, dtype=np.uint32)


def split(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash's range and its place there."""
    rng = (h >> np.uint64(64 - bits)).astype(np.int32) if bits else np.zeros(len(h), np.int32)
    return rng, ((h >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def slots(h: np.ndarray, bits: int) -> np.ndarray:
    """Range and place in one number, which sorts as the hashes do."""
    return h >> np.uint64(32 - bits)


def cells(block: int, h: np.ndarray, bits: int) -> Iterator[dict]:
    """One cell per range; ``h`` has a hash once per document that holds it."""
    s = np.sort(slots(h, bits))
    new = np.flatnonzero(np.r_[True, s[1:] != s[:-1]]) if len(s) else np.zeros(0, np.int64)
    counts = np.diff(np.r_[new, len(s)]).astype(np.uint32)
    s = s[new]
    rng = (s >> np.uint64(32)).astype(np.int64)
    low = (s & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    cut = np.flatnonzero(np.r_[True, rng[1:] != rng[:-1]]) if len(s) else []
    for a, b in zip(cut, np.r_[cut[1:], len(s)] if len(cut) else []):
        yield {"rng": int(rng[a]), "block": block, "lows": pack(low[a:b]), "counts": pack(counts[a:b])}


def _reduce(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    lows = [unpack(r["lows"]) for r in rows]
    low = np.concatenate(lows)
    count = np.concatenate([unpack(r["counts"]) for r in rows])
    src = np.repeat(np.arange(len(rows)), [len(x) for x in lows])
    order = np.argsort(low, kind="stable")
    low, count, src = low[order], count[order], src[order]
    new = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
    total = np.add.reduceat(count.astype(np.int64), new)
    total = np.repeat(total, np.diff(np.r_[new, len(low)]))
    keep = total >= 2
    low, src, total = low[keep], src[keep], np.minimum(total[keep], 0xFFFFFFFF).astype(np.uint32)
    back = np.argsort(src, kind="stable")
    low, src, total = low[back], src[back], total[back]
    out = []
    cut = np.flatnonzero(np.r_[True, src[1:] != src[:-1]]) if len(src) else []
    for a, b in zip(cut, np.r_[cut[1:], len(src)] if len(cut) else []):
        r = rows[src[a]]
        out.append({"rng": r["rng"], "block": r["block"], "lows": pack(low[a:b]), "counts": pack(total[a:b])})
    return pa.Table.from_pylist(out, schema=pa.schema(
        [("rng", pa.int32()), ("block", pa.int64()), ("lows", pa.binary()), ("counts", pa.binary())]))


def shared(cell_rows: DataFrame) -> DataFrame:
    """Per (block, range), the hashes with a corpus count of 2 or more."""
    return cell_rows.groupBy("rng").applyInArrow(_reduce, CELL)


def lookup(rows: list[dict], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A block's returned cells as sorted slots and their counts."""
    rows = sorted((r for r in rows if r["lows"] is not None), key=lambda r: r["rng"])
    if not rows:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    slot = [unpack(r["lows"]).astype(np.uint64) | np.uint64(r["rng"] << 32) for r in rows]
    return np.concatenate(slot), np.concatenate([unpack(r["counts"]) for r in rows])


def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key stands in a sorted table, and whether it does."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys
