"""Word and window hashes of whole texts, vectorised over raw UTF-8 bytes.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D.  Its hash is
a polynomial over Z/2^64 of a random table value per byte, relative to the
word's first byte, mixed with the length.  A window hash is a polynomial of
the word hashes, again mixed, so any window length costs the same.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
_PIECE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_P, _Q = 0x9FB21C651E98DF25 | 1, 0xD6E8FEB86659FD93 | 1
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^0..base^n and the powers of its inverse, modulo 2^64."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, 1 << 12)
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            out = np.ones(size, np.uint64)
            done, step = 1, b
            while done < size:  # doubling: out[done:2*done] = out[:done] * b^done
                k = min(done, size - done)
                out[done:done + k] = out[:k] * U(step)
                step = step * step % (1 << 64)
                done *= 2
            pair.append(out)
        have = _POWERS[base] = (pair[0], pair[1])
    return have


def utf8(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and each row's offsets; null is empty."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], pa.string())
    arr = arr.cast(pa.large_binary())
    if arr.null_count:
        arr = arr.fill_null(b"")
    n = len(arr)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, np.int64)[arr.offset:arr.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of a block of texts, in order: byte spans, hash, and the first
    word of each text (``first`` has one entry more than there are texts)."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False, kinds: np.ndarray | None = None) -> Words:
    """Words of every text; with ``lower``, A-Z count as a-z in the hash.
    With ``kinds``, a word also ends where bytes of kind 1 and 2 meet."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return Words(z, z, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    word = ~_SPACE[data]
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    if kinds is not None:
        kind = kinds[data]
        meet = np.flatnonzero(kind[1:] + kind[:-1] == 3) + 1
        begins[meet] = True
        ends[meet - 1] = True
    inner = offsets[1:-1]  # a text's border also ends a word
    inner = inner[(inner > 0) & (inner < len(data))]
    begins[inner] |= word[inner]
    ends[inner - 1] |= word[inner - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    table = _BYTE_LOWER if lower else _BYTE
    hashes = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):  # pieces of about 1 MB bound the temporaries
        j = max(i + 1, int(np.searchsorted(end, start[i] + _PIECE, "right")))
        a, b = start[i], end[j - 1]
        up, down = _powers(_P, int(b - a))
        run = np.zeros(b - a + 1, np.uint64)
        np.cumsum(table[data[a:b]] * up[:b - a], out=run[1:])
        s, e = start[i:j] - a, end[i:j] - a
        hashes[i:j] = mix((run[e] - run[s]) * down[s] ^ (e - s).astype(np.uint64) * U(0x9E3779B97F4A7C15))
        i = j
    return Words(start, end, hashes, np.searchsorted(start, offsets).astype(np.int64))


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k items from each position on; the last k-1 have none."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    up, down = _powers(_Q, min(len(h), _PIECE))
    step = _PIECE - k
    for i in range(0, n, step):
        j = min(n, i + step)
        part = h[i:j + k - 1]
        run = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[:len(part)], out=run[1:])
        out[i:j] = mix((run[k:] - run[:-k]) * down[:j - i] ^ U(k))
    return out


def inside(w: Words, k: int) -> np.ndarray:
    """Whether the k-word window at each position ends in its own text."""
    n = len(w.hash) - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    last = np.repeat(w.first[1:], np.diff(w.first))[:n]
    return np.arange(n) + k <= last
