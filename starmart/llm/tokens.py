"""Exact token ids of a public tokenizer, by a bounded table of words.

The tokenizer lower-cases, turns white space to spaces and splits before it
merges, so no token crosses ASCII white space or a border between ASCII
letters and punctuation other than the apostrophe: a text's ids are the ids
of those parts in a row.  Parts that differ in the case of ASCII letters have
the same ids.  Each distinct part is encoded once per worker while the table
lasts; new ones go to the tokenizer in joined chunks, whose ids are cut at
the word-end marks.  Where marks and splits disagree, parts are encoded one
by one.  Parts are known by a 64-bit hash.
"""

from __future__ import annotations

import os

import numpy as np
import regex

from starmart.llm import words as W

TABLE_BITS = 22
_SLICE = 2 << 20  # bytes of text handled at a time
_CHUNK = 20
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
_KINDS = np.zeros(256, np.uint8)
_KINDS[33:127] = 2
_KINDS[39] = 0  # the apostrophe may begin a part of its own
_KINDS[48:58] = 0
_KINDS[65:91] = _KINDS[97:123] = 1


class WordTokens:
    def __init__(self, path: str, bits: int = TABLE_BITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self._clear(bits)

    def _clear(self, bits: int) -> None:
        self.bits, self.mask = bits, (1 << bits) - 1
        self.room = (1 << bits) * 3 // 5
        self.keys = np.zeros(self.mask + 1, np.uint64)
        self.number = np.zeros(self.mask + 1, np.int32)
        self.first = np.zeros(1 << 16, np.int32)
        self.length = np.zeros(1 << 16, np.int32)
        self.ids = np.zeros(1 << 18, np.int32)
        self.count = self.filled = 0

    def _find(self, h: np.ndarray) -> np.ndarray:
        """The number of each hash, or -1."""
        out = np.full(len(h), -1, np.int64)
        at, todo = (h & W.U(self.mask)).astype(np.int64), np.arange(len(h))
        while len(todo):
            key = self.keys[at]
            hit = key == h[todo]
            out[todo[hit]] = self.number[at[hit]]
            more = ~hit & (key != 0)
            todo, at = todo[more], (at[more] + 1) & self.mask
        return out

    def _put(self, h: np.ndarray, number: np.ndarray) -> None:
        """Enter distinct new hashes by linear probing."""
        at, todo = (h & W.U(self.mask)).astype(np.int64), np.arange(len(h))
        while len(todo):
            free = self.keys[at] == 0
            self.keys[at[free]] = h[todo[free]]
            won = free & (self.keys[at] == h[todo])
            self.number[at[won]] = number[todo[won]]
            todo, at = todo[~won], (at[~won] + 1) & self.mask

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pre-tokens (normalised, no white space) in a row, and
        where each begins (one entry more than there are pre-tokens)."""
        chunks = [pieces[i:i + _CHUNK] for i in range(0, len(pieces), _CHUNK)]
        code = self.tokenizer.encode_batch_fast
        ids = [e.ids for e in code([" ".join(c) for c in chunks], add_special_tokens=False)]
        flat = np.array([i for x in ids for i in x], np.int32)
        if all(ids):
            marks = np.add.reduceat(self.ends[flat].astype(np.int64), np.cumsum([0, *map(len, ids[:-1])]))
            if all(n == len(c) for n, c in zip(marks, chunks)):
                return flat, np.r_[0, np.flatnonzero(self.ends[flat]) + 1]
        ids = [e.ids for e in code(pieces, add_special_tokens=False)]
        return np.array([i for x in ids for i in x], np.int32), np.cumsum([0, *map(len, ids)])

    def _learn(self, h: np.ndarray, text: list[str]) -> None:
        norm = self.tokenizer.normalizer.normalize_str
        flat = norm(" ".join(text)).split(" ")
        if len(flat) != len(text):  # other white space inside a part
            flat = [norm(w) for w in text]
        split = [_SPLIT.findall(w) for w in flat]
        index: dict[str, int] = {}
        use = np.array([index.setdefault(p, len(index)) for s in split for p in s], np.int64)
        ids, first = self._pieces(list(index)) if index else (np.zeros(0, np.int32), np.zeros(1, np.int64))
        size = np.diff(first)[use]
        to = np.cumsum(size)
        own = ids[np.repeat(first[use] - to + size, size) + np.arange(to[-1] if len(to) else 0)]
        ends = np.r_[0, to][np.cumsum([0, *map(len, split)])]  # where each part's ids begin
        k, a = self.count, self.filled
        while k + len(text) > len(self.first):
            self.first, self.length = (np.concatenate([x, x]) for x in (self.first, self.length))
        while a + len(own) > len(self.ids):
            self.ids = np.concatenate([self.ids, self.ids])
        self.ids[a:a + len(own)] = own
        self.first[k:k + len(text)], self.length[k:k + len(text)] = a + ends[:-1], np.diff(ends)
        self._put(h, np.arange(k, k + len(text)))
        self.count += len(text)
        self.filled += len(own)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text (int32)."""
        out: list[np.ndarray] = []
        i = 0
        while i < len(texts):
            j, size = i, 0
            while j < len(texts) and (j == i or size + len(texts[j]) <= _SLICE):
                size += len(texts[j])
                j += 1
            raw = b"".join(texts[i:j])
            w = W.words(np.frombuffer(raw, np.uint8), np.cumsum([0, *map(len, texts[i:j])]), True, _KINDS)
            h = w.hash | W.U(1)  # 0 marks a free place
            code = self._find(h)
            lost = np.flatnonzero(code < 0)
            if len(lost):
                new, at = np.unique(h[lost], return_index=True)
                if self.count + len(new) > self.room:  # start anew, with room for this slice
                    lost = np.arange(len(h))
                    new, at = np.unique(h, return_index=True)
                    self._clear(max(TABLE_BITS, (len(new) * 2).bit_length()))
                at = lost[at]
                self._learn(new, [raw[a:b].decode() for a, b in zip(w.start[at].tolist(), w.end[at].tolist())])
                code = self._find(h)
            n = self.length[code]
            to = np.cumsum(n, dtype=np.int64)
            ids = self.ids[np.repeat(self.first[code] - to + n, n) + np.arange(to[-1] if len(to) else 0)]
            out += np.split(ids, np.r_[0, to][w.first[1:-1]])
            i = j
        return out


_LOADED: dict[str, WordTokens] = {}


def loaded(path: str) -> WordTokens:
    """The worker's tokenizer, loaded once."""
    if path not in _LOADED:
        _LOADED[path] = WordTokens(path)
    return _LOADED[path]
