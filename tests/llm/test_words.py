import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starmart.llm import exchange as X
from starmart.llm import words as W

TEXT = st.text(alphabet=st.sampled_from("aAbé \n\t\x0b\x0c\r\xa0ß.☃"), max_size=40)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=6))
def test_words_are_the_byte_split(texts):
    w = W.words(*W.utf8(pa.array(texts, pa.string())))
    flat = [x for t in texts for x in (t or "").encode().split()]
    data = b"".join((t or "").encode() for t in texts)
    assert [data[a:b] for a, b in zip(w.start, w.end)] == flat
    assert np.diff(w.first).tolist() == [len((t or "").encode().split()) for t in texts]
    by = {}
    for x, h in zip(flat, w.hash.tolist()):
        assert by.setdefault(x, h) == h
    assert len(set(by.values())) == len(by)


def test_hash_does_not_depend_on_pieces(monkeypatch):
    data, offsets = W.utf8(pa.array(["alpha beta gamma " * 50, "beta"]))
    whole = W.words(data, offsets)
    monkeypatch.setattr(W, "_PIECE", 16)
    small = W.words(data, offsets)
    assert (whole.hash == small.hash).all()
    monkeypatch.setattr(W, "_PIECE", 40)
    a = W.windows(whole.hash, 5)
    monkeypatch.setattr(W, "_PIECE", 1 << 20)
    assert (a == W.windows(whole.hash, 5)).all()


def test_lower_covers_ascii_letters_only():
    w = W.words(*W.utf8(pa.array(["ABC abc", "É é"])), lower=True)
    assert w.hash[0] == w.hash[1] and w.hash[2] != w.hash[3]


def test_windows_tell_order():
    h = W.words(*W.utf8(pa.array(["a b a b b a"]))).hash
    g = W.windows(h, 2).tolist()
    assert g[0] == g[2] and len(set(g)) == 3


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2 ** 32 - 1), max_size=50))
def test_pack_round_trip(values):
    v = np.array(values, np.uint32)
    assert (X.unpack(X.pack(v)) == v).all()


@pytest.mark.parametrize("bits", [0, 3])
def test_shared_counts(spark, bits):
    g = np.random.default_rng(0)
    sets = [np.unique(g.integers(0, 300, 120).astype(np.uint64)) for _ in range(4)]
    sets = [W.mix(s) for s in sets]
    rows = [(c["rng"], c["block"], c["lows"], c["counts"]) for b, s in enumerate(sets) for c in X.cells(b, s, bits)]
    back = X.shared(spark.createDataFrame([(int(a), b, bytes(c), bytes(d)) for a, b, c, d in rows], X.CELL)).collect()
    every, n = np.unique(np.concatenate(sets), return_counts=True)
    want = dict(zip(every.tolist(), n.tolist()))
    for b, s in enumerate(sets):
        slot, count = X.lookup([r.asDict() for r in back if r.block == b], bits)
        at, found = X.find(slot, X.slots(np.sort(s), bits))
        for h, f, c in zip(np.sort(s).tolist(), found, count[at]):
            assert f == (want[h] > 1)
            if f:
                assert c == want[h]
