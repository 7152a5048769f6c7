import collections
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starmart.llm import packing as P
from starmart.llm.tokens import WordTokens

PATH = public_tokenizers.path("word_bpe_49k.json")
HARD = ["", " ", "it's DON'T x'S İstanbul ΣΑΣ Σ a b é 　x 12ab34 ☃☃! ﬁ Ǆ 가각 \x85y z​w", "á ́b", "a.b,c!?d 'll", "ab12cd",
        "x" * 300, "über-Straße…END.", "\U0001f600 ok\U0001f600!"]


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids


def test_ids_are_the_tokenizers(plain, prose):
    texts = HARD + [prose(i, 200) for i in range(5)] + [" ".join(HARD) * 3]
    w = WordTokens(PATH, bits=6)  # a table that overflows
    for _ in range(2):
        got = w.encode([t.encode() for t in texts])
        assert [g.tolist() for g in got] == [plain(t) for t in texts]


def check(rows, texts, plain, window=2048):
    ids = {i: [*plain(t or ""), 1] for i, t in texts.items()}
    pieces, seqs = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        seqs[r.sequence_id].append(r)
        own = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4").tobytes()
        assert bytes(r.ids) == own and zlib.crc32(own) == zlib.crc32(bytes(r.ids))
        assert r.doc_tokens == len(ids[r.doc_id])
    for i, own in ids.items():
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert r.start == at
            at += r.length
        assert at == len(own)
    for own in seqs.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window and at & (at - 1) == 0  # nothing is padded


@pytest.mark.parametrize("shard_tokens", [1 << 20, 3000])
def test_every_id_is_packed_once(spark, make_docs, prose, plain, shard_tokens):
    texts = HARD + [prose(i, 50 + 37 * i) for i in range(25)] + ["long " * 5000, None, ""]
    docs = make_docs(texts)
    rows = P.pack(docs, PATH, window=256, shard_tokens=shard_tokens).collect()
    check(rows, dict(enumerate(texts)), plain, 256)


def test_repeated_and_null_ids_and_empty(spark, make_docs, plain):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c"), (None, None)], "doc_id long, text string")
    rows = P.pack(docs, PATH).collect()
    assert sum(r.length for r in rows) == 3 + 3 + 2 + 1
    assert P.pack(make_docs([]), PATH).count() == 0


def test_neighbours_follow_their_seed():
    """Documents on one subject end up in the same windows."""
    g = np.random.default_rng(0)
    docs = [np.r_[g.integers(100 * (i % 3), 100 * (i % 3) + 100, 60), g.integers(1000, 1010, 5)] for i in range(30)]
    df = collections.Counter(t for d in docs for t in set(d.tolist()))
    idf = np.zeros(1010)
    for t, n in df.items():
        idf[t] = np.log1p((30 - n + 0.5) / (n + 0.5))
    order = list(P.arrange(docs, P.Index(docs, idf, 65, 64), 256))
    assert sorted(order) == list(range(30))
    kinds = [i % 3 for i in order]
    assert sum(a == b for a, b in zip(kinds, kinds[1:])) >= 24


def test_bm25_scores_by_definition():
    docs = [np.array(x) for x in ([1, 1, 2, 3], [1, 4, 4], [2, 2, 2, 5, 6])]
    idf, mean = np.arange(8) / 10, 4.0
    s = P.Index(docs, idf, mean, 64).scores(0)

    def weight(d, t):
        tf = (docs[d] == t).sum()
        return idf[t] * tf * (P.K1 + 1) / (tf + P.K1 * (1 - P.B + P.B * len(docs[d]) / mean))

    assert s[1] == pytest.approx(weight(1, 1)) and s[2] == pytest.approx(weight(2, 2))


@pytest.mark.parametrize("block", [7, 64])
def test_bm25_scores_take_all_terms_of_a_seed(block):
    """A seed of 500 terms; one document shares only its 20 lightest ones."""
    g = np.random.default_rng(1)
    docs = [np.arange(500), np.arange(20), np.r_[np.arange(400, 420), 600], g.integers(0, 500, 300), np.arange(700, 900)]
    idf, mean = np.linspace(0.1, 3, 1000), 200.0
    s = P.Index(docs, idf, mean, block).scores(0)
    for d in range(1, len(docs)):
        shared = np.intersect1d(docs[0], docs[d])
        tf = np.array([(docs[d] == t).sum() for t in shared])
        full = idf[shared] * tf * (P.K1 + 1) / (tf + P.K1 * (1 - P.B + P.B * len(docs[d]) / mean))
        assert s[d] == pytest.approx(full.sum())
    assert s[1] > 0 and s[4] == 0


def test_shards_hold_what_is_alike(spark, make_docs, prose):
    """Near copies and documents on one subject meet although many shards
    could part them; windows stay inside a shard."""
    g = np.random.default_rng(2)
    subjects = [[f"{c}{k}" for k in range(60)] for c in ("alpha", "bravo", "carbon", "delta")]
    texts = [" ".join(g.choice(subjects[i % 4], 80)) for i in range(400)]
    texts += [texts[i].rsplit(" ", 1)[0] for i in range(0, 400, 4)]  # near copies
    rows = P.pack(make_docs(texts), PATH, window=256, shard_tokens=20_000).collect()
    shard = {r.doc_id: r.sequence_id >> 32 for r in rows}
    assert len(set(shard.values())) >= 4
    assert np.mean([shard[400 + k] == shard[4 * k] for k in range(100)]) > 0.7
    kinds = collections.defaultdict(collections.Counter)
    for i in range(400):
        kinds[shard[i]][i % 4] += 1
    assert sum(max(c.values()) for c in kinds.values()) > 0.8 * 400


def test_router_deals_copies_out():
    g = np.random.default_rng(3)
    x = np.r_[np.repeat(g.normal(size=(1, 8)), 500, 0), g.normal(size=(500, 8))].astype(np.float32)
    tree = P.Router(x, np.ones(1000, np.int64), 20)
    size = np.bincount(tree.route(x, g.integers(0, 1 << 62, 1000)), minlength=20)
    assert size.min() > 0 and size.max() < 250


def test_sequences():
    assert list(P.sequences(2048 * 2 + 1000, 2048)) == [2048, 2048, 512, 256, 128, 64, 32, 8]
    assert list(P.sequences(0, 2048)) == []
