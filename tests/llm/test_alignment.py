"""Token alignment against whole-text encoding and all overlapping pairs."""

import hashlib
from collections import Counter

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from starmart.llm.alignment import Aligner, align, byte_characters, link_counts

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")

TEXTS = [
    "The quick brown fox", None, "", " ", "  two  spaces and a tail ", "tail\n\n \t mixed\r\n lines  \n",
    "Größe und Straße, naïve café £ 5 ×÷ ñandú", "日本語のテキスト と space、全角　space", "▁ is a mark", "a▁b",
    "<|endoftext|> and <s> and </s> <unk> <0x41> stay text", "\x00\x01\x7f control", "emoji 🙂🙃 x́  nbsp em",
    "it's we'll they'd 12345 67 8,9 ... --- !!", "Zażółć gęślą jaźń привет мир שלום עולם", "x" * 5000,
    "supercalifragilistic unbelievable wrdnt qqzx " * 200, "The quick brown fox", "\u0085next\u0085 line", "é é ê b",
]


def brute(texts):
    """Counts and groups by the definition: whole texts, every pair of tokens."""
    import sentencepiece
    from tokenizers import Tokenizer

    ta, tb = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    ta.encode_special_tokens = True
    of = byte_characters()
    out, holders = [], Counter()
    for text in texts:
        ids_a = ids_b = []
        if text:
            ids_a = ta.encode(" " + text, add_special_tokens=False).ids
            ids_b = tb.encode(text)
            a = [bytes(of[c] for c in ta.id_to_token(i)) for i in ids_a]
            b = [bytes([int(tb.id_to_piece(i)[3:5], 16)]) if tb.is_byte(i)
                 else tb.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
            raw = (" " + text).encode()
            if b"".join(a) != raw or b"".join(b) != raw:
                ids_a = ids_b = []
        if not ids_a:
            out.append((0, 0, 0, [], ""))
            continue
        spans = []
        for tokens in (a, b):
            at, s = 0, []
            for t in tokens:
                s.append((at, at + len(t)))
                at += len(t)
            spans.append(s)
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, last = [], 0
        for c in cuts:
            side = [[str(i) for i, (x, y) in zip(ids, s) if last < y <= c] for ids, s in zip((ids_a, ids_b), spans)]
            groups.append("|".join(",".join(x) for x in side))
            last = c
        found, j0 = [], 0
        for i, (x, y) in zip(ids_a, spans[0]):
            while spans[1][j0][1] <= x:
                j0 += 1
            j = j0
            while j < len(ids_b) and spans[1][j][0] < y:
                found.append((i, ids_b[j]))
                j += 1
        holders.update(set(found))
        out.append((len(ids_a), len(ids_b), len(cuts), found, ";".join(groups)))
    top = {}
    for (a, _), n in holders.items():
        top[a] = max(top.get(a, 0), n)
    return [(n_a, n_b, n_g, len(found), sum(holders[x] == top[x[0]] for x in found), sum(holders[x] for x in found), g)
            for n_a, n_b, n_g, found, g in out]


def run(docs, **options):
    aligned = align(docs, A, B, **options)
    rows = aligned.join(link_counts(aligned), "key").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").cast("string").alias("groups"))
    return sorted((tuple(r) for r in rows.collect()), key=str)


@pytest.mark.parametrize("block_bytes", [8 << 20, 2000, 1])
def test_matches_definition(spark, block_bytes):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    want = sorted(((i, *w) for i, w in enumerate(brute(TEXTS))), key=str)
    assert run(docs, block_bytes=block_bytes) == want


def test_odd_rows(spark):
    """Repeated and null ids, clashing column names, no rows."""
    rows = [(1, "one two", 5, "k"), (1, "one two", 6, None), (None, "one", 7, "z"), (None, None, 8, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key int, block string")
    want = sorted(((r[0], *w) for r, w in zip(rows, brute([r[1] for r in rows]))), key=str)
    assert run(docs) == want
    assert run(docs.limit(0)) == []


def test_words_like_corpus_texts(spark, prose):
    texts = [prose(s, 300, 90) + " " + "".join(chr(97 + (s * k) % 26) for k in range(60)) for s in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert run(docs, block_bytes=5000) == sorted(((i, *w) for i, w in enumerate(brute(texts))), key=str)


def test_table_starts_anew(monkeypatch):
    """A worker whose table is full forgets it without changing results."""
    from starmart.llm import alignment

    monkeypatch.setattr(alignment, "TABLE_PARTS", 3)
    aligner = Aligner(A, B)
    raws = [b" " + t.encode() for t in TEXTS if t]
    first = aligner.block(raws[:9])
    aligner.block(raws[9:])
    again = aligner.block(raws[:9])
    assert (first["counts"] == again["counts"]).all() and first["groups"] == again["groups"]
    assert len(aligner.text) < 200


def test_query_columns(spark, tmp_path):
    from starmart.llm.queries import QUERIES

    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in QUERIES["op11_token_alignment"](spark, str(tmp_path)).collect()}
    for i, w in enumerate(brute(TEXTS)):
        digest = hashlib.sha256(w[6].encode()).hexdigest() if w[6] else ""
        r = got[i]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == (*w[:6], digest)
