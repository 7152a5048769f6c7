"""Two-pass shuffle: the law, the order by its definition, odd rows."""

import math
import zlib

import numpy as np
import pytest

from starmart.llm import sharding as S


def test_fisher_yates_by_definition():
    for n in (0, 1, 2, 7, 500):
        assert sorted(S.fisher_yates(n, 3, 1).tolist()) == list(range(n))
    assert S.fisher_yates(50, 3, 1).tolist() != S.fisher_yates(50, 3, 2).tolist()
    # every order of three things is as likely
    seen = {}
    for b in range(6000):
        seen[tuple(S.fisher_yates(3, 9, b))] = seen.get(tuple(S.fisher_yates(3, 9, b)), 0) + 1
    assert len(seen) == 6 and all(abs(c - 1000) < 5 * math.sqrt(1000) for c in seen.values())


def placed(docs, shards=8, **options):
    rows = S.shuffle_shards(docs, shards, **options).collect()
    return [(r.row.doc_id, r.row.text, r["size"], r.shard, r.slot) for r in rows]


def check_law(rows, n, shards=8):
    assert len(rows) == n
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r[4])
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == n and set(by) <= set(range(shards))
    assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())


@pytest.mark.parametrize("n", [1, 7, 8, 9, 203])
def test_counts_and_slots(spark, prose, n):
    texts = [prose(i, 1 + i % 30) for i in range(n)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = placed(docs, bucket_bytes=700)
    check_law(rows, n)
    assert sorted((r[0], r[1]) for r in rows) == sorted(enumerate(texts))
    assert all(r[2] == len(r[1].encode()) + 1 for r in rows)


def test_order_by_definition(spark, prose):
    """The order is the buckets in a row, each shuffled, however rows are dealt."""
    texts = [prose(i, 5) for i in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scattered = [r.asDict() for r in S.scatter(docs, 4, 500, "doc_id", "text").collect()]
    order = []
    for b in sorted({r["bucket"] for r in scattered}):
        rows = sorted((r for r in scattered if r["bucket"] == b), key=lambda r: (r["hash"], r["hash2"]))
        order += [rows[i]["row"].doc_id for i in S.fisher_yates(len(rows), 4, b)]
    assert len({r["bucket"] for r in scattered}) > 3
    want = {d: (p * 3 // 120, p - 40 * (p * 3 // 120)) for p, d in enumerate(order)}
    for parts in (1, 5):
        rows = placed(docs.repartition(parts), 3, seed=4, bucket_bytes=500)
        assert {r[0]: (r[3], r[4]) for r in rows} == want
    assert {r[0]: (r[3], r[4]) for r in placed(docs, 3, seed=5, bucket_bytes=500)} != want


def test_order_is_uniform(spark):
    """Ids and positions are not correlated, nor are neighbours."""
    docs = spark.range(4000).selectExpr("id AS doc_id", "cast(id AS string) AS text")
    rows = sorted(placed(docs, 4, bucket_bytes=3000), key=lambda r: (r[3], r[4]))
    ids = np.array([r[0] for r in rows], float)
    assert abs(np.corrcoef(ids, np.arange(4000))[0, 1]) < 0.08
    assert abs(np.corrcoef(ids[1:], ids[:-1])[0, 1]) < 0.08


def test_rows_alike_are_spread(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT", 8)
    rows = [(1, "same text")] * 300 + [(None, None)] * 200 + [(i, f"t{i}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    buckets = {}
    for r in S.scatter(docs, 1, 300, "doc_id", "text").collect():
        if r.row.doc_id == 1:
            buckets[r.bucket] = buckets.get(r.bucket, 0) + 1
    assert len(buckets) > 5 and max(buckets.values()) < 100
    got = placed(docs, bucket_bytes=300)
    check_law(got, 600)
    assert sorted(map(str, ((r[0], r[1]) for r in got))) == sorted(map(str, rows))


def test_odd_rows(spark):
    """Nulls, empty and long texts, repeated ids, clashing names, no rows."""
    rows = [(1, None, 5, "a"), (1, "", 6, "b"), (None, "ü" * 70000, 7, None), (2, "x", None, "d"), (2, "x", None, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int, bucket string")
    out = S.shuffle_shards(docs, 8).collect()
    check_law([(None, None, None, r.shard, r.slot) for r in out], 5)
    assert sorted(map(str, (tuple(r.row) for r in out))) == sorted(map(str, rows))
    assert sorted(r["size"] for r in out) == [1, 1, 2, 2, 140001]
    assert S.shuffle_shards(docs.limit(0), 8).collect() == []


def test_written_shards(spark, tmp_path, prose):
    docs = spark.createDataFrame([(i, prose(i, 9)) for i in range(60)], "doc_id long, text string")
    out = S.shuffle_shards(docs, 4, bucket_bytes=500)
    want = {(r.shard, r.slot): r.row.text for r in out.collect()}
    S.write_shards(out, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards")).collect()
    assert {(r.shard, r.slot): r.row.text for r in back} == want
    assert len(list((tmp_path / "shards").glob("shard=*"))) == 4


def test_query_columns(spark, tmp_path):
    from starmart.llm.queries import QUERIES

    rows = [(i, None if i % 9 == 0 else f"text é {i % 5}") for i in range(50)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = QUERIES["op13_shuffle_shards"](spark, str(tmp_path)).collect()
    check_law([(None, None, None, r.shard, r.slot) for r in out], 50)
    for r in out:
        raw = (dict(rows)[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
