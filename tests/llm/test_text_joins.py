"""Substring dedup, n-gram join, components and the counted join."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import exchange, ngram_join as N
from starmart.llm import words as W
from starmart.llm.graph import components
from starmart.llm.joins import join_counted
from starmart.llm.substring_dedup import covers, dedup_substrings

_LAST = 1 << 62


def brute_substrings(rows, k=13):
    """(n_words, n_removed, kept) per row, by definition."""
    words = [(i if i is not None else _LAST, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, w in words:
        for s in range(len(w) - k + 1):
            g = tuple(w[s:s + k])
            least[g] = min(i, least.get(g, i))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for s in range(len(w) - k + 1):
            if least[tuple(w[s:s + k])] < i:
                gone[s:s + k] = [True] * k
        kept = b" ".join(x for x, g in zip(w, gone) if not g).decode()
        out.append((len(w), sum(gone), kept))
    return out


def passages(prose, n=40):
    """Documents with shared, shifted and repeated passages."""
    g = random.Random(5)
    shared = [prose(f"p{i}", 30) for i in range(4)]
    texts = []
    for i in range(n):
        own = prose(i, g.randrange(5, 60)).split()
        at = g.randrange(len(own))
        texts.append(" ".join(own[:at] + g.choice(shared).split()[g.randrange(10):] + own[at:]))
    return texts + [texts[0], texts[1] + " tail", "a " * 40, "a " * 30, "", None, "one two", shared[0][:60]]


@pytest.mark.parametrize("small", [False, True])
def test_substrings_against_brute_force(spark, make_docs, prose, monkeypatch, small):
    if small:
        monkeypatch.setattr(exchange, "BLOCK_BYTES", 600)
        monkeypatch.setattr(exchange, "RANGE_ITEMS", 64)
    texts = passages(prose)
    got = {r.doc_id: (r._n_words, r._n_removed, r.text) for r in dedup_substrings(make_docs(texts)).collect()}
    want = brute_substrings(list(enumerate(texts)))
    assert [got[i] for i in range(len(texts))] == want
    assert sum(w[1] for w in want) > 500


def test_substrings_null_and_repeated_ids_and_clashing_names(spark, prose):
    a, b = prose(1, 40), prose(2, 40)
    rows = [(3, a, "x"), (3, a, "y"), (None, a, "z"), (None, b, "n"), (7, b, "m"), (9, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block string")
    got = sorted(((r.doc_id, r.block, r._n_removed) for r in dedup_substrings(docs, as_words=False).collect()), key=repr)
    assert got == sorted([(3, "x", 0), (3, "y", 0), (None, "z", 40), (None, "n", 40), (7, "m", 0), (9, None, 0)], key=repr)
    kept = dedup_substrings(docs, as_words=False)
    assert kept.columns[:3] == docs.columns and kept.filter("doc_id = 9").first().text is None


def test_substrings_of_an_empty_table(spark, make_docs):
    assert dedup_substrings(make_docs([])).count() == 0


def test_cover():
    assert covers(7, (0, 1, 3)) and covers(13, (0, 1, 3, 9)) and not covers(8, (0, 1, 3))


def brute_components(texts, n=4, percent=85):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    label = list(range(len(texts)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = find(i), find(j)
                label[max(x, y)] = min(x, y)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def near_copies(prose, groups=6, copies=9):
    g = random.Random(9)
    texts = []
    for i in range(groups):
        base = prose(i, 30 + 40 * i).split()
        for _ in range(copies):
            w = list(base)
            for _ in range(g.randrange(0, 1 + len(w) // 40)):
                w[g.randrange(len(w))] = "edit%d" % g.randrange(50)
            texts.append(" ".join(w))
    g.shuffle(texts)
    return texts + [texts[3].upper(), texts[5].replace(" ", "\n "), "", None, " \t", "one two", "ONE  two", "one two three"]


@pytest.mark.parametrize("rare,classes,cell", [(512, 32, 128), (2, 4, 4)])
def test_ngram_join_against_brute_force(spark, make_docs, prose, monkeypatch, rare, classes, cell):
    monkeypatch.setattr(N, "CELL", cell)
    monkeypatch.setattr(exchange, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(exchange, "RANGE_ITEMS", 256)
    texts = near_copies(prose)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           N.ngram_join(make_docs(texts), rare=rare, classes=classes).collect()}
    want = brute_components(texts)
    assert [got[i] for i in range(len(texts))] == want
    assert len({c for _, c in want}) < len(texts) - 10


def test_signatures_of_linked_sets_meet():
    """Every pair over the threshold shares a signature, whatever the counts."""
    g = np.random.default_rng(1)
    for trial in range(200):
        n = int(g.integers(5, 120))
        universe = W.mix(np.arange(trial * 1000, trial * 1000 + 400, dtype=np.uint64))
        count = g.choice([2, 3, 40, 900], 400, p=[0.3, 0.2, 0.2, 0.3])
        a = np.sort(g.choice(400, n, replace=False))
        b = a[np.sort(g.choice(n, max(1, n - int(g.integers(0, 1 + n // 8))), replace=False))]
        extra = np.setdiff1d(np.arange(400), a)[:int(g.integers(0, 1 + n // 12))]
        b = np.union1d(b, extra)
        common = len(np.intersect1d(a, b))
        if 100 * common < 85 * (len(a) + len(b) - common):
            continue
        s = [N.signatures(np.sort(universe[x]), count[x][np.argsort(universe[x])], 85, rare=10, classes=4) for x in (a, b)]
        assert len(np.intersect1d(*s)), (n, common)


def test_ngram_join_null_ids_and_empty(spark, make_docs, prose):
    a = prose(1, 40)
    rows = [(None, a), (5, a), (4, a + " x"), (None, prose(2, 20)), (5, a), (8, prose(3, 30))]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in
                  N.ngram_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == sorted([(None, 37, None), (5, 37, 4), (4, 38, 4), (None, 17, None), (5, 37, 4), (8, 27, 8)], key=repr)
    assert N.ngram_join(make_docs([])).count() == 0


def test_components(spark):
    g = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, 500 + i) for i in range(1, 60)] + [(7, 7)]
    edges += [(g.randrange(1000, 1200), g.randrange(1000, 1200)) for _ in range(90)]
    label = {}

    def find(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for u, v in edges:
        x, y = find(u), find(v)
        label[max(x, y)] = min(x, y)
    want = {x: find(x) for e in edges if e[0] != e[1] for x in e}
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_join_counted_keeps_every_row(spark):
    big = spark.range(5000).select(F.col("id").alias("r"), F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 7 == 0, None)
                                   .otherwise(F.col("id") % 2000).cast("long").alias("k"))
    small = big.filter("k is not null").groupBy("k").agg(F.count("*").alias("c"), (F.max("k") * 10).alias("v")).filter("k < 1500")
    for how in ("left", "inner"):
        got = collections.Counter(tuple(r) for r in join_counted(big, small, "k", "c", "r", how).collect())
        want = collections.Counter(tuple(r) for r in big.join(small.select("k", "v"), "k", how).select("r", "k", "v").collect())
        assert got == want


def test_counted_join_spreads_hot_keys(spark):
    """Three quarters of the rows share a key; without broadcasts by size and
    without skew handling no task gets over twice the median."""
    big = spark.range(0, 40000, 1, 4).selectExpr("id AS r", "CASE WHEN id % 4 > 0 THEN 7 ELSE id % 3000 END AS k")
    small = big.groupBy("k").agg(F.count("*").alias("c"), F.max("r").alias("v"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = join_counted(big, small, "k", "c", "r").withColumn("task", F.spark_partition_id())
        held = sorted(r.n for r in out.groupBy("task").agg(F.count("v").alias("n")).collect())
        assert sum(held) == 40000 and len(held) == 8 and held[-1] <= 2 * held[4]
        assert out.filter("v IS NULL").count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
