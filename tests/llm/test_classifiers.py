"""Quality, toxicity and language: held-out accuracy and edge cases."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starmart.llm import language_id as L
from starmart.llm import quality as Q
from starmart.llm import sample, toxicity as T

TONGUES = {"aa": "na ka ta ra la ma".split(), "bb": "schi pfo grü ßen ach tz".split(), "cc": "iou eau é ère oi ué".split()}


def sentence(g, lang, n):
    return " ".join("".join(g.choice(TONGUES[lang]) for _ in range(g.randrange(1, 4))) for _ in range(n))


def corpus(n=240, seed=0):
    """doc_id, text, lang, source, quality, toxic."""
    g = random.Random(seed)
    rows = []
    for i in range(n):
        lang = g.choice(list(TONGUES))
        text, good, toxic = sentence(g, lang, g.randrange(20, 80)), 1, 0
        if g.random() < 0.3:
            good = 0
            text = text.upper().replace(" ", "!! ") if g.random() < 0.5 else text.replace(" ", "$$$ ")
        if g.random() < 0.3:
            toxic = 1
            words = text.split()
            words.insert(g.randrange(len(words)), "zwurbel")
            text = " ".join(words)
        rows.append((i, text, lang, f"src{i % 5}", good, toxic))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, quality int, toxic int"


def test_sample_is_bounded_and_stable(spark):
    rows = spark.range(20000).select(F.col("id").alias("doc_id"))
    n = sample.by_hash(rows, "doc_id", 1000).count()
    assert 850 < n < 1150 and n == sample.by_hash(rows, "doc_id", 1000).count()
    assert sample.by_hash(rows, "doc_id", 20000).count() == 20000


def test_fold(spark):
    got = {r.i: r.f for r in spark.createDataFrame([(5,), (17,), (None,)], "i long").select("i", sample.fold("i", 4).alias("f")).collect()}
    assert got == {5: zlib.crc32(b"5") % 4, 17: zlib.crc32(b"17") % 4, None: None}


def test_toxicity_held_out(spark):
    rows = spark.createDataFrame(corpus(), SCHEMA)
    labels = rows.filter("doc_id % 2 = 0").select("doc_id", "toxic")
    out = T.score(rows, T.fit(rows, labels, min_z=3.0)).join(rows.select("doc_id", "toxic"), "doc_id").collect()
    held = [r for r in out if r.doc_id % 2]
    assert np.mean([r.predicted == r.toxic for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)


def test_toxicity_keeps_n_grams_of_rarer_insults(spark):
    """A frequent long passage has over 4,096 n-grams of larger z than the
    rarer insult's; documents with only the insult are still found."""
    g = random.Random(5)
    passage = "".join(g.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(2000))
    rows = []
    for i in range(900):
        words = sentence(g, "aa", 20)
        kind = i % 12  # a half is clean, a third has the passage, a sixth the insult
        rows.append((i, words + (" " + passage if 6 <= kind < 10 else " zwurbel " + sentence(g, "aa", 3) if kind >= 10 else ""),
                     int(kind >= 6)))
    rows = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = T.fit(rows.select("doc_id", "text"), rows.filter("doc_id < 600").select("doc_id", "toxic"))
    assert len(model.feature) > 4096
    out = T.score(rows, model).filter("doc_id >= 600").collect()
    assert all(r.predicted == int(r.doc_id % 12 >= 6) for r in out)


def test_toxicity_edges(spark):
    rows = spark.createDataFrame([(1, None, 0), (2, "", 1), (None, "x", 1), (3, "word " * 3000, None), (3, "again", 1)],
                                 "doc_id long, text string, score int")
    none = T.fit(rows.select("doc_id", "text"), spark.createDataFrame([], "doc_id long, toxic int"))
    out = T.score(rows, none).collect()
    assert len(out) == 5 and all(r.score == 0 or r.score < 1e-9 for r in out)
    one = spark.createDataFrame([(2, 1), (3, None), (None, 1), (2, 0)], "doc_id long, toxic int")
    assert all(r.score > 0.99 for r in T.score(rows, T.fit(rows.select("doc_id", "text"), one)).collect())
    assert T.score(rows.limit(0), none).count() == 0


def test_grams_by_definition():
    texts = ["Ab  c", "", None, "ab c"]
    seen = {}
    for d, g in T.grams(texts):
        for i, x in zip(d.tolist(), g.tolist()):
            seen.setdefault(i, []).append(x)
    assert seen[0] == seen[3]  # case and blanks do not count
    assert len(seen[0]) == sum(len(" ab c ") - n + 1 for n in T.SIZES)
    d, g = T.present(texts, np.ones(1 << T.BITS, bool))
    assert (g[d == 0] == g[d == 3]).all() and len(set(g[d == 0])) == len(g[d == 0])


def test_language_held_out(spark):
    rows = spark.createDataFrame(corpus(), SCHEMA)
    net = L.fit(rows.filter("doc_id % 2 = 0"), epochs=12)
    out = L.predict(rows, net).join(rows.select("doc_id", "lang"), "doc_id").filter("doc_id % 2 = 1").collect()
    assert np.mean([r.lang_pred == r.lang for r in out]) > 0.95
    assert all(0 <= r.score <= 1 for r in out)


def test_language_edges(spark):
    rows = spark.createDataFrame(corpus(60), SCHEMA)
    net = L.fit(rows.withColumn("lang", F.when(F.col("doc_id") > 5, F.col("lang"))), epochs=1)
    odd = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "12 !? 34", 0), (4, "ÉÉ", 0), (None, "schi " * 5000, 0)],
                                "doc_id long, text string, score int")
    got = {r.doc_id: r.lang_pred for r in L.predict(odd, net).collect()}
    assert got[1] == got[2] == got[3] == "und" and got[4] in TONGUES and got[None] in TONGUES
    assert {r.lang_pred for r in L.predict(odd, L.fit(rows.limit(0))).collect()} == {"und"}
    assert L.predict(odd.limit(0), net).count() == 0


def test_network_gradient():
    """The training step follows the numerical gradient of the loss."""
    g = np.random.default_rng(0)
    net = L.Network.new(["a", "b"], 1)
    for k in net.params:
        net.params[k] = net.params[k].astype(np.float64)
    x, y = g.integers(1, 256, (6, L.WINDOW)).astype(np.uint8), np.array([0, 1, 0, 1, 1, 0])

    def loss():
        return -np.log(net.forward(x)[0][np.arange(6), y]).mean()

    before = loss()
    net.train(x, y, 1, 0, rate=1e-3)
    assert loss() < before


def test_windows_cover_the_whole_text():
    t = bytes(range(1, 251)) * 3
    assert L.cut(t).ravel()[:len(t)].tobytes() == t and L.cut(t).shape == (3, L.WINDOW) and L.cut(b"").shape == (1, L.WINDOW)


def test_quality_held_out(spark):
    rows = spark.createDataFrame(corpus(), SCHEMA)
    model = Q.fit(rows, rows.filter("doc_id % 2 = 0").select("doc_id", "quality"))
    for carry in (True, False):
        out = Q.score(rows, model, F.col("source"), F.col("lang"), carry=carry).collect()
        held = [r for r in out if r.doc_id % 2]
        assert np.mean([r._keep == (r.quality == 1) for r in held]) > 0.95
        assert all(("text" in r.asDict()) == carry for r in out)


def test_quality_posterior_by_definition(spark):
    """Against the same grouped shrinkage in plain Python."""
    rows = spark.createDataFrame(corpus(90), SCHEMA)
    model = Q.fit(rows, rows.filter("doc_id % 3 = 0").select("doc_id", "quality"))
    data = [r for r in rows.collect()]
    llr = model.evidence(Q.features(pa.array([r.text for r in data])))
    p = 1 / (1 + np.exp(-(llr + np.log(model.base / (1 - model.base)))))
    host, path = [r.source for r in data], [(r.source, r.lang) for r in data]

    def sums(keys):
        out = {}
        for k, v in zip(keys, p):
            n, s = out.get(k, (0, 0.0))
            out[k] = (n + 1, s + v)
        return out

    hosts, paths = sums(host), sums(path)
    mean = p.mean()
    k1 = Q._strength(mean, np.mean([(s / n - mean) ** 2 for n, s in hosts.values()]),
                     mean * (1 - mean) * np.mean([1 / n for n, _ in hosts.values()]))
    rate = {h: (k1 * mean + s) / (k1 + n) for h, (n, s) in hosts.items()}
    k2 = Q._strength(mean, np.mean([(s / n - rate[k[0]]) ** 2 for k, (n, s) in paths.items()]),
                     mean * (1 - mean) * np.mean([1 / n for n, _ in paths.values()]))
    want = {}
    for r, e, v, h, k in zip(data, llr, p, host, path):
        n, s = paths[k]
        m = np.clip((k2 * rate[h] + s - v) / (k2 + n - 1), 1e-6, 1 - 1e-6)
        want[r.doc_id] = 1 / (1 + np.exp(-(e + np.log(m / (1 - m)))))
    got = {r.doc_id: r._score for r in Q.score(rows, model, F.col("source"), F.col("lang")).collect()}
    assert got == pytest.approx(want, rel=1e-9, abs=1e-12)


def test_quality_writes_evidence_and_sites_only(spark, monkeypatch):
    """Each table written over a shuffle costs a file per partition."""
    rows, written, write = spark.createDataFrame(corpus(60), SCHEMA), [], Q.write_table

    def noted(df, name="t", codec=None):
        written.append(name)
        return write(df, name, codec)

    monkeypatch.setattr(Q, "write_table", noted)
    assert Q.score(rows, None, F.col("source"), F.col("lang")).count() == 60
    assert written == ["evidence", "sites"]


def test_quality_fit_does_not_depend_on_the_order_of_rows(spark):
    """Repeated ids and labels too."""
    data = corpus(40) + [(i, t + " " + t, *rest) for i, t, *rest in corpus(20, seed=1)]
    labels = spark.createDataFrame([(r[0], r[4]) for r in data], "doc_id long, quality int")
    one, two = (Q.fit(spark.createDataFrame(d, SCHEMA).repartition(n), labels) for d, n in ((data, 1), (data[::-1], 7)))
    assert one.coef.tolist() == two.coef.tolist() and one.bias == two.bias


def test_quality_edges(spark):
    rows = spark.createDataFrame([(1, None, None, None), (2, " \n", "s", "x"), (None, "some words here", None, "y"),
                                  (3, "Fine " * 5000, "s", "x"), (3, "Fine words", "s", "x")],
                                 "doc_id long, text string, source string, _extra string")
    out = Q.score(rows, None, F.col("source"), F.lit(None)).collect()
    assert len(out) == 5 and {r.doc_id: r._keep for r in out if r.doc_id in (1, 2)} == {1: False, 2: False}
    assert Q.score(rows.limit(0), None, F.col("source"), F.lit(None)).count() == 0
    assert Q.fit(rows, spark.createDataFrame([(3, 1)], "doc_id long, quality int")) is None
