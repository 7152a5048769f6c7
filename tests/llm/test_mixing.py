import collections
import random

import pytest
from pyspark.sql import functions as F

from starmart.llm.mixing import mix, water_fill


def fill(items, budget):
    """Water filling of (name, weight, cap) by definition."""
    left, weight, out = budget, sum(w for _, w, _ in items), {}
    for name, w, c in sorted(items, key=lambda x: x[2] / x[1]):
        out[name] = min(c, left * w / weight)
        left -= out[name]
        weight -= w
    return out


@pytest.mark.parametrize("budget", [10.0, 500.0, 3000.0, 1e6])
def test_water_fill(spark, budget):
    g = random.Random(1)
    items = [(f"n{i}", g.choice([0.5, 1.0, 2.0, 7.0]), float(g.randrange(1, 300))) for i in range(30)]
    items += [("t0", 1.0, 50.0), ("t1", 1.0, 50.0)]
    df = spark.createDataFrame([("p", n, w, c, budget) for n, w, c in items], "parent string, node string, weight double, cap double, budget double")
    got = {r.node: r.share for r in water_fill(df).collect()}
    assert got == pytest.approx(fill(items, budget))


def corpus(n=400, seed=3):
    g = random.Random(seed)
    return [(i, " ".join("w" * g.randrange(1, 5) for _ in range(g.randrange(0, 40))), g.choice(["en", "de", None]),
             g.choice(["a0", "a1", "b0"] + ["hot"] * 4)) for i in range(n)]


SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.mark.parametrize("share,epochs", [(0.3, 1), (0.9, 1), (0.5, 3), (1.7, 2)])
def test_budgets_and_prefixes(spark, share, epochs):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    domain = F.substring("source", 1, 1)
    weights = {"a": 2.0, "a/en": 3.0, "h/de": 0.5}
    taken = mix(docs, domain, F.col("lang"), F.col("source"), total_share=share, weights=weights, max_epochs=epochs).collect()
    tokens = {r[0]: len(r[1].split()) for r in rows}
    leaf = {r[0]: (r[3][0], r[2], r[3]) for r in rows}
    have = collections.Counter()
    for i, t in tokens.items():
        have[leaf[i]] += t
    got, copies = collections.Counter(), collections.Counter()
    for r in taken:
        got[leaf[r.doc_id]] += tokens[r.doc_id]
        copies[r.doc_id] += 1
        assert 0 <= r._epoch < epochs
    caps = {k: v * epochs for k, v in have.items()}

    def level(keys, budget, depth):
        groups = collections.defaultdict(list)
        for k in keys:
            groups[k[depth]].append(k)
        shares = fill([(n, weights.get("/".join(x or "" for x in ks[0][:depth + 1]), 1.0), sum(caps[k] for k in ks))
                       for n, ks in groups.items()], budget)
        return {ks[0]: shares[n] for n, ks in groups.items()} if depth == 2 else {
            k: v for n, ks in groups.items() for k, v in level(ks, shares[n], depth + 1).items()}

    quota = level(list(caps), sum(have.values()) * share, 0)
    longest = max(tokens.values())
    for k, q in quota.items():
        assert q - longest - 1 <= got[k] <= q + 1e-6
        whole = int((q + 1e-6) // have[k])
        own = [copies[i] for i in leaf if leaf[i] == k]
        assert set(own) <= {whole, whole + 1}


def test_order_is_seeded(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)

    def take(seed):
        return {r.doc_id for r in mix(docs, F.lit("d"), F.col("lang"), F.col("source"), total_share=0.4, max_epochs=1, seed=seed).collect()}

    assert take(1) == take(1) and take(1) != take(2)


def test_edges(spark):
    rows = [(1, None, None, None), (1, None, None, None), (None, "a b", "en", "s"), (2, "", "en", "s"), (3, "a b c", "en", "s")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", tokens int")
    out = mix(docs, F.lit(None).cast("string"), F.col("lang"), F.col("source"), total_share=1.0, max_epochs=1)
    assert out.columns == [*docs.columns, "_epoch"]
    assert {r.doc_id for r in out.collect()} >= {3, None, 2}
    assert mix(docs.limit(0), F.lit("d"), F.col("lang"), F.col("source")).count() == 0
