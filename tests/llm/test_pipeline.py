"""The corpus pipeline, stage by stage against brute force."""

import collections

import pytest

import corpus_pipeline as C
from starmart.llm.queries import QUERIES, SQL
from starmart.llm.sample import fold  # noqa: F401  (imported by the queries)

from .test_text_joins import brute_components, brute_substrings

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)
    assert [n for n, _ in C.STAGES] == ["quality", "ngram_join", "substring_dedup", "mixing", "packing"]


@pytest.fixture(scope="module")
def stages(spark):
    from starmart.llm.common import ship_package, table, write_table

    ship_package(spark)
    docs = table(spark, SF, "documents")
    out = [docs]
    for name, stage in C.STAGES:
        docs = write_table(stage(spark, docs, SF), name)
        out.append(docs)
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[1:5])


def test_quality_keeps_the_good(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, kept = rows(stages[0]), rows(stages[1])
    good = [i for i in before if labels.get(i) == 1]
    bad = [i for i in before if labels.get(i) == 0]
    assert sum(i in kept for i in good) >= 0.98 * len(good) and sum(i in kept for i in bad) <= 0.1 * len(bad)
    assert all(kept[i] == before[i] for i in kept)


def test_one_document_of_each_group_stays(stages):
    before, after = rows(stages[1]), rows(stages[2])
    ids = sorted(before)
    label = brute_components([before[i].text for i in ids], n=5, percent=80)
    assert set(after) == {i for k, i in enumerate(ids) if label[k][1] == k}


def test_substrings_go(stages):
    before, after = rows(stages[2]), rows(stages[3])
    ids = sorted(before)
    want = dict(zip(ids, brute_substrings([(i, before[i].text) for i in ids])))
    assert set(after) == {i for i in ids if not want[i][1] or want[i][1] < want[i][0]}
    for i, r in after.items():
        assert r.text == (want[i][2] if want[i][1] else before[i].text)
        assert r.n_chars == (len(r.text) if want[i][1] else before[i].n_chars)


def test_mixing_takes_its_share(stages):
    before, after = rows(stages[3]), rows(stages[4])
    words = {i: len((r.text or "").encode().split()) for i, r in before.items()}
    assert set(after) <= set(before) and all(after[i] == before[i] for i in after)
    total = sum(words.values())
    leaves = len({(r.source, r.lang) for r in before.values()})
    share = sum(words[i] for i in after)
    assert share <= C.MIX_SHARE * total + 1
    assert share >= C.MIX_SHARE * total - leaves * max(words.values()) or len(after) > 0.5 * len(before)


def test_packing_holds_what_is_left(stages):
    pieces = collections.Counter()
    size = {}
    for r in stages[5].collect():
        pieces[r.doc_id] += r.length
        size[r.doc_id] = r.doc_tokens
    assert set(pieces) == set(rows(stages[4])) and all(pieces[i] == size[i] for i in size)
