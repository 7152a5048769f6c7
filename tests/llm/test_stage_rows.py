"""Pipeline stages on odd rows: clashing names, repeats, nulls, long texts,
no rows."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C

SF = "/root/testdata/sf0.001"
CLASH = ["_p", "_key", "_rest", "_leaf", "_host", "_c", "_row", "_n_words", "block", "_salt", "_llr", "_score", "_epoch",
         "row", "mark", "id", "epoch", "text_", "place"]
GOOD = ("The committee met in the old hall and spoke about the harvest, the roads and the price of grain for the winter. "
        "Nobody had expected a long debate, but the mayor asked every member for a view.")


def texts():
    return [
        (1, GOOD, "en", "s1", 5), (2, GOOD, "en", "s1", 5), (2, GOOD, "en", "s1", 5), (2, "Another text about ships. " + GOOD[:90], "en", "s2", 7),
        (None, GOOD, None, None, None), (None, GOOD, None, None, None), (3, None, "en", "s1", 0), (4, "", "de", "s3", 0),
        (5, " \n ", "de", None, 3), (6, " ".join(f"word{i * i % 977}" for i in range(30000)), "en", "s2", 1),
        (7, "three word text", None, "s1", None)]


@pytest.fixture(scope="module")
def docs(spark):
    plain = spark.createDataFrame(texts(), "doc_id long, text string, lang string, source string, n_chars long")
    return plain.withColumns({c: F.lit(f"own {i}") for i, c in enumerate(CLASH)})


@pytest.mark.parametrize("name,stage", C.STAGES[:4])
def test_columns_stay_as_they_are(spark, docs, name, stage):
    out = stage(spark, docs, SF)
    assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
    rows = out.collect()
    assert rows and all(r[c] == f"own {i}" for r in rows for i, c in enumerate(CLASH))
    before = {(r.doc_id, r.text) for r in docs.collect()}
    if name != "substring_dedup":
        assert {(r.doc_id, r.text) for r in rows} <= before


def test_packing_takes_odd_rows(spark, docs):
    pieces = C.packing_stage(spark, docs, SF).collect()
    assert sum(r.length for r in pieces) == sum(r.doc_tokens for r in pieces if r.start == 0)
    assert sum(r.start == 0 for r in pieces) == docs.count()


def test_ngram_stage_keeps_other_texts_of_an_id(spark):
    cols = "doc_id long, text string, lang string, source string, n_chars long"
    a, b = GOOD, "Quite a different text that nobody else has written down anywhere in this small table of rows."
    rows = [(3, a, "en", "s", 1), (5, a, "en", "s", 1), (5, b, "en", "s", 1), (5, b, "en", "s", 1), (None, a, "en", "s", 1),
            (9, None, "en", "s", 1)]
    out = C.ngram_stage(spark, spark.createDataFrame(rows, cols), SF).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in out) == sorted([("3", a), ("5", b), ("None", a), ("9", "None")])


def test_substring_stage_counts_what_is_left(spark, docs):
    got = {}
    for r in C.substring_stage(spark, docs, SF).collect():
        got.setdefault(r.doc_id, []).append((r.text, r.n_chars))
    assert got[1] == [(GOOD, 5)] and got[3] == [(None, 0)] and got[4] == [("", 0)] and got[5] == [(" \n ", 3)]
    # id 2 repeats id 1's text whole: those rows go, its other text loses what it shares
    assert len(got[2]) == 1 and got[2][0][0] == "Another text about ships." and got[2][0][1] == 25


@pytest.mark.parametrize("name,stage", C.STAGES)
def test_no_rows(spark, docs, name, stage):
    out = stage(spark, docs.limit(0), SF)
    assert out.collect() == []
    if name != "packing":
        assert out.columns == docs.columns


def test_words_are_counted_as_split(spark):
    import pyarrow as pa

    from starmart.llm.mixing import count_words

    some = ["a b", None, "", "  x  ", "\t\n", "ä ö\u00a0ü", "one", "two\x0bthree\x0cfour", " "]
    want = [len((t or "").encode().split()) for t in some]
    assert count_words(pa.array(some)).tolist() == want
    assert count_words(pa.array([], pa.string())).tolist() == []
