"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import pytest
from pyspark.sql import functions as F

from usagelens.llm import (
    decontaminate,
    fingerprints,
    langid,
    line_dedup,
    mixing,
    ngram_join,
    pii,
    sharding,
    toxicity,
    url_filter,
)
from usagelens.llm.common import LlmError

LONG = "word" * 5 + " " + "alpha beta gamma delta " * 8_000
ROWS = [
    (1, "one two three four five six", "en", "a"),
    (1, "one two three four five six", "en", "a"),
    (1, "another text with the same id", None, "b"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (None, "no id here", "de", None),
    (None, "no id here", "de", None),
    (4, "1234567890 !!! \n\n\t", "en", "c"),
    (5, LONG, "en", "a"),
    (6, "É ü \U0001f600 \ue000 \ue001 mixed\x00zero", "fr", "a"),
    (7, "9" * 30_000 + " a@" + "b." * 3_000 + "c +1" + "(" * 5_000 + " " + "1 " * 20_000, "en", "b"),
]
CLASH = (
    "size taken place key rank shard slot row id text_hash score spans items start bucket _bucket _value range own extra "
    "hash kept class_id n_links predicted toxic quota block n_words source_size level times"
).split()


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    return rows.withColumn("n_chars", F.length("text").cast("long")).withColumns({c: F.lit("x") for c in CLASH}).cache()


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, "two three"), (2, None), (3, ""), (None, "one two"), (4, "here"), (5, "two three")]
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("doc_id", F.lit("x"))


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 0), (1, 1), (2, 1), (None, 1), (5, 0), (6, 1), (7, None), (8, 5)]
    return spark.createDataFrame(rows, "doc_id long, toxic int").withColumn("text", F.lit("x"))


def operators(docs, benchmark, labels):
    model = toxicity.fit(docs, labels)
    pages = docs.select(F.col("doc_id").alias("page_id"), F.col("text").alias("url"), "*")
    return {
        "mix": mixing.mix(docs),
        "identify": langid.identify(docs, langid.learn(docs)),
        "near_copies": ngram_join.near_copies(docs),
        "interleave": sharding.interleave(docs),
        "score": toxicity.score(docs, model),
        "find_spans": decontaminate.find_spans(docs, benchmark),
        "lines": line_dedup.drop_repeated_lines(docs),
        "pii": pii.digests(pii.find(docs)),
        "sanitise": pii.sanitise(docs),
        "neighbours": fingerprints.compare_neighbours(docs),
        "fingerprints": fingerprints.fingerprints(docs),
        "judge": url_filter.judge(pages),
    }


NAMES = "mix identify near_copies interleave score find_spans lines pii sanitise neighbours fingerprints judge".split()


@pytest.fixture(scope="module")
def results(docs, benchmark, labels):
    return operators(docs, benchmark, labels)


@pytest.mark.parametrize("name", NAMES)
def test_one_row_for_each_row(results, name):
    assert results[name].count() == len(ROWS)


@pytest.fixture(scope="module")
def of_nothing(docs, benchmark, labels):
    return operators(docs.limit(0), benchmark.limit(0), labels.limit(0))


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(of_nothing, name):
    assert of_nothing[name].collect() == []


@pytest.mark.parametrize("name", ["one_of_each", "mixed_rows", "clean_only", "keep_clean"])
def test_filters_keep_all_columns(docs, benchmark, labels, name):
    for rows in (docs, docs.limit(0)):
        found = {
            "one_of_each": lambda: ngram_join.one_of_each(rows),
            "mixed_rows": lambda: mixing.mixed_rows(rows),
            "clean_only": lambda: decontaminate.clean_only(rows, benchmark),
            "keep_clean": lambda: toxicity.keep_clean(rows, toxicity.fit(rows, labels)),
        }[name]()
        assert found.columns == docs.columns
        found.collect()


def test_one_of_each_keeps_one_row_of_copies_and_all_without_words(docs):
    kept = sorted((r.doc_id or -1, r.text or "") for r in ngram_join.one_of_each(docs).collect())
    expected = {(r[0] or -1, r[1] or "") for r in ROWS}
    assert kept == sorted(expected)


def test_rows_without_text(results):
    spans = {r.doc_id: r for r in results["find_spans"].collect() if r.doc_id in (2, 3)}
    assert all((r.n_words, r.spans, r.items) == (0, [], []) for r in spans.values())
    lines = {r.doc_id: r for r in results["lines"].collect() if r.doc_id in (2, 3)}
    assert all((r.n_lines, r.n_dropped, r.text) == (1, 0, "") for r in lines.values())
    langs = {r.doc_id: (r.lang_pred, r.score) for r in results["identify"].collect() if r.doc_id in (2, 3, 4)}
    assert set(langs.values()) == {("und", 0.0)}
    sizes = {r.doc_id: r["size"] for r in results["interleave"].collect()}
    assert sizes[2] == sizes[3] == 16


def test_missing_columns_are_named(docs):
    with pytest.raises(LlmError, match="missing columns: text"):
        mixing.mix(docs.drop("text"))
