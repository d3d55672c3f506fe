"""Languages whose trigrams are all rare, and many languages, against the counts themselves."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from usagelens.llm import langid


def chinese(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def test_a_language_of_rare_trigrams_is_learned(spark):
    """Some 400,000 trigrams, none of which is a noticeable share of the language."""
    rng = random.Random(8)
    words = ["".join(chr(0x4E00 + rng.randrange(6000)) for _ in range(3)) for _ in range(140_000)]
    english = "the of and to in is that it was for on are as with his they at be this from have or by one".split()
    rows = [(i, chinese(rng, words, 300), "zh") for i in range(1500)]
    rows += [(i, " ".join(rng.choice(english) for _ in range(100)), "en") for i in range(1500, 2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8).cache()
    counts = langid.trigram_counts(docs).filter("lang = 'zh'")
    assert counts.count() > 380_000
    profiles = langid.learn(docs.filter("doc_id % 5 <> 0"))
    found = langid.identify(docs, profiles).collect()
    truth = {i: lang for i, _, lang in rows}
    for held in (True, False):
        some = [r for r in found if (r.doc_id % 5 == 0) == held]
        for lang in ("zh", "en"):
            own = [r for r in some if truth[r.doc_id] == lang]
            assert np.mean([r.lang_pred == lang for r in own]) >= 0.95
    assert all(0 <= r.score <= 1 for r in found)
    assert profiles.words.nbytes <= 8 * langid.MAX_SLOTS


def test_the_filter_holds_what_a_plain_count_keeps(spark):
    rng = random.Random(3)
    letters = {"aa": "abcde", "bb": "abcfg", "cc": "hijkl"}
    rows = [(lang, "".join(rng.choice(some + " ") for _ in range(80))) for lang, some in letters.items() for _ in range(40)]
    rows += [(None, "zzz"), ("dd", None), ("aa", "")]
    profiles = langid.learn(spark.createDataFrame(rows, "lang string, text string"))
    counts = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        if lang and text:
            counts[lang].update(langid.trigrams([text])[0].tolist())
    total = {lang: sum(c.values()) for lang, c in counts.items()}
    share = {lang: {g: n / total[lang] for g, n in c.items()} for lang, c in counts.items()}
    kept = {
        lang: np.array([g for g, x in own.items() if x >= langid.MIN_OF_BEST * max(o.get(g, 0) for o in share.values())], dtype=np.uint64)
        for lang, own in share.items()
    }
    expected = langid.Profiles(kept, total)
    assert profiles.langs == expected.langs
    assert (profiles.words == expected.words).all()


def test_most_frequent_trigrams_are_chosen(spark):
    rows = [("aa", g, 1 + g // 100) for g in range(5000)] + [("bb", g, 1) for g in range(20_000)] + [("cc", 7, 3)]
    found = langid.chosen(spark.createDataFrame(rows, "lang string, gram long, n long"), 1000)
    by = collections.defaultdict(list)
    for r in found.collect():
        by[r.lang].append(r.gram)
    assert len(by["aa"]) == pytest.approx(1000, rel=0.1) and min(by["aa"]) >= 3500
    assert len(by["bb"]) == pytest.approx(1000, rel=0.15)
    assert by["cc"] == [7]


def test_more_languages_than_one_row_of_slots(spark):
    rows = [(f"l{i:03}", chr(0x4E00 + 3 * i) + chr(0x4E01 + 3 * i)) for i in range(1500)]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string")
    profiles = langid.learn(docs)
    assert len(profiles.langs) == 1500 and profiles.words.nbytes <= 8 * langid.MAX_SLOTS
    found = {r.doc_id: r.lang_pred for r in langid.identify(docs.withColumn("x", F.lit(1)), profiles).collect()}
    assert found == {i: lang for i, (lang, _) in enumerate(rows)}
