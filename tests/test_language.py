"""Trigram profiles: scores against a plain sum, held-out rows, ties and unknown letters."""

import math
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest
from feedloom.operators import language
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def grams_of(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    return [f" {w} "[i : i + 3] for w in words for i in range(len(w))]


def plain_profiles(rows, size):
    counts = {}
    for text, lang in rows:
        counts.setdefault(lang, Counter()).update(grams_of(text))
    listed = {}
    for lang, c in counts.items():
        total = sum(c.values())
        for gram, n in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:size]:
            listed[lang, gram] = math.log(n / total)
    least = min(listed.values())
    return {key: math.floor((v - least) * 1000 + 0.5) + 1000 for key, v in listed.items()}


def plain_language(profiles, text):
    scores = Counter()
    for gram in grams_of(text):
        for lang in {lang for lang, _ in profiles}:
            scores[lang] += profiles.get((lang, gram), 0)
    best = min(scores, key=lambda x: (-scores[x], x), default=None)
    return best if best and scores[best] > 0 else None


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.col("text").alias("review_text"), "lang")


@pytest.mark.parametrize("dense", [True, False])
def test_same_as_plain_sums(spark, documents, monkeypatch, dense):
    if not dense:
        monkeypatch.setattr(language, "DENSE", 0)
    part = documents.filter("doc_id < 60 AND length(review_text) < 4000")
    rows = [(r["review_text"], r["lang"]) for r in part.collect()]
    profiles = language.train_profiles(part, size=40)
    got = {(r["lang"], r["gram"]): r["gain"] for r in profiles.collect()}
    want = plain_profiles(rows, 40)
    assert got == want
    found = {r["doc_id"]: (r["review_text"], r["detected_lang"]) for r in language.detect_language(documents, profiles).collect()}
    assert all(lang == plain_language(want, text or "") for text, lang in list(found.values())[:120])


def test_judged_on_rows_it_did_not_learn_from(documents):
    train = documents.filter("doc_id % 3 <> 1")
    told = language.detect_language(documents.filter("doc_id % 3 = 1 AND length(review_text) > 40"), language.train_profiles(train))
    rows = told.filter("lang IS NOT NULL").collect()
    assert len(rows) > 40 and sum(r["lang"] == r["detected_lang"] for r in rows) >= 0.95 * len(rows)


def test_unknown_and_equal(spark):
    train = spark.createDataFrame([("abc abc", "b"), ("abc abc", "a"), ("xyz", None)], "review_text string, lang string")
    profiles = language.train_profiles(train)
    texts = spark.createDataFrame([("abc",), ("qqq",), ("123 ½",), ("",), (None,), ("漢字 \U0001f600",)], "review_text string")
    assert [r["detected_lang"] for r in language.detect_language(texts, profiles).collect()] == ["a", None, None, None, None, None]
    assert [r["detected_lang"] for r in language.detect_language(texts, profiles.limit(0)).collect()] == [None] * 6
    assert language.filter_language(texts, profiles, "b").count() == 5


def test_texts_become_python_strings_a_part_at_a_time(monkeypatch):
    """Memory follows the characters that are scored at once, not those of an Arrow batch."""
    monkeypatch.setattr(language, "CHARS_AT_ONCE", 5_000)
    rows = [("a", "abc", 1500), ("b", "xyz", 1500)]
    scorer, held = language.Scorer(rows), []
    best = scorer.best
    scorer.best = lambda texts: held.append(sum(map(len, texts))) or best(texts)
    texts = pa.array(["abc " * 500, "xyz " * 500, None, "", "123"] * 2000)
    tracemalloc.start()
    try:
        found = scorer.languages(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == ["a", "b", None, None, None] * 2000
    assert max(held) <= 5_000 + 2_002 and sum(held) == 2_000 * (2_002 + 2_002 + 2 + 2 + 5)
    assert peak < 2_000_000 < texts.nbytes
