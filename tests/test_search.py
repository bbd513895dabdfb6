"""The trigram index against plain substring search."""

import random

import numpy as np
import pytest
from feedloom.operators import search
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdeéß %_") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) for _ in range(300)] + ["The MIT License", "\U0001f600abc", "", None, "ab"]


@pytest.fixture(scope="module")
def index(spark, texts, tmp_path_factory):
    rows = spark.createDataFrame([(f"r{i}", t) for i, t in enumerate(texts)], "review_id string, review_text string")
    return search.TextIndex(spark, str(tmp_path_factory.mktemp("index")), block_rows=16, shelf_blocks=2).build(rows)


def test_same_as_substrings(index, texts):
    rng = random.Random(3)
    needles = ["a", "ab", "", "mit lic", "\U0001f600ab", "%_", "abcdefgh", "É"]
    for n in (1, 2, 3, 4, 7, 12, 30):
        text = rng.choice([t for t in texts if t and len(t) > 40])
        at = rng.randrange(len(text) - n)
        needles.append(text[at : at + n].upper().replace("SS", "ß"))
    for needle in needles:
        want = sorted(f"r{i}" for i, t in enumerate(texts) if t is not None and needle.lower() in t.lower())
        assert sorted(r["id"] for r in index.search(needle).collect()) == want, needle


def test_only_candidates_are_compared(index, texts):
    needle = next(t for t in texts if t and len(t) > 60)[20:34].lower()
    candidates = index.candidates(needle).count()
    assert 1 <= candidates <= 20
    plan = index.search(needle)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(gram" in plan or "In(gram" in plan
    assert plan.count("FileScan") >= 2


def test_lists_are_sorted_differences(index, texts):
    rows = index.spark.read.parquet(f"{index.path}/postings").filter("gram = 'abc'").collect()
    places = {(r["block"], int(p)) for r in rows for p in np.cumsum(r["steps"])}
    held = {(r["block"], r["place"]) for r in index.texts().filter(F.col("low").contains("abc")).collect()}
    assert places == held and all(s > 0 for r in rows for s in r["steps"][1:])


def test_an_empty_table(spark, tmp_path):
    rows = spark.createDataFrame([], "review_id string, review_text string")
    index = search.TextIndex(spark, str(tmp_path / "none")).build(rows)
    assert index.search("abc").count() == 0 and index.search("a").count() == 0
