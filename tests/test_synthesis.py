import pytest
from feedloom.sources.landing import catalog_df
from synthesis import synthesize_reviews
from feedloom.sources.validation import validate

NESTED = {
    "vacuums": {"Ours": [{"asin": "A1", "name": "Ours One"}, {"asin": "A2", "name": "Ours Two"}],
                "Rival": [{"asin": "A3", "name": "Rival V"}]},
    "blenders": {"Ours": [{"asin": "B1", "name": "Ours Mix"}], "Other": [{"asin": "B2", "name": "Other B"}],
                 "Third": [{"asin": "B3", "name": "Third B"}]},
}


@pytest.fixture(scope="module")
def made(spark):
    return synthesize_reviews(spark, 1000, catalog_df(spark, NESTED), "2024-07-01").cache()


def test_count(spark, made):
    assert made.count() == 1000
    assert made.select("review_id").distinct().count() == 1000


def test_mean_rating(made):
    assert 2.5 <= made.agg({"rating": "avg"}).first()[0] <= 4.0


def test_categories_and_brands(made):
    assert {r[0] for r in made.select("category").distinct().collect()} == {"vacuums", "blenders"}
    assert {"Ours"} < {r[0] for r in made.select("brand").distinct().collect()}


def test_texts(made):
    rows = made.select("review_text", "title").collect()
    assert all(len(r[0]) > 20 and "{" not in r[0] + r[1] for r in rows)


def test_rows_are_valid_and_dated_before_today(made):
    ok, bad = validate(made)
    assert bad.count() == 0
    low, high = made.agg({"date": "min"}).first()[0], made.agg({"date": "max"}).first()[0]
    assert str(low) >= "2023-07-02" and str(high) <= "2024-06-30"


def test_same_rows_however_partitioned(spark, made):
    again = synthesize_reviews(spark, 1000, catalog_df(spark, NESTED).repartition(3), "2024-07-01")
    assert made.exceptAll(again).count() == 0
    other = synthesize_reviews(spark, 1000, catalog_df(spark, NESTED), "2024-07-01", seed=7)
    assert made.exceptAll(other).count() > 0
