"""The physical plans hold what the operators promise."""

import datetime as dt
import os

import pytest
from feedloom.operators import cleaning, competition, cube, explore, issues, star
from feedloom.sources.landing import latest_per_product

AS_OF = "2024-07-01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, labelled, tmp_path_factory):
    path = os.path.join(str(tmp_path_factory.mktemp("plans")), "reviews")
    labelled(*[{"brand": f"b{i % 3}"} for i in range(12)]).write.parquet(path)
    return spark.read.parquet(path)


def test_selection_reaches_the_scan(spark, stored):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # else the list is cut off
    text = plan(
        explore.filter_reviews(stored, ["vacuums"], None, ["negative"], 3, True).select("review_id")
    )
    assert "In(category, [vacuums])" in text or "EqualTo(category,vacuums)" in text
    assert "GreaterThanOrEqual(severity,3)" in text
    assert "review_text" not in text.split("ReadSchema")[1]


@pytest.mark.parametrize(
    "build",
    [
        lambda df: competition.competitor_comparison(df, ["b0"]),
        lambda df: competition.feature_gaps(df, ["b0"]),
        lambda df: issues.emerging_issues(df, AS_OF),
        lambda df: issues.verified_split(df),
    ],
)
def test_reviews_are_read_once_without_texts(stored, build):
    text = plan(build(stored))
    assert text.count("FileScan") == 1
    assert "review_text" not in text
    assert "partial_" in text


@pytest.mark.parametrize(
    "build",
    [
        lambda df: cleaning.dedup_exact(df),
        lambda df: latest_per_product(df, 5),
        lambda df: explore.product_samples(df),
        lambda df: issues.phrase_counts(df),
    ],
)
def test_keys_are_cut_before_the_shuffle(stored, build):
    text = plan(build(stored))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_no_python_in_the_rules(stored):
    from feedloom.operators.classify import rule_classify

    raw = stored.select(
        "review_id", "product_id", "product_name", "brand", "category", "rating", "title",
        "review_text", "date", "verified_purchase", "helpful_votes", "source",
    )
    text = plan(rule_classify(raw))
    assert "Python" not in text and "Exchange" not in text


def test_quotes_travel_without_product_lists(stored):
    text = plan(issues.top_issues(stored, AS_OF))
    quoted = text[text.index("WindowGroupLimit") :]
    below = [line for line in quoted.splitlines() if "row_number() windowspecdefinition(category" in line and "brand" in line]
    assert below and not any("affected_products" in line for line in below)
    assert "flatten" not in text


def test_comparison_collects_no_brands(stored):
    text = plan(competition.competitor_comparison(stored, ["b0"]))
    assert "collect_list" not in text and text.count("FileScan") == 1


def test_return_risk_reads_the_texts_once(spark, stored):
    """Both parts read the risk rows that were written down; nothing stays in memory."""
    text = plan(issues.return_risk(stored))
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert scans and not any("review_text" in line for line in scans) and "InMemoryRelation" not in text


def test_issues_and_products_come_from_one_reduction(stored):
    text = plan(issues.top_issues(stored, AS_OF))
    assert sum("FileScan" in line and "review_text" in line for line in text.splitlines()) == 1
    assert all("n_reviews" in line or "review_text" in line or "product_name" in line for line in text.splitlines() if "FileScan" in line)


def test_one_new_day_rewrites_one_partition(spark, labelled, tmp_path):
    path = str(tmp_path / "days")
    days = [None, dt.date(2024, 6, 1), dt.date(2024, 6, 2), dt.date(2024, 6, 2), dt.date(2024, 1, 5)]
    old = labelled(*[{"date": d, "brand": f"b{i % 2}"} for i, d in enumerate(days)])
    new = labelled(*[{"date": dt.date(2024, 6, 2), "rating": 1.0 + i, "review_id": f"n{i}"} for i in range(3)])
    cube.write_days(old, path)
    before = {f: os.path.getmtime(f"{path}/{f}") for f in os.listdir(path) if f.startswith("period=")}
    stored = {f: sorted(os.listdir(f"{path}/{f}")) for f in before}
    cube.write_days(new, path)
    after = {f: sorted(os.listdir(f"{path}/{f}")) for f in os.listdir(path) if f.startswith("period=")}
    assert {f for f in after if after[f] != stored.get(f)} == {"period=2024-06-02"} and len(after) == 4
    rows = old.filter("date IS NULL OR date <> '2024-06-02'").unionByName(new)
    for as_of in ("2024-07-01", "2024-12-01"):
        want = cube.review_cube(rows, as_of)
        got = cube.cube_of_days(cube.read_days(spark, path), as_of)
        assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
        assert issues.issue_scores(got, as_of).collect() == issues.issue_scores(rows, as_of).collect()
    one = cube.read_days(spark, path).filter("period = '2024-06-01'")
    assert "PartitionFilters: [isnotnull(period" in plan(one)
    monthly = str(tmp_path / "months")
    cube.write_days(rows, monthly, "month")
    assert cube.read_days(spark, monthly).select("period").distinct().count() == 3
    assert cube.cube_of_days(cube.read_days(spark, monthly), "2024-07-01").count() == cube.review_cube(rows, "2024-07-01").count()


def test_a_slice_of_dates_prunes_the_months(spark, labelled, tmp_path):
    path = str(tmp_path / "fact")
    rows = labelled(*[{"date": dt.date(2024, 1 + i, 10)} for i in range(12)], {"date": None})
    star.write_fact_by_month(star.fact_reviews(rows, ["b0"]), path)
    fact, dates = spark.read.parquet(path), star.dim_date(rows)
    brands, categories = star.dim_brand(rows, ["b0"]), star.dim_category(rows)
    sliced = star.star_join(fact, brands, categories, dates.filter("quarter = 'Q2'"), "inner")
    text = plan(sliced)
    assert "dynamicpruning" in text and "PartitionFilters" in text
    assert sorted(r["month_num"] for r in sliced.collect()) == [4, 5, 6]
    assert star.star_join(fact, brands, categories, dates).count() == 13
    whole = star.star_join(star.fact_reviews(rows, ["b0"]), brands, categories, dates)
    assert whole.count() == 13 and sorted(whole.columns) == sorted(sliced.columns)
