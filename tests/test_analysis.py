import datetime as dt
import math

import pytest
from feedloom.config import Settings
from feedloom.operators import competition, explore, issues, scorecards, star
from feedloom.operators.cube import review_cube
from feedloom.plans.batch import run_all
from pyspark.sql import functions as F

AS_OF = "2024-07-01"
TODAY = dt.date(2024, 7, 1)


def rows(df, *order):
    return [r.asDict() for r in df.orderBy(*order).collect()]


def ago(days):
    return TODAY - dt.timedelta(days=days)


def test_top_issue_values(labelled):
    df = labelled(
        {"severity": 4, "date": ago(10), "failure_mode": "B", "review_text": "second"},
        {"severity": 5, "date": ago(20), "failure_mode": "A", "review_text": "first"},
        {"severity": 3, "date": None, "failure_mode": None, "sentiment": "mixed", "review_text": "last"},
        {"sentiment": "positive"},
    )
    (row,) = rows(issues.top_issues(df, AS_OF), "rank")
    recency = math.exp(-15 / 180)
    assert row["frequency"] == 3
    assert row["avg_severity"] == 4.0
    assert row["recency_weight"] == round(recency, 3)
    assert row["impact_score"] == round(3 * 4.0 * recency, 2)
    assert row["top_failure_mode"] == "A"
    assert row["sample_quotes"] == ["first", "second", "last"]
    assert row["affected_products"] == ["Test Product"]


def test_undated_issues_weigh_half(labelled):
    (row,) = rows(issues.issue_scores(labelled({"date": None}, {"date": None}), AS_OF), "brand")
    assert (row["recency_weight"], row["impact_score"]) == (0.5, 4.0)


def test_ties_are_ranked_by_brand_and_theme(labelled):
    df = labelled({"brand": "B"}, {"brand": "A", "primary_theme": "noise"}, {"brand": "A"})
    got = rows(issues.top_issues(df, AS_OF, top_n=2), "rank")
    assert [(r["brand"], r["primary_theme"]) for r in got] == [("A", "durability"), ("A", "noise")]


def group(brand, theme, positive, negative):
    return [
        {"brand": brand, "primary_theme": theme, "sentiment": s, "rating": r}
        for s, r, n in (("positive", 5.0, positive), ("negative", 1.0, negative))
        for _ in range(n)
    ]


def test_comparison_needs_three_on_both_sides(labelled):
    df = labelled(
        *group("Ours", "noise", 3, 0), *group("Rival", "noise", 0, 3),
        *group("Ours", "power", 2, 0), *group("Rival", "power", 3, 0),
        *group("Ours", "size", 3, 0), *group("Rival", "size", 3, 0),
    )
    got = rows(competition.competitor_comparison(df, ["Ours"]), "theme")
    assert [(r["theme"], r["delta"]) for r in got] == [("noise", 1.4), ("size", 0.0)]
    assert got[0]["insight"] == "Ours significantly outperforms Rival on noise"
    assert got[0]["opportunity"] == "Leverage noise advantage in marketing vs Rival"
    assert got[1]["insight"] == "Ours slightly behind Rival on size"
    assert got[1]["opportunity"] == ""


@pytest.mark.parametrize(
    "delta, word, action",
    [
        (0.2, "slightly ahead", ""), (0.21, "significantly outperforms", "Leverage"),
        (0.0, "slightly behind", ""), (-0.1, "slightly behind", ""),
        (-0.11, "slightly behind", "Improve"), (-0.2, "significantly underperforms", "Improve"),
    ],
)
def test_wording_bounds(spark, delta, word, action):
    df = spark.createDataFrame([("a", "b", "t", delta)], "our_brand string, competitor string, theme string, d double")
    row = df.select(
        competition.insight(F.col("d")).alias("i"), competition.opportunity(F.col("d")).alias("o")
    ).first()
    assert word in row["i"] and row["o"].startswith(action) and bool(row["o"]) == bool(action)


def test_feature_gaps(labelled):
    df = labelled(
        *group("Rival", "noise", 3, 0), *group("Ours", "noise", 0, 2),
        *group("Rival", "power", 3, 0), *group("Ours", "power", 1, 0),
        *group("Rival", "size", 2, 0),
    )
    (row,) = rows(competition.feature_gaps(df, ["Ours"]), "theme")
    assert (row["theme"], row["competitor_positive_count"]) == ("noise", 3)


def dated(theme, days, n):
    return [{"primary_theme": theme, "date": None if days is None else ago(days)} for _ in range(n)]


def test_emerging_bounds(labelled):
    df = labelled(
        *dated("battery", 90, 5), *dated("smell", 10, 4), *dated("noise", 91, 6),
        *dated("noise", 5, 1), *dated("smell", None, 9),
    )
    (row,) = rows(issues.emerging_issues(df, AS_OF), "theme")
    assert (row["theme"], row["recent_count"], row["older_count"]) == ("battery", 5, 0)
    assert row["growth_factor"] == 500.0


def test_emerging_needs_both_windows(labelled):
    assert issues.emerging_issues(labelled(*dated("noise", 5, 9)), AS_OF).count() == 0
    assert issues.emerging_issues(labelled(*dated("noise", 200, 9)), AS_OF).count() == 0


def test_phrases_merge_outer_space_only_overall(labelled):
    df = labelled(
        {"key_phrases": ["Too loud", " too loud "]}, {"key_phrases": ["too loud"], "sentiment": "mixed"}
    )
    got = {(r["list"], r["phrase"]): r["uses"] for r in issues.phrase_counts(df).collect()}
    assert got == {("all", "too loud"): 3, ("negative", "too loud"): 1, ("negative", " too loud "): 1}


def test_return_risk(labelled):
    df = labelled(
        {"rating": 2.0, "review_text": "I want a REFUND and will return it", "severity": 4},
        {"rating": 3.0, "review_text": "refund"},
        {"rating": 1.0, "review_text": "nothing"},
        {"rating": 1.0, "review_text": "pure junk", "severity": 5, "primary_theme": "noise"},
    )
    (row,) = rows(issues.return_risk(df), "product")
    assert (row["return_risk_count"], row["avg_severity"]) == (2, 4.5)
    assert row["top_themes"] == ["durability", "noise"]
    assert row["sample_reviews"][0]["risk_signals"] == ["return", "refund"]


def test_empty_segment_is_null(labelled):
    row = issues.verified_split(labelled({}, {})).first()
    assert (row["verified_count"], row["unverified_count"]) == (2, 0)
    assert row["verified_avg_rating"] == 3.0 and row["unverified_avg_rating"] is None


def many(n=400):
    themes = ["noise", "battery", "power", "size"]
    moods = ["positive", "negative", "mixed", "neutral"]
    return [
        {
            "brand": ["Ours", "Rival", "Third"][i % 3],
            "category": "vacuums" if i % 2 else "blenders",
            "primary_theme": themes[(i // 3) % 4] if i % 11 else "battery",
            "sentiment": moods[(i // 5) % 4],
            "rating": float(i % 5 + 1),
            "severity": i % 5 + 1,
            "date": None if i % 13 == 0 else ago(i % 400),
            "verified_purchase": i % 4 != 0,
            "product_name": f"p{i % 7}",
            "failure_mode": ["A", "B", None][i % 3],
        }
        for i in range(n)
    ]


def as_set(df):
    return sorted(str(r) for r in df.collect())


def test_cube_gives_the_same_answers(labelled):
    df = labelled(*many())
    settings = Settings(own_brands=("Ours",), as_of=AS_OF)
    cube = review_cube(df, AS_OF)
    assert cube.count() < df.count()
    from_cube = run_all(df, settings, cube)
    direct = {
        "summary_stats": issues.summary_stats(df),
        "avg_rating_by_brand": issues.avg_rating_by(df),
        "review_count_by_brand": issues.value_counts(df, "brand"),
        "top_issues": issues.top_issues(df, AS_OF),
        "competitor_comparison": competition.competitor_comparison(df, ["Ours"]),
        "emerging_issues": issues.emerging_issues(df, AS_OF),
        "feature_gaps": competition.feature_gaps(df, ["Ours"]),
        "verified_vs_unverified": issues.verified_split(df),
    }
    for name, table in direct.items():
        assert as_set(from_cube[name].select(*table.columns)) == as_set(table), name


def test_partitioning_does_not_matter(labelled, spark):
    df = labelled(*many())
    want = None
    for n in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        mixed = df.repartition(n, F.rand(n))
        got = [
            as_set(issues.top_issues(mixed, AS_OF)),
            as_set(competition.competitor_comparison(mixed, ["Ours"])),
            as_set(issues.emerging_issues(mixed, AS_OF)),
            as_set(explore.product_samples(mixed)),
        ]
        assert want is None or got == want
        want = got
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_scorecard_rounding(labelled):
    df = labelled({"rating": 5.0, "severity": 1, "sentiment": "positive"}, {"rating": 4.0, "severity": 2})
    health = scorecards.brand_health(df).first()
    assert health["health_score"] == round(4.5 / 5 * 40 + 50 / 100 * 30 + 3.5 / 4 * 30)
    panel = scorecards.own_brand_panel(df, ["Ours"]).first()
    assert panel["score"] == int(36 + 15 + 26.25)
    assert (panel["band"], panel["top_issue"]) == ("Green", "Durability")


def test_modal_tie_takes_the_first_name(labelled):
    df = labelled({"primary_theme": "noise"}, {"primary_theme": "battery"})
    assert scorecards.own_brand_panel(df, ["Ours"]).first()["top_issue"] == "Battery Life"


def test_dates_last_both_ways(labelled):
    df = labelled({"date": None}, {"date": ago(1)}, {"date": ago(2)}).withColumn("title", F.col("review_id"))
    for ascending, want in ((True, ["r002", "r001", "r000"]), (False, ["r001", "r002", "r000"])):
        got = [r["title"] for r in explore.sorted_view(df, "date", ascending).collect()]
        assert got == want


def test_search_is_literal_and_null_safe(labelled):
    df = labelled({"review_text": "50% OFF (really)"}, {"review_text": None}, {"review_text": "offer"})
    assert [r["review_id"] for r in explore.search_text(df, "off (").collect()] == ["r000"]


def test_calendar(labelled):
    df = labelled({"date": dt.date(2024, 1, 30)}, {"date": dt.date(2024, 2, 2)}, {"date": None})
    got = rows(star.dim_date(df), "date")
    assert [r["day"] for r in got] == [30, 31, 1, 2]
    assert (got[0]["quarter"], got[0]["month_year"], got[3]["year_month_sort"]) == ("Q1", "Jan 2024", 202402)
    assert star.dim_date(labelled({"date": None})).count() == 0
    assert star.dim_date(labelled({})).count() == 1


def test_fact_flattens_mentions(labelled):
    mentions = [("Z", "favorable"), ("A", "unfavorable"), ("Z", "favorable"), ("", "favorable"), (None, "neutral")]
    row = star.fact_reviews(labelled({"competitor_mentions": mentions}), ["Ours"]).first()
    assert row["competitor_mention_count"] == 5
    assert row["competitor_brands_mentioned"] == "A, Z"
    assert row["favorable_competitor_mentions"] == 3
    assert row["is_own_brand"] and row["is_negative"] and not row["is_positive"]


def test_pivot_finds_its_columns(labelled):
    df = labelled({"category": "a"}, {"category": "b"}, {"category": "b", "primary_theme": "noise"})
    got = {r["primary_theme"]: (r["a"], r["b"]) for r in star.theme_category_pivot(df).collect()}
    assert got == {"durability": (1, 1), "noise": (0, 1)}


def test_means_leave_out_nulls(labelled):
    from feedloom.operators import competition, issues, scorecards

    rows = labelled(
        {"rating": 4.0, "severity": 2, "verified_purchase": True},
        {"rating": None, "severity": None, "verified_purchase": None},
    )
    assert issues.avg_rating_by(rows).first()["avg_rating"] == 4.0
    assert scorecards.brand_health(rows).first()["avg_severity"] == 2.0
    assert issues.summary_stats(rows).first()["verified_purchase_rate"] == 1.0
    assert issues.verified_split(rows).first()["verified_avg_rating"] == 4.0
    assert issues.issue_scores(rows, "2024-07-01").first()["avg_severity"] == 2.0
    assert competition.theme_scores(rows).first()["score"] == (-1 + 4 / 5) / 2


def test_a_cube_answers_only_for_its_dates(spark, labelled):
    import pytest
    from feedloom.operators import cube, issues

    rows = labelled(*[{"severity": 4} for _ in range(6)])
    stored = cube.review_cube(rows, "2024-07-01").cache()
    direct = issues.issue_scores(rows, "2024-07-01").collect()
    assert issues.issue_scores(stored, "2024-07-01").collect() == direct
    with pytest.raises(Exception, match="another date"):
        issues.issue_scores(stored, "2025-07-01").collect()
    with pytest.raises(Exception, match="another date"):
        issues.emerging_issues(stored, "2024-07-01", 60).collect()


def test_three_ways_of_rounding(spark):
    from feedloom.functions.numbers import round_away, round_even, round_exact
    from pyspark.sql import functions as F

    values = [2.675, 0.125, 2.5, 1.005, 107 / 40, 0.5, -2.675, 0.045, 1e-9, 123456.785]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    v = F.col("v")
    rows = df.select("v", round_exact(v, 2).alias("exact"), round_even(v, 2).alias("even"), round_away(v, 2).alias("away")).collect()
    assert [r["exact"] for r in rows] == [round(x, 2) for x in values]
    by = {r["v"]: r for r in rows}
    assert (by[2.675]["exact"], by[2.675]["even"], by[2.675]["away"]) == (2.67, 2.68, 2.68)
    assert (by[0.125]["even"], by[0.125]["away"]) == (0.12, 0.13)
