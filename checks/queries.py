"""One query per operator, run over the review tables derived from the driver tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.config import RISK_SIGNALS, THEMES, Settings
from feedloom.functions.staging import Stage
from feedloom.functions.text import count_present, first_label
from feedloom.operators import (
    classify,
    cleaning,
    competition,
    cube,
    evidence,
    explore,
    inference,
    issues,
    language,
    neardup,
    quality,
    scorecards,
    search,
    star,
)
from feedloom.plans import batch
from feedloom.sources import files, landing, sinks, validation

from . import bindings as b

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

AS_OF, OWN = b.AS_OF, b.OWN_BRANDS
SETTINGS = Settings(own_brands=OWN, as_of=AS_OF, rules=b.RULES, risk_signals=b.SIGNALS)
ORDER = ("doc_id",)
LISTED = "|"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def text_of(column: str) -> Column:
    return F.array_join(column, LISTED).alias(column)


def classified(spark: SparkSession, sf: str) -> DataFrame:
    return classify.rule_classify(b.reviews_text(spark, sf), b.RULES).drop("lang")


# --- Sources ------------------------------------------------------------------

RAW_COLUMNS = [
    "review_id", "product_id", "product_name", "brand", "category", "rating", "title",
    "review_text", "date", "verified_purchase", "helpful_votes", "source",
]


def stored_reviews(spark: SparkSession, sf: str, fmt: str = "json") -> str:
    """Raw reviews written to the shared folder; gives the path."""
    path = Stage(spark, "reviews").folder
    sinks.write_reviews(b.reviews_text(spark, sf).drop("lang", "doc_id"), path, fmt)
    return path


@query
def s01_w01_json_round_trip(spark, sf):
    return files.read_reviews(spark, stored_reviews(spark, sf)).select(*RAW_COLUMNS)


@query
def s02_classified_round_trip(spark, sf):
    path = Stage(spark, "classified").folder
    sinks.write_reviews(classified(spark, sf).drop("doc_id"), path, "json")
    return files.read_classified(spark, path).select(
        "review_id", "primary_theme", "sentiment", "severity", "failure_mode",
        text_of("features_mentioned"), text_of("key_phrases"),
    )


@query
def s03_inferred_scan(spark, sf):
    return files.read_any(spark, stored_reviews(spark, sf)).select(
        "review_id", F.col("rating").cast("double").alias("rating"), "date"
    )


@query
def s04_w02_report_round_trip(spark, sf):
    path = Stage(spark, "report").folder
    found = issues.emerging_issues(b.reviews_fact(spark, sf), AS_OF)
    sinks.write_report({"emerging_issues": found}, path)
    return files.read_report(spark, path, "emerging_issues").select(*found.columns)


@query
def s05_marketplace_items(spark, sf):
    return landing.map_marketplace(b.items(spark, sf), b.catalog(spark, sf))


@query
def s06_latest_per_product(spark, sf):
    return landing.latest_per_product(b.reviews_fact(spark, sf), 10).select(
        "product_id", "review_id", "date"
    )


@query
def s07_parse_dates(spark, sf):
    return b.items(spark, sf).select("id", landing.parse_date_multi(F.col("date")).alias("date"))


@query
def s08_forum_posts(spark, sf):
    return landing.map_posts(b.posts(spark, sf), b.BRAND_WORDS, b.POSITIVE, b.NEGATIVE)


@query
def s09_forum_comments(spark, sf):
    return landing.map_comments(
        b.posts(spark, sf), b.comments(spark, sf), b.BRAND_WORDS, 3, b.POSITIVE, b.NEGATIVE
    )


@query
def s10_first_label(spark, sf):
    low = F.lower("review_text")
    return b.reviews_text(spark, sf).select(
        "review_id", first_label(low, list(b.BRAND_WORDS)).alias("label")
    )


@query
def s11_estimate_rating(spark, sf):
    text = F.col("review_text")
    return b.reviews_text(spark, sf).select(
        "review_id",
        count_present(F.lower(text), b.POSITIVE).alias("positive"),
        count_present(F.lower(text), b.NEGATIVE).alias("negative"),
        landing.estimate_rating(text, b.POSITIVE, b.NEGATIVE).alias("estimate"),
    )


@query
def s12_forum_sources(spark, sf):
    posts = b.posts(spark, sf).drop("category")
    chosen = landing.forum_sources(spark, b.FORUMS)
    return landing.select_posts(posts, chosen).select("id", "forum", "category", "query")


@query
def s13_catalog(spark, sf):
    return landing.explode_catalog(b.nested_catalog(spark, sf))


@query
def s14_union_sources(spark, sf):
    return landing.union_sources(
        s05_marketplace_items(spark, sf), s08_forum_posts(spark, sf), s09_forum_comments(spark, sf)
    )


@query
def s15_validate_raw(spark, sf):
    ok, bad = validation.validate(b.unchecked(spark, sf), "raw")
    none = F.lit("")
    return ok.select("review_id", "title", "helpful_votes", none.alias("reasons")).unionByName(
        bad.select("review_id", "title", "helpful_votes", text_of("reasons"))
    )


@query
def s15_validate_classified(spark, sf):
    rows = classified(spark, sf).withColumns(
        {
            "severity": F.when(F.col("doc_id") % 5 == 0, 6).otherwise(F.col("severity")),
            "primary_theme": F.when(F.col("doc_id") % 7 == 0, "other").otherwise(
                F.col("primary_theme")
            ),
            "sentiment": F.when(F.col("doc_id") % 11 != 0, F.col("sentiment")),
        }
    )
    return validation.with_reasons(rows, "classified").select("review_id", text_of("reasons"))


# --- Sinks --------------------------------------------------------------------


@query
def w03_csv_round_trip(spark, sf):
    path = Stage(spark, "csv").folder
    rows = b.reviews_text(spark, sf).select("review_id", "brand", "rating", "date", "review_text")
    sinks.write_csv(rows, path)
    return sinks.read_csv(spark, path, rows.schema)


@query
def w04_bundle(spark, sf):
    path = Stage(spark, "bundle").folder
    fact = b.reviews_fact(spark, sf)
    tables = {"Brand_Sentiment": star.brand_sentiment_pivot(fact), "Scorecard": scorecards.brand_scorecard(fact)}
    sinks.write_bundle(tables, path, "parquet")
    left = spark.read.parquet(f"{path}/Brand_Sentiment")
    return left.join(spark.read.parquet(f"{path}/Scorecard"), "brand")


def extracted(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """An extract of the order lines written as CSV and read back."""
    rows = b.reviews_fact(spark, sf).withColumns(
        {c: F.array().cast("array<string>") for c in star.LIST_COLUMNS}
    )
    path = Stage(spark, "extract").folder
    chosen = batch.exports(rows, cube.review_cube(rows, AS_OF), OWN)[name]
    sinks.write_csv(chosen, path)
    flat = chosen.select(*sinks.flat_columns(chosen))
    return sinks.read_csv(spark, path, flat.schema)


@query
def w05_summary_extract(spark, sf):
    return extracted(spark, sf, "summary")


@query
def w05_negative_extract(spark, sf):
    return extracted(spark, sf, "negative_reviews").select("review_id", "rating")


# --- Cleaning -----------------------------------------------------------------


@query
def c01_drop_short(spark, sf):
    return cleaning.drop_short(b.reviews_text(spark, sf)).select("review_id")


@query
def c02_dedup_exact(spark, sf):
    return cleaning.dedup_exact(cleaning.drop_short(b.reviews_text(spark, sf)), ORDER).select(
        "review_id", F.length("review_text").alias("chars")
    )


@query
def c03_dedup_fuzzy(spark, sf):
    rows = cleaning.drop_short(b.stored_text(spark, sf))
    return neardup.dedup_fuzzy(rows, ORDER).select("review_id")


@query
def c03_dedup_whole(spark, sf):
    """Heads and whole texts must both be close."""
    rows = cleaning.drop_short(b.stored_text(spark, sf))
    return neardup.dedup_fuzzy(rows, ORDER, whole=True).select("review_id")


@query
def c04_language_profiles(spark, sf):
    return language.train_profiles(b.reviews_text(spark, sf))


@query
def c04_filter_language(spark, sf):
    rows = b.stored_text(spark, sf)
    profiles = language.train_profiles(rows)
    return language.filter_language(rows, profiles).select("review_id", "lang")


@query
def c04_detect_whole_text(spark, sf):
    rows = b.stored_text(spark, sf)
    profiles = language.train_profiles(rows)
    return language.detect_language(rows, profiles, chars=None).select(
        "review_id", "lang", "detected_lang"
    )


@query
def c04_judged_on_other_rows(spark, sf):
    """Profiles learn from two thirds of the reviews and are judged on the rest, all of them."""
    rows = b.stored_text(spark, sf)
    profiles = language.train_profiles(rows.filter("doc_id % 3 <> 1"))
    told = language.detect_language(rows.filter("doc_id % 3 = 1"), profiles)
    return told.groupBy("lang", "detected_lang").agg(F.count(F.lit(1)).alias("reviews"))


@query
def c05_spam_regex(spark, sf):
    return b.reviews_text(spark, sf).select(
        "review_id", cleaning.is_spam(F.col("review_text"), b.SPAM).alias("is_spam")
    )


@query
def c06_c07_bot_rules(spark, sf):
    text = F.col("review_text")
    return b.reviews_text(spark, sf).select(
        "review_id",
        cleaning.is_shouting(text, F.col("rating")).alias("is_shouting"),
        cleaning.is_repetitive(text).alias("is_repetitive"),
    )


@query
def c08_remove_spam(spark, sf):
    return cleaning.remove_spam(b.reviews_text(spark, sf), b.SPAM).select("review_id")


@query
def c09_flag_shipping(spark, sf):
    return cleaning.flag_shipping(b.reviews_text(spark, sf), b.SHIPPING, b.PRODUCT).select(
        "review_id", "is_shipping_only"
    )


@query
def c10_normalize_text(spark, sf):
    return cleaning.normalize_text(b.reviews_text(spark, sf)).select(
        "review_id", "title", "review_text"
    )


@query
def c11_cleaning_stats(spark, sf):
    rows = b.stored_text(spark, sf)
    profiles = language.train_profiles(rows)
    return cleaning.cleaning_stats(rows, SETTINGS, profiles, ORDER, b.SPAM, b.SHIPPING, b.PRODUCT)


@query
def c12_clean(spark, sf):
    rows = b.stored_text(spark, sf)
    profiles = language.train_profiles(rows)
    return cleaning.clean(
        rows, SETTINGS, profiles, ORDER, b.SPAM, b.SHIPPING, b.PRODUCT
    ).select("review_id", "title", "review_text", "is_shipping_only")


# --- Classification -----------------------------------------------------------


@query
def k01_prompt(spark, sf):
    return classify.with_prompt(b.reviews_text(spark, sf)).select(
        "review_id", F.md5("prompt").alias("prompt_md5"), F.length("prompt").alias("chars")
    )


@query
def k02_route(spark, sf):
    return classify.route(b.reviews_text(spark, sf), hedges=b.HEDGE_WORDS).select(
        "review_id", "model"
    )


@query
def k03_parse_response(spark, sf):
    parsed = classify.parse_response(F.col("response"))
    return b.responses(spark, sf).select(
        "review_id",
        parsed.isNull().alias("parse_error"),
        F.try_variant_get(parsed, "$.primary_theme", "string").alias("theme"),
    )


@query
def k04_coerce(spark, sf):
    return classify.coerce_classification(b.responses(spark, sf)).select(
        "review_id", "failed_reason", "primary_theme", text_of("secondary_themes"), "sentiment",
        "sentiment_confidence", "severity", "has_actionable_signal", "actionable_detail",
        text_of("key_phrases"),
    )


def rating_scorer():
    """Stand-in for a model: answers from the rating line, fails on three stars."""

    def answer(prompt: str):
        rating = float(prompt.split("Rating: ", 1)[1].split("/5", 1)[0])
        if rating == 3:
            return ValueError("undecided")
        return '{"sentiment": "%s"}' % ("positive" if rating > 3 else "negative")

    return lambda prompts: [answer(p) for p in prompts]


@query
def k05_infer(spark, sf):
    rows = classify.with_prompt(b.reviews_text(spark, sf)).select("review_id", "prompt")
    answered, failed = inference.infer(rows, rating_scorer)
    return answered.unionByName(failed).select("review_id", "response", "failed_reason")


@query
def k06_split_cached(spark, sf):
    calls = inference.with_cache_key(
        classify.with_prompt(classify.route(b.reviews_text(spark, sf), hedges=b.HEDGE_WORDS))
    )
    cache = calls.filter(F.col("doc_id") % 3 == 0).select("cache_key").distinct()
    cache = cache.withColumn("response", F.substring("cache_key", 1, 8))
    cache = cache.union(cache)  # an append-only cache holds keys more than once
    hits, misses = inference.split_cached(calls, cache)
    return hits.select("review_id", "cache_key", "response").unionByName(
        misses.select("review_id", "cache_key", F.lit(None).cast("string").alias("response"))
    )


@query
def k11_model_run(spark, sf):
    rows = b.stored_text(spark, sf).drop("lang")
    cache = Stage(spark, "answers").folder
    # Half of the reviews first; the second run finds their answers in the cache.
    batch.classify_with_model(rows.filter("doc_id % 2 = 0"), rating_scorer, cache, 1e9, ("doc_id",), wave=1.0)
    fine, failed, _ = batch.classify_with_model(rows, rating_scorer, cache, 1e9, ("doc_id",), wave=1.0)
    return fine.select("review_id", "sentiment", F.lit(None).cast("string").alias("failed_reason")).unionByName(
        failed.select("review_id", F.lit(None).cast("string").alias("sentiment"), "failed_reason")
    )


@query
def k07_call_cost(spark, sf):
    costs = inference.call_cost(b.calls(spark, sf))
    return costs.select(
        "call_id", "model", F.col("cost_usd").cast("decimal(18,6)").cast("double").alias("cost_usd")
    )


@query
def k07_cost_breakdown(spark, sf):
    return inference.cost_breakdown(b.calls(spark, sf))


@query
def k08_within_budget(spark, sf):
    costs = inference.call_cost(b.calls(spark, sf))
    return inference.within_budget(costs, 3.0, ["call_id"]).select(
        "call_id", F.col("spent_before").cast("decimal(18,6)").cast("double").alias("spent_before")
    )


@query
def k09_sample(spark, sf):
    return inference.sample_n(b.reviews_fact(spark, sf), 100).select("review_id", "brand")


@query
def k09_consistency(spark, sf):
    first, second = b.two_passes(spark, sf)
    return inference.consistency(first, second)


@query
def k10_rule_labels(spark, sf):
    return classified(spark, sf).select(
        "review_id", "primary_theme", "sentiment", "sentiment_confidence", "severity",
        "failure_mode", "failure_timeline", "has_actionable_signal", "actionable_detail",
    )


@query
def k10_rule_lists(spark, sf):
    return classified(spark, sf).select(
        "review_id",
        F.array_join(
            F.transform(
                "competitor_mentions", lambda m: F.concat(m["brand"], F.lit(":"), m["context"])
            ),
            LISTED,
        ).alias("competitor_mentions"),
        text_of("key_phrases"),
        text_of("features_mentioned"),
    )


# --- Quality ------------------------------------------------------------------


def checked(spark: SparkSession, sf: str) -> DataFrame:
    """Classified reviews; some of them with labels taken from another place."""
    odd = F.col("doc_id") % 4 == 0
    return classified(spark, sf).withColumns(
        {
            "key_phrases": F.when(
                odd, F.array(F.concat("title", F.lit(" zzz qqq")), F.concat("brand", F.lit(" xx yy")))
            ).otherwise(F.col("key_phrases")),
            "features_mentioned": F.when(odd, F.array("brand", F.lit("of zzz"))).otherwise(
                F.col("features_mentioned")
            ),
            "sentiment": F.when(odd, "positive").otherwise(F.col("sentiment")),
        }
    )


@query
def e01_phrase_grounding(spark, sf):
    return quality.phrase_grounding(checked(spark, sf))


@query
def e01_ungrounded_examples(spark, sf):
    return quality.ungrounded_examples(checked(spark, sf))


@query
def e02_feature_grounding(spark, sf):
    return quality.feature_grounding(checked(spark, sf))


@query
def e03_rating_alignment(spark, sf):
    return quality.rating_alignment(checked(spark, sf))


@query
def e03_misaligned_examples(spark, sf):
    return quality.misaligned_examples(checked(spark, sf))


@query
def e04_severity_distribution(spark, sf):
    return quality.severity_distribution(b.reviews_fact(spark, sf))


@query
def e05_coverage(spark, sf):
    return quality.coverage(checked(spark, sf))


@query
def e06_quality_issues(spark, sf):
    return quality.quality_issues(checked(spark, sf))


# --- Analysis -----------------------------------------------------------------


@query
def a01_summary_stats(spark, sf):
    return issues.summary_stats(b.reviews_fact(spark, sf))


@query
def a02_avg_rating_by_brand(spark, sf):
    return issues.avg_rating_by(b.reviews_fact(spark, sf))


def _counts(column: str) -> Query:
    return lambda spark, sf: issues.value_counts(b.reviews_fact(spark, sf), column)


QUERIES["a03_counts_by_category"] = _counts("category")
QUERIES["a03_counts_by_brand"] = _counts("brand")
QUERIES["a03_counts_by_sentiment"] = _counts("sentiment")


def ranked_issues(spark: SparkSession, sf: str) -> DataFrame:
    return issues.top_issues(b.reviews_fact(spark, sf), AS_OF)


ISSUE_VALUES = [
    "category", "brand", "primary_theme", "rank", "frequency", "avg_severity",
    "recency_weight", "impact_score", "top_failure_mode",
]


@query
def a04_top_issues(spark, sf):
    return ranked_issues(spark, sf).select(
        *ISSUE_VALUES, text_of("affected_products"), text_of("sample_quotes")
    )


@query
def a04_all_issue_scores(spark, sf):
    return issues.issue_scores(b.reviews_fact(spark, sf), AS_OF)


@query
def a05_theme_score(spark, sf):
    return competition.theme_scores(b.reviews_fact(spark, sf)).withColumn(
        "score", F.rint(F.col("score") * 1e6) / 1e6
    )


def comparison(spark: SparkSession, sf: str) -> DataFrame:
    return competition.competitor_comparison(b.reviews_fact(spark, sf), OWN)


@query
def a06_competitor_comparison(spark, sf):
    return comparison(spark, sf)


def emerging(spark: SparkSession, sf: str) -> DataFrame:
    return issues.emerging_issues(b.reviews_fact(spark, sf), AS_OF)


@query
def a07_emerging_issues(spark, sf):
    return emerging(spark, sf)


def gaps(spark: SparkSession, sf: str) -> DataFrame:
    return competition.feature_gaps(b.reviews_fact(spark, sf), OWN)


@query
def a08_feature_gaps(spark, sf):
    return gaps(spark, sf)


@query
def a09_phrase_counts(spark, sf):
    return issues.phrase_counts(classified(spark, sf))


@query
def a10_return_risk_rows(spark, sf):
    return issues.return_risk_rows(classified(spark, sf), b.SIGNALS).withColumn(
        "risk_signals", F.array_join("risk_signals", LISTED)
    )


@query
def a10_default_signals(spark, sf):
    return issues.return_risk_rows(classified(spark, sf), (*RISK_SIGNALS, "worthless")).select(
        "review_id", text_of("risk_signals")
    )


def risky(spark: SparkSession, sf: str) -> DataFrame:
    return issues.return_risk(classified(spark, sf), b.SIGNALS)


@query
def a11_return_risk(spark, sf):
    return risky(spark, sf).select(
        "product", "return_risk_count", "avg_severity", text_of("top_themes"),
        F.array_join(F.transform("sample_reviews", lambda r: r["review_id"]), LISTED).alias("samples"),
    )


@query
def a12_verified_split(spark, sf):
    return issues.verified_split(b.reviews_fact(spark, sf))


@query
def a13_run_all_from_cube(spark, sf):
    """Every aggregate analysis of a full run, answered from the stored cube."""
    rows = b.reviews_fact(spark, sf)
    stored = Stage(spark, "cube").write(cube.review_cube(rows, AS_OF))
    results = batch.run_all(
        rows.withColumn("key_phrases", F.array("brand")), SETTINGS, stored
    )
    parts = [
        results[name].agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("analysis"), "rows"
        )
        for name in sorted(results)
    ]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


def stored_cube(spark: SparkSession, sf: str) -> DataFrame:
    return Stage(spark, "cube").write(cube.review_cube(b.reviews_fact(spark, sf), AS_OF))


@query
def a13_issue_scores_from_days(spark, sf):
    """Cells by month; one month is stored in part first and then replaced by the whole."""
    rows = b.reviews_fact(spark, sf)
    folder = f"{Stage(spark, 'days').folder}/cells"
    late = F.coalesce(F.trunc("date", "month") == F.lit("2001-10-01").cast("date"), F.lit(False))
    cube.write_days(rows.filter(~late | (F.col("helpful_votes") % 2 == 0)), folder, "month")
    cube.write_days(rows.filter(late), folder, "month")
    return issues.issue_scores(cube.cube_of_days(cube.read_days(spark, folder), AS_OF), AS_OF)


@query
def a13_issue_scores_from_cube(spark, sf):
    return issues.issue_scores(stored_cube(spark, sf), AS_OF)


@query
def a13_comparison_from_cube(spark, sf):
    return competition.competitor_comparison(stored_cube(spark, sf), OWN)


@query
def a13_emerging_from_cube(spark, sf):
    return issues.emerging_issues(stored_cube(spark, sf), AS_OF)


@query
def a13_verified_split_from_cube(spark, sf):
    return issues.verified_split(stored_cube(spark, sf))


# --- BI tables ----------------------------------------------------------------


@query
def x01_fact_reviews(spark, sf):
    return star.fact_reviews(classified(spark, sf), OWN).drop("doc_id")


@query
def x02_dim_brand(spark, sf):
    return star.dim_brand(b.reviews_fact(spark, sf), OWN)


@query
def x03_dim_category(spark, sf):
    return star.dim_category(b.reviews_fact(spark, sf))


@query
def x04_dim_date(spark, sf):
    return star.dim_date(b.reviews_fact(spark, sf))


@query
def x05_agg_top_issues(spark, sf):
    return star.agg_top_issues(ranked_issues(spark, sf))


@query
def x06_agg_comparison_by_category(spark, sf):
    return comparison(spark, sf).groupBy("category").agg(
        F.count(F.lit(1)).alias("comparisons"),
        F.sum("our_sample_size").alias("own_reviews"),
    )


@query
def x07_star_tables(spark, sf):
    rows = classified(spark, sf)
    tables = star.star_tables(rows, OWN, AS_OF, comparison(spark, sf), emerging(spark, sf))
    parts = [
        t.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows")
        for n, t in tables.items()
    ]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


def star_of_lines(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    rows = classified(spark, sf)
    return star.star_tables(rows, OWN, AS_OF, comparison(spark, sf), emerging(spark, sf))


@query
def x07_star_comparison(spark, sf):
    return star_of_lines(spark, sf)["agg_competitor_comparison"]


@query
def x07_star_emerging(spark, sf):
    return star_of_lines(spark, sf)["agg_emerging_issues"]


@query
def x08_flat_reviews(spark, sf):
    return star.flat_reviews(classified(spark, sf), OWN).drop("doc_id")


@query
def x09_brand_sentiment_pivot(spark, sf):
    return star.brand_sentiment_pivot(b.reviews_fact(spark, sf))


@query
def x10_theme_category_pivot(spark, sf):
    return star.theme_category_pivot(b.reviews_fact(spark, sf))


@query
def x11_brand_scorecard(spark, sf):
    return scorecards.brand_scorecard(b.reviews_fact(spark, sf))


@query
def x12_star_join(spark, sf):
    rows = classified(spark, sf)
    fact = star.fact_reviews(rows, OWN)
    joined = star.star_join(
        fact, star.dim_brand(rows, OWN), star.dim_category(rows), star.dim_date(rows)
    )
    return joined.groupBy("category_label", "brand_type", "month_year").agg(
        F.count(F.lit(1)).alias("reviews")
    )


@query
def x12_star_slice(spark, sf):
    """Two quarters of the facts, which are stored by month."""
    rows = classified(spark, sf)
    folder = f"{Stage(spark, 'star').folder}/fact"
    star.write_fact_by_month(star.fact_reviews(rows, OWN), folder)
    dates = star.dim_date(rows).filter(F.col("quarter").isin("Q1", "Q3") & (F.col("year") == 2024))
    joined = star.star_join(
        spark.read.parquet(folder), star.dim_brand(rows, OWN), star.dim_category(rows), dates, "inner"
    )
    return joined.groupBy("category_label", "brand_type", "month_year").agg(F.count(F.lit(1)).alias("reviews"))


# --- Measures -----------------------------------------------------------------


@query
def m01_headline_measures(spark, sf):
    return scorecards.measure_by(b.reviews_fact(spark, sf), "category", "brand").withColumns(
        {c: F.rint(F.col(c) * 1e6) / 1e6 for c in ("avg_rating", "negative_pct", "avg_severity", "verified_pct")}
    )


@query
def m02_m03_health_and_band(spark, sf):
    return scorecards.health_by(b.reviews_fact(spark, sf), "category", "brand")


@query
def m04_sentiment_delta(spark, sf):
    return scorecards.sentiment_delta_by(comparison(spark, sf), "competitor", "theme").withColumn(
        "sentiment_delta", F.rint(F.col("sentiment_delta") * 1e6) / 1e6
    )


@query
def m05_theme_score(spark, sf):
    return scorecards.theme_score_by(b.reviews_fact(spark, sf), "primary_theme").withColumn(
        "theme_score", F.rint(F.col("theme_score") * 1e6) / 1e6
    )


@query
def m06_issue_growth(spark, sf):
    return scorecards.growth_rate_by(emerging(spark, sf), "theme").withColumn(
        "issue_growth_rate", F.rint(F.col("issue_growth_rate") * 1e6) / 1e6
    )


@query
def m06_issue_impact(spark, sf):
    return scorecards.impact_by(ranked_issues(spark, sf), "brand").withColumn(
        "issue_impact_score", F.rint(F.col("issue_impact_score") * 1e6) / 1e6
    )


# --- Exploration --------------------------------------------------------------


@query
def d01_filter_reviews(spark, sf):
    return explore.filter_reviews(
        b.reviews_fact(spark, sf), ["small", "promo"], ["Brand#1", "Brand#3"],
        ["negative", "mixed"], 3, True,
    ).select("review_id", "category", "brand", "sentiment", "severity")


@query
def d01_own_brand_preset(spark, sf):
    return explore.own_brand_preset(b.reviews_fact(spark, sf), OWN)


@query
def d02_selection_counts(spark, sf):
    return explore.selection_counts(
        b.reviews_fact(spark, sf), F.col("category").isin("small", "promo") & (F.col("severity") >= 2)
    )


@query
def d03_kpi_row(spark, sf):
    return explore.kpi_row(b.reviews_fact(spark, sf))


@query
def d04_brand_health(spark, sf):
    return scorecards.brand_health(b.reviews_fact(spark, sf))


@query
def d05_theme_breakdown(spark, sf):
    return explore.theme_breakdown(b.reviews_fact(spark, sf))


@query
def d06_own_brand_panel(spark, sf):
    return scorecards.own_brand_panel(b.reviews_fact(spark, sf), OWN)


@query
def d07_rating_histogram(spark, sf):
    return explore.rating_histogram(b.reviews_fact(spark, sf))


@query
def d07_product_histogram(spark, sf):
    return explore.rating_histogram(b.reviews_fact(spark, sf), "product_name")


@query
def d08_issue_chart(spark, sf):
    return explore.issue_chart(ranked_issues(spark, sf), "small")


@query
def d09_issue_details(spark, sf):
    return explore.issue_details(ranked_issues(spark, sf)).select(
        "category", "rank", "brand", "theme_label", "impact_score",
        text_of("affected_products"), text_of("sample_quotes"),
    )


@query
def d10_live_issues(spark, sf):
    return explore.live_issues(b.reviews_fact(spark, sf)).withColumns(
        {c: F.rint(F.col(c) * 1e6) / 1e6 for c in ("avg_severity", "impact")}
    )


@query
def d11_delta_heatmap(spark, sf):
    table = explore.delta_heatmap(comparison(spark, sf), "small")
    return table.withColumns({t: F.rint(F.col(t) * 1e6) / 1e6 for t in THEMES})


@query
def d12_leads_and_lags(spark, sf):
    return explore.leads_and_lags(comparison(spark, sf))


@query
def d13_gap_table(spark, sf):
    return explore.with_theme_label(gaps(spark, sf))


@query
def d14_rating_comparison(spark, sf):
    return explore.rating_comparison(b.reviews_fact(spark, sf))


@query
def d15_product_stats(spark, sf):
    return explore.product_stats(b.reviews_fact(spark, sf))


@query
def d16_product_complaints(spark, sf):
    return explore.product_complaints(b.reviews_fact(spark, sf), 8)


@query
def d17_product_failures(spark, sf):
    return explore.product_failures(b.reviews_fact(spark, sf), 5)


@query
def d18_product_samples(spark, sf):
    return explore.product_samples(classified(spark, sf), "negative")


@query
def d19_monthly_sentiment(spark, sf):
    return explore.monthly_sentiment(b.reviews_fact(spark, sf))


@query
def d20_monthly_rating(spark, sf):
    return explore.monthly_rating(b.reviews_fact(spark, sf)).withColumn(
        "avg_rating", F.rint(F.col("avg_rating") * 1e6) / 1e6
    )


@query
def d21_emerging_labelled(spark, sf):
    return explore.with_theme_label(emerging(spark, sf))


@query
def d22_search_text(spark, sf):
    return explore.search_text(classified(spark, sf), "The MIT License").select("review_id", "brand")


@query
def d22_search_index(spark, sf):
    """Several needles, from one to thirty characters, looked up in one index."""
    rows = b.stored_text(spark, sf)
    index = search.TextIndex(spark, Stage(spark, "search").folder).build(rows)
    found = [index.search(n).select(F.lit(n).alias("needle"), F.col("id").alias("review_id")) for n in b.NEEDLES]
    return reduce(DataFrame.unionByName, found)


@query
def d23_sorted_view(spark, sf):
    return explore.sorted_view(b.reviews_fact(spark, sf), "date")


@query
def d23_sorted_view_ascending(spark, sf):
    return explore.sorted_view(b.reviews_fact(spark, sf), "helpful_votes", True)


@query
def d23_shown_of_total(spark, sf):
    return explore.shown_of_total(
        explore.search_text(b.reviews_fact(spark, sf), "small")
    )


@query
def d24_negative_extract(spark, sf):
    return explore.negative_extract(b.reviews_fact(spark, sf)).select("review_id", "rating")


@query
def d25_summary_extract(spark, sf):
    return explore.summary_extract(b.reviews_fact(spark, sf))


@query
def d26_header(spark, sf):
    return issues.summary_stats(b.reviews_fact(spark, sf)).select(
        "total_reviews", "categories", "brands"
    )


# --- Evidence -----------------------------------------------------------------


@query
def r01_engineering_evidence(spark, sf):
    return evidence.engineering_evidence(ranked_issues(spark, sf))


@query
def r02_marketing_evidence(spark, sf):
    return evidence.marketing_evidence(comparison(spark, sf), gaps(spark, sf))


@query
def r03_riskiest_products(spark, sf):
    return evidence.riskiest_products(risky(spark, sf)).select(
        "product", "return_risk_count", "avg_severity"
    )


@query
def r03_complaint_themes(spark, sf):
    return evidence.complaint_themes(ranked_issues(spark, sf)).select(*ISSUE_VALUES)


@query
def r04_scorecard_positions(spark, sf):
    tables = evidence.scorecard_evidence(
        b.reviews_fact(spark, sf), comparison(spark, sf), emerging(spark, sf)
    )
    return tables["positions"].select("category", "our_brand", "competitor", "theme", "delta")


@query
def r04_scorecard_summary(spark, sf):
    return evidence.scorecard_evidence(
        b.reviews_fact(spark, sf), comparison(spark, sf), emerging(spark, sf)
    )["summary"]


@query
def r04_scorecard_emerging(spark, sf):
    return evidence.scorecard_evidence(
        b.reviews_fact(spark, sf), comparison(spark, sf), emerging(spark, sf)
    )["emerging"]


@query
def r05_brief_issues(spark, sf):
    return evidence.brief_issues(ranked_issues(spark, sf), "small", "Brand#1").select(
        *ISSUE_VALUES
    )


@query
def r05_brief_context(spark, sf):
    return evidence.brief_context(comparison(spark, sf), "small").select(
        "category", "our_brand", "competitor", "theme", "delta"
    )


@query
def r06_parse_generated_lists(spark, sf):
    rows = evidence.recommendation_rows(b.answers(spark, sf))
    return rows.select(
        "id", "position", "parse_error", "raw_response",
        F.try_variant_get("item", "$.quote", "string").alias("quote"),
        F.try_variant_get("item", "$.rank", "int").alias("rank"),
    )

