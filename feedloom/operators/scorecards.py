"""Reusable measures and brand scorecards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import BAND_COLOURS, ISSUE_SENTIMENTS, THEME_LABELS
from ..functions.numbers import round_away, round_even
from ..functions.text import theme_label
from .competition import theme_score
from .cube import mean_of, measures, n_all, share_where, verified_share



def headline() -> list[Column]:
    """Total reviews, average rating and severity, negative and verified percentage,
    distinct products: aggregates for any grouping."""
    negative = share_where(F.col("sentiment") == "negative")
    return [
        n_all().alias("total_reviews"),
        mean_of("rating_sum").alias("avg_rating"),
        (negative * 100).alias("negative_pct"),
        mean_of("severity_sum").alias("avg_severity"),
        (verified_share() * 100).alias("verified_pct"),
        F.countDistinct("product_name").alias("distinct_products"),
    ]


def measure_by(df: DataFrame, *keys: str) -> DataFrame:
    return measures(df).groupBy(*keys).agg(*headline())


def health(rating: Column, negative_pct: Column, severity: Column) -> Column:
    """40 points for the rating, 30 for few negatives, 30 for low severity."""
    return rating / 5 * 40 + (F.lit(100) - negative_pct) / 100 * 30 + (F.lit(5) - severity) / 4 * 30


def rounded_health(
    rating: Column, negative_pct: Column, severity: Column, rounding=round_even
) -> Column:
    """Whole-number score from components rounded to two places."""
    parts = [rounding(c, 2) for c in (rating, negative_pct, severity)]
    return rounding(health(*parts), 0).cast("int")


def band(score: Column) -> Column:
    return F.when(score >= 65, "Green").when(score >= 45, "Yellow").otherwise("Red")


def band_colour(name: Column) -> Column:
    return (
        F.when(name == "Green", BAND_COLOURS["Green"])
        .when(name == "Yellow", BAND_COLOURS["Yellow"])
        .otherwise(BAND_COLOURS["Red"])
    )


def brand_health(df: DataFrame) -> DataFrame:
    """Scorecard per brand from rounded components, best first."""
    return (
        measures(df)
        .groupBy("brand")
        .agg(
            mean_of("rating_sum").alias("rating"),
            n_all().alias("review_count"),
            (share_where(F.col("sentiment") == "negative") * 100).alias("negative"),
            mean_of("severity_sum").alias("severity"),
        )
        .select(
            "brand",
            round_even(F.col("rating"), 2).alias("avg_rating"),
            "review_count",
            round_even(F.col("negative"), 2).alias("neg_pct"),
            round_even(F.col("severity"), 2).alias("avg_severity"),
            rounded_health(F.col("rating"), F.col("negative"), F.col("severity")).alias(
                "health_score"
            ),
        )
        .orderBy(F.desc("health_score"), "brand")
    )


def health_by(df: DataFrame, *keys: str) -> DataFrame:
    """Health score with its band and colour under any grouping.

    This measure rounds half away from zero; the scorecard rounds half to even.
    """
    return (
        measure_by(df, *keys)
        .select(
            *keys,
            rounded_health(
                F.col("avg_rating"), F.col("negative_pct"), F.col("avg_severity"), round_away
            ).alias("health_score"),
        )
        .withColumn("band", band(F.col("health_score")))
        .withColumn("colour", band_colour(F.col("band")))
    )


def own_brand_panel(df: DataFrame, own_brands) -> DataFrame:
    """Own brands: counts, truncated score, band and most frequent issue theme.

    One pass reduces the reviews to brand and theme; the panel and the modal
    theme (the first by name among equals) both come from that.
    """
    themes = (
        measures(df)
        .filter(F.col("brand").isin(list(own_brands)))
        .groupBy("brand", "primary_theme")
        .agg(
            n_all().alias("n"),
            F.sum("rating_sum").alias("rating_sum"),
            F.sum("rated").alias("rated"),
            F.sum("severity_sum").alias("severity_sum"),
            F.sum("graded").alias("graded"),
            F.sum(F.when(F.col("sentiment") == "negative", F.col("n_reviews"))).alias("negatives"),
            F.sum(
                F.when(F.col("sentiment").isin(ISSUE_SENTIMENTS), F.col("n_reviews"))
            ).alias("issues"),
        )
    )
    modal = F.min(
        F.when(
            F.col("issues").isNotNull(),
            F.struct((-F.col("issues")).alias("order"), F.col("primary_theme").alias("theme")),
        )
    )
    n = F.sum("n").cast("double")
    score = health(F.col("rating"), F.col("negative"), F.col("severity")).cast("int")
    return (
        themes.groupBy("brand")
        .agg(
            F.sum("n").alias("reviews"),
            mean_of("rating_sum").alias("rating"),
            (F.coalesce(F.sum("negatives"), F.lit(0)).cast("double") / n * 100).alias("negative"),
            mean_of("severity_sum").alias("severity"),
            modal["theme"].alias("top_issue"),
        )
        .withColumn("score", score)
        .select(
            "brand",
            "reviews",
            round_even(F.col("rating"), 2).alias("avg_rating"),
            round_even(F.col("negative"), 0).alias("negative_pct"),
            F.coalesce(theme_label(F.col("top_issue"), THEME_LABELS), F.lit("N/A")).alias(
                "top_issue"
            ),
            "score",
            band(F.col("score")).alias("band"),
        )
    )


def brand_scorecard(df: DataFrame) -> DataFrame:
    """Average rating and severity, count and negative share per brand, three places."""
    return (
        measures(df)
        .groupBy("brand")
        .agg(
            round_even(mean_of("rating_sum"), 3).alias("avg_rating"),
            round_even(mean_of("severity_sum"), 3).alias("avg_severity"),
            n_all().alias("review_count"),
            round_even(share_where(F.col("sentiment") == "negative"), 3).alias("neg_pct"),
        )
    )


def theme_score_by(df: DataFrame, *keys: str) -> DataFrame:
    return measures(df).groupBy(*keys).agg(theme_score().alias("theme_score"))


def sentiment_delta_by(comparison: DataFrame, *keys: str) -> DataFrame:
    return comparison.groupBy(*keys).agg(F.avg("delta").alias("sentiment_delta"))


def growth_rate_by(emerging: DataFrame, *keys: str) -> DataFrame:
    return emerging.groupBy(*keys).agg(F.avg("growth_factor").alias("issue_growth_rate"))


def impact_by(issues: DataFrame, *keys: str) -> DataFrame:
    return issues.groupBy(*keys).agg(F.sum("impact_score").alias("issue_impact_score"))
