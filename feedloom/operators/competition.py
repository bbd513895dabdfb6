"""Own brands against competitors, theme by theme."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import ratio, round_even
from .cube import mean_of, measures, n_all, n_where


def theme_score() -> Column:
    """Aggregate: mean of the net sentiment share and the rating share, -0.4 to 1."""
    positive = n_where(F.col("sentiment") == "positive")
    negative = n_where(F.col("sentiment") == "negative")
    rating = mean_of("rating_sum")
    return (ratio(positive - negative, F.sum("n_reviews")) + rating / 5) / 2


def theme_scores(df: DataFrame, keys=("category", "brand", "primary_theme")) -> DataFrame:
    """Sample size and score for every group of the given columns."""
    return (
        measures(df)
        .groupBy(*keys)
        .agg(n_all().alias("sample_size"), theme_score().alias("score"))
    )


def insight(delta: Column) -> Column:
    """Sentence for an unrounded score difference; no difference counts as behind."""
    wording = (
        F.when(delta > 0.2, F.lit(" significantly outperforms "))
        .when(delta > 0, F.lit(" slightly ahead of "))
        .when(delta > -0.2, F.lit(" slightly behind "))
        .otherwise(F.lit(" significantly underperforms "))
    )
    return F.concat("our_brand", wording, "competitor", F.lit(" on "), "theme")


def opportunity(delta: Column) -> Column:
    """What to do about an unrounded score difference, empty if it is small."""
    return (
        F.when(
            delta < -0.1,
            F.concat(F.lit("Improve "), "theme", F.lit(" to close gap with "), "competitor"),
        )
        .when(
            delta > 0.2,
            F.concat(
                F.lit("Leverage "), "theme", F.lit(" advantage in marketing vs "), "competitor"
            ),
        )
        .otherwise(F.lit(""))
    )


def competitor_comparison(df: DataFrame, own_brands, min_n: int = 3) -> DataFrame:
    """Every own brand against every other brand with the same category and theme.

    The reviews are read once and reduced to one score per category, brand and
    theme. One row per category, theme and own brand, as many as the list of own brands
    allows, then stands beside every row of its theme as columns: each own brand is one
    aggregate, so no brands are collected and the reviews are not aggregated twice.
    """
    own = list(own_brands)
    side = F.struct(F.col("brand"), F.col("score"), F.col("sample_size").alias("n"))
    same = Window.partitionBy("category", "primary_theme")
    ours = F.array_compact(
        F.array(*[F.max(F.when(F.col("brand") == name, side)).over(same) for name in own])
    )
    scores = theme_scores(df).filter(F.col("sample_size") >= min_n)
    delta = F.col("o.score") - F.col("c.score")
    return (
        scores.withColumn("ours", ours)
        .filter(~F.col("brand").isin(own))
        .select("category", F.col("primary_theme").alias("theme"), side.alias("c"), F.explode("ours").alias("o"))
        .withColumn("our_brand", F.col("o.brand"))
        .withColumn("competitor", F.col("c.brand"))
        .select(
            "category",
            "our_brand",
            "competitor",
            "theme",
            round_even(F.col("o.score"), 2).alias("our_score"),
            round_even(F.col("c.score"), 2).alias("competitor_score"),
            round_even(delta, 2).alias("delta"),
            F.col("o.n").alias("our_sample_size"),
            F.col("c.n").alias("competitor_sample_size"),
            insight(delta).alias("insight"),
            opportunity(delta).alias("opportunity"),
        )
    )


def feature_gaps(
    df: DataFrame, own_brands, min_n: int = 3, own_label: str | None = None
) -> DataFrame:
    """Themes competitors are praised for while no own brand is, per category.

    Praise is counted in one pass; whether an own brand is praised for the same
    theme is then looked up among the brands of that category and theme.
    """
    own = list(own_brands)
    label = own_label or "/".join(own)
    is_own = F.col("brand").isin(own)
    same_theme = Window.partitionBy("category", "primary_theme")
    return (
        measures(df)
        .filter(F.col("sentiment") == "positive")
        .groupBy("category", "brand", "primary_theme")
        .agg(n_all().alias("competitor_positive_count"))
        .withColumn("own_praised", F.max(is_own).over(same_theme))
        .filter(~is_own & ~F.col("own_praised") & (F.col("competitor_positive_count") >= min_n))
        .select(
            "category",
            F.col("brand").alias("competitor"),
            F.col("primary_theme").alias("theme"),
            "competitor_positive_count",
            F.concat(
                "brand",
                F.lit(" praised for "),
                "primary_theme",
                F.lit(f" — {label} has no positive mentions"),
            ).alias("gap_description"),
        )
    )
