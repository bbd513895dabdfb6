"""Interactive queries over the classified reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import ISSUE_SENTIMENTS, THEME_LABELS, THEMES
from ..functions.numbers import ratio, round_even
from ..functions.text import snippet, theme_label
from .cube import mean_of, measures, n_all, share_where, verified_share

NEGATIVE = "negative"


def with_theme_label(df: DataFrame, theme: str = "theme", name: str = "theme_label") -> DataFrame:
    return df.withColumn(name, theme_label(F.col(theme), THEME_LABELS))


def filter_reviews(
    df: DataFrame,
    categories=None,
    brands=None,
    sentiments=None,
    min_severity: int = 1,
    verified_only: bool = False,
) -> DataFrame:
    """Conjunction of the given selections; all of them can reach the scan."""
    for column, values in (("category", categories), ("brand", brands), ("sentiment", sentiments)):
        if values is not None:
            df = df.filter(F.col(column).isin(list(values)))
    df = df.filter(F.col("severity") >= min_severity)
    return df.filter("verified_purchase") if verified_only else df


def own_brand_preset(df: DataFrame, own_brands) -> DataFrame:
    """The own brands that occur in the data."""
    return df.filter(F.col("brand").isin(list(own_brands))).select("brand").distinct()


def selection_counts(df: DataFrame, selected: Column) -> DataFrame:
    """Selected and total reviews and the negative percentage of the selection."""
    n, negative = F.col("n_reviews"), F.col("sentiment") == NEGATIVE
    chosen = F.sum(F.when(selected, n))
    return measures(df).agg(
        F.coalesce(chosen, F.lit(0)).alias("showing"),
        n_all().alias("total"),
        round_even(
            ratio(F.coalesce(F.sum(F.when(selected & negative, n)), F.lit(0)), chosen) * 100, 1
        ).alias("negative_rate"),
    )


def kpi_row(df: DataFrame) -> DataFrame:
    """Six headline values and whether three of them are good or need watching."""
    verdict = lambda good: F.when(good, "Good").otherwise("Watch")
    return (
        measures(df)
        .agg(
            n_all().alias("reviews"),
            mean_of("rating_sum").alias("rating"),
            share_where(F.col("sentiment") == NEGATIVE).alias("negative"),
            mean_of("severity_sum").alias("severity"),
            verified_share().alias("verified"),
            F.countDistinct("product_name").alias("products"),
        )
        .select(
            "reviews",
            round_even(F.col("rating"), 2).alias("avg_rating"),
            round_even(F.col("negative") * 100, 1).alias("negative_pct"),
            round_even(F.col("severity"), 1).alias("avg_severity"),
            round_even(F.col("verified") * 100, 0).alias("verified_pct"),
            "products",
            verdict(F.col("rating") >= 3.5).alias("rating_status"),
            verdict(F.col("negative") <= 0.3).alias("negative_status"),
            verdict(F.col("severity") <= 3).alias("severity_status"),
        )
    )


def theme_breakdown(df: DataFrame, n: int = 8) -> DataFrame:
    """Most frequent themes of negative and mixed reviews with their share."""
    themes = (
        measures(df)
        .filter(F.col("sentiment").isin(ISSUE_SENTIMENTS))
        .groupBy("primary_theme")
        .agg(n_all().alias("issues"))
        # One row per theme meets here, not the reviews.
        .withColumn("total_issues", F.sum("issues").over(Window.partitionBy(F.lit(0))))
    )
    return with_theme_label(
        themes.withColumn("share", round_even(ratio(F.col("issues"), F.col("total_issues")), 4)),
        "primary_theme",
    ).orderBy(F.desc("issues"), "primary_theme").limit(n)


def rating_histogram(df: DataFrame, *keys: str) -> DataFrame:
    return measures(df).groupBy(*keys, "rating").agg(n_all().alias("reviews"))


def issue_chart(issues: DataFrame, category: str) -> DataFrame:
    """Ranked issues of one category for a chart grouped by brand."""
    return with_theme_label(
        issues.filter(F.col("category") == category).select(
            "brand", "primary_theme", "impact_score", "rank"
        ),
        "primary_theme",
    )


def issue_details(issues: DataFrame, n: int = 8) -> DataFrame:
    """The first issues of each category with quotes of at most 400 characters."""
    return with_theme_label(
        issues.filter(F.col("rank") <= n).withColumn(
            "sample_quotes", F.transform("sample_quotes", lambda q: F.substring(q, 1, 400))
        ),
        "primary_theme",
    )


def live_issues(df: DataFrame, n: int = 15) -> DataFrame:
    """Issues by count times average severity, without recency."""
    return with_theme_label(
        measures(df)
        .filter(F.col("sentiment").isin(ISSUE_SENTIMENTS))
        .groupBy("brand", "primary_theme", "category")
        .agg(n_all().alias("count"), mean_of("severity_sum").alias("avg_severity"))
        .withColumn("impact", F.col("count") * F.col("avg_severity"))
        .orderBy(F.desc("impact"), "brand", "primary_theme", "category")
        .limit(n),
        "primary_theme",
    )


def delta_heatmap(comparison: DataFrame, category: str | None = None) -> DataFrame:
    """Mean score difference per competitor, one column per theme, 0 where unknown."""
    if category is not None:
        comparison = comparison.filter(F.col("category") == category)
    cells = [
        F.coalesce(F.avg(F.when(F.col("theme") == t, F.col("delta"))), F.lit(0.0)).alias(t)
        for t in THEMES
    ]
    return comparison.groupBy("competitor").agg(*cells)


def leads_and_lags(comparison: DataFrame, n: int = 5, limit: float = 0.1) -> DataFrame:
    """Per category the largest differences below -limit and above +limit."""
    side = F.when(F.col("delta") < -limit, "lag").when(F.col("delta") > limit, "lead")
    order = Window.partitionBy("category", "side").orderBy(
        F.desc(F.abs("delta")), "our_brand", "competitor", "theme"
    )
    return with_theme_label(
        comparison.withColumn("side", side)
        .filter(F.col("side").isNotNull())
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n)
        .select("category", "side", "rank", "our_brand", "competitor", "theme", "delta")
    )


def rating_comparison(df: DataFrame) -> DataFrame:
    return (
        measures(df)
        .groupBy("brand")
        .agg(round_even(mean_of("rating_sum"), 2).alias("avg_rating"), n_all().alias("count"))
        .orderBy(F.desc("avg_rating"), "brand")
    )


def product_stats(df: DataFrame) -> DataFrame:
    return (
        measures(df)
        .groupBy("product_name", "brand", "category")
        .agg(
            n_all().alias("reviews"),
            round_even(mean_of("rating_sum"), 2).alias("avg_rating"),
            round_even(share_where(F.col("sentiment") == NEGATIVE) * 100, 2).alias("neg_pct"),
            round_even(mean_of("severity_sum"), 2).alias("avg_severity"),
            round_even(share_where(F.col("sentiment") == "positive") * 100, 2).alias("pos_pct"),
        )
        .orderBy(F.desc("reviews"), "product_name", "brand", "category")
    )


def _top_per_product(counts: DataFrame, value: str, n: int) -> DataFrame:
    order = Window.partitionBy("product_name").orderBy(F.desc("count"), F.asc(value))
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def product_complaints(df: DataFrame, n: int = 8) -> DataFrame:
    """Most frequent issue themes of every product."""
    counts = (
        measures(df)
        .filter(F.col("sentiment").isin(ISSUE_SENTIMENTS))
        .groupBy("product_name", "primary_theme")
        .agg(n_all().alias("count"))
    )
    return with_theme_label(_top_per_product(counts, "primary_theme", n), "primary_theme")


def product_failures(df: DataFrame, n: int = 5) -> DataFrame:
    """Most frequent failure modes of every product."""
    counts = (
        measures(df)
        .filter(F.col("failure_mode").isNotNull())
        .groupBy("product_name", "failure_mode")
        .agg(n_all().alias("count"))
    )
    return _top_per_product(counts, "failure_mode", n)


def product_samples(
    df: DataFrame, sentiment: str | None = None, n: int = 8, order=("date", "review_id")
) -> DataFrame:
    """First reviews of every product with stars and shortened texts."""
    if sentiment is not None:
        df = df.filter(F.col("sentiment") == sentiment)
    window = Window.partitionBy("product_name").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    stars = F.coalesce(F.col("rating").cast("int"), F.lit(0))
    return (
        df.select("product_name", "sentiment", "rating", "title", "review_text", *order)
        .withColumn("position", F.row_number().over(window))
        .filter(F.col("position") <= n)
        .select(
            "product_name",
            "position",
            "sentiment",
            F.concat(F.repeat(F.lit("★"), stars), F.repeat(F.lit("☆"), F.lit(5) - stars)).alias(
                "stars"
            ),
            snippet(F.col("title"), 100).alias("title"),
            snippet(F.col("review_text"), 500).alias("review_text"),
        )
    )


def monthly_sentiment(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("date").isNotNull())
        .groupBy(F.date_format("date", "yyyy-MM").alias("month"), "sentiment")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def monthly_rating(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("date").isNotNull())
        .groupBy(F.date_format("date", "yyyy-MM").alias("month"), "brand")
        .agg(ratio(F.sum("rating"), F.count("rating")).alias("avg_rating"))
    )


def search_text(df: DataFrame, query: str) -> DataFrame:
    """Reviews whose text holds the literal query in any letter case."""
    return df.filter(
        F.coalesce(F.lower("review_text").contains(query.lower()), F.lit(False))
    )


SORTABLE = ["rating", "severity", "date", "helpful_votes"]

DISPLAYED = [
    "brand", "product_name", "category", "rating", "sentiment",
    "primary_theme", "severity", "verified_purchase", "title", "review_text",
]


def sorted_view(df: DataFrame, sort_by: str = "rating", ascending: bool = False, n: int = 500) -> DataFrame:
    """The first rows in the chosen order, nulls last both ways, display columns only."""
    if sort_by not in SORTABLE:
        raise ValueError(f"cannot sort by {sort_by!r}")
    key = F.col(sort_by)
    order = key.asc_nulls_last() if ascending else key.desc_nulls_last()
    return df.orderBy(order, "review_id").limit(n).select(*DISPLAYED)


def shown_of_total(df: DataFrame, n: int = 500) -> DataFrame:
    return measures(df).agg(
        F.least(n_all(), F.lit(n).cast("long")).alias("shown"), n_all().alias("total")
    )


def negative_extract(df: DataFrame) -> DataFrame:
    return df.filter(F.col("sentiment") == NEGATIVE)


def summary_extract(df: DataFrame) -> DataFrame:
    return (
        measures(df)
        .groupBy("brand", "category", "primary_theme")
        .agg(
            n_all().alias("count"),
            round_even(mean_of("rating_sum"), 2).alias("avg_rating"),
            round_even(mean_of("severity_sum"), 2).alias("avg_severity"),
        )
    )
