"""Star schema, pivots and flat extracts for BI tools."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SENTIMENTS
from .cube import measures, n_where
from .issues import top_issues

SEPARATOR = ", "

LIST_COLUMNS = ["competitor_mentions", "features_mentioned", "secondary_themes", "key_phrases"]


def _joined(column: str) -> Column:
    return F.coalesce(F.array_join(column, SEPARATOR), F.lit(""))


def _length(column: str) -> Column:
    return F.coalesce(F.size(column), F.lit(0))


def fact_reviews(df: DataFrame, own_brands) -> DataFrame:
    """One flat row per classified review; lists become text and counts."""
    named = F.filter(
        F.transform("competitor_mentions", lambda m: F.coalesce(m["brand"], F.lit(""))),
        lambda b: b != "",
    )
    favourable = F.filter("competitor_mentions", lambda m: m["context"] == "favorable")
    brands = F.array_join(F.array_sort(F.array_distinct(named)), SEPARATOR)
    return df.withColumns(
        {
            "competitor_mention_count": _length("competitor_mentions"),
            "competitor_brands_mentioned": F.coalesce(brands, F.lit("")),
            "favorable_competitor_mentions": F.coalesce(F.size(favourable), F.lit(0)),
            "feature_count": _length("features_mentioned"),
            "secondary_themes": _joined("secondary_themes"),
            "features_mentioned": _joined("features_mentioned"),
            "key_phrases": _joined("key_phrases"),
            "is_own_brand": F.col("brand").isin(list(own_brands)),
            "is_negative": F.col("sentiment") == "negative",
            "is_positive": F.col("sentiment") == "positive",
            "review_date": F.col("date"),
        }
    ).drop("competitor_mentions", "date")


def dim_brand(df: DataFrame, own_brands, own_label: str = "Own") -> DataFrame:
    own = F.col("brand").isin(list(own_brands))
    return (
        df.select("brand")
        .distinct()
        .select(
            "brand",
            own.alias("is_own_brand"),
            F.when(own, own_label).otherwise("Competitor").alias("brand_type"),
        )
        .orderBy("brand")
    )


def dim_category(df: DataFrame) -> DataFrame:
    return (
        df.select("category")
        .distinct()
        .select("category", F.initcap(F.replace("category", F.lit("_"), F.lit(" "))).alias("category_label"))
        .orderBy("category")
    )


def dim_date(df: DataFrame, column: str = "date") -> DataFrame:
    """Contiguous calendar from the first to the last date, empty without dates."""
    day = F.col("date")
    return (
        df.agg(F.min(column).alias("first"), F.max(column).alias("last"))
        .filter(F.col("first").isNotNull())
        .select(F.explode(F.sequence("first", "last")).alias("date"))
        .select(
            "date",
            F.year(day).alias("year"),
            F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("quarter"),
            F.month(day).alias("month_num"),
            F.date_format(day, "MMM").alias("month_name"),
            F.date_format(day, "MMM yyyy").alias("month_year"),
            (F.year(day) * 100 + F.month(day)).alias("year_month_sort"),
            F.dayofmonth(day).alias("day"),
        )
    )


def agg_top_issues(issues: DataFrame) -> DataFrame:
    """Ranked issues with the product list joined and one quote of 500 characters."""
    return issues.select(
        "category",
        "rank",
        "brand",
        F.col("primary_theme").alias("theme"),
        "frequency",
        "avg_severity",
        "recency_weight",
        "impact_score",
        "top_failure_mode",
        _joined("affected_products").alias("affected_products"),
        F.coalesce(
            F.substring(F.try_element_at("sample_quotes", F.lit(1)), 1, 500), F.lit("")
        ).alias("sample_quote"),
    )


def flat_reviews(df: DataFrame, own_brands) -> DataFrame:
    """Reviews without list columns but with their counts."""
    return df.withColumns(
        {
            "competitor_mention_count": _length("competitor_mentions"),
            "feature_count": _length("features_mentioned"),
            "is_own_brand": F.col("brand").isin(list(own_brands)),
        }
    ).drop(*LIST_COLUMNS)


def brand_sentiment_pivot(df: DataFrame) -> DataFrame:
    """Reviews per brand and sentiment; the sentiments are fixed, so no extra pass."""
    return (
        measures(df)
        .groupBy("brand")
        .agg(*[n_where(F.col("sentiment") == s).alias(s) for s in SENTIMENTS])
    )


def theme_category_pivot(df: DataFrame, categories=None) -> DataFrame:
    """Reviews per theme, one column per category.

    Without a list of categories they are found first, from the small table of
    theme and category counts.
    """
    counts = measures(df).groupBy("primary_theme", "category").agg(F.sum("n_reviews").alias("n"))
    wide = counts.groupBy("primary_theme").pivot("category", categories)
    return wide.agg(F.sum("n")).na.fill(0)


MONTH = "review_month"


def write_fact_by_month(fact: DataFrame, path: str) -> None:
    """Store the fact table in one partition per month (year * 100 + month; null without a date)."""
    day = F.col("review_date")
    tasks = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Months hold very different numbers of rows: days spread them over the tasks.
    rows = fact.withColumn(MONTH, F.year(day) * 100 + F.month(day)).repartition(tasks, MONTH, day)
    rows.write.mode("overwrite").partitionBy(MONTH).parquet(path)


def star_join(
    fact: DataFrame, brands: DataFrame, categories: DataFrame, dates: DataFrame, how: str = "left"
) -> DataFrame:
    """Fact rows with the attributes of their dimensions.

    Rows without a match stay, or with `how="inner"` go: dimensions that were filtered then
    slice the facts. If the facts are stored by month, a slice of the dates is turned into the months to read
    while the query runs.
    """
    on_date = fact["review_date"] == dates["date"]
    if MONTH in fact.columns:
        on_date = on_date & (fact[MONTH] == dates["year_month_sort"])
    return (
        fact.join(dates, on_date, how)
        .drop("date", MONTH)
        .join(brands.drop("is_own_brand"), "brand", how)
        .join(categories, "category", how)
    )


def star_tables(
    df: DataFrame, own_brands, as_of, comparison: DataFrame, emerging: DataFrame, issues: DataFrame | None = None
) -> dict[str, DataFrame]:
    """All tables of the export by name."""
    ranked = issues if issues is not None else top_issues(df, as_of)
    return {
        "fact_reviews": fact_reviews(df, own_brands),
        "dim_date": dim_date(df),
        "dim_brand": dim_brand(df, own_brands),
        "dim_category": dim_category(df),
        "agg_top_issues": agg_top_issues(ranked),
        "agg_competitor_comparison": comparison,
        "agg_emerging_issues": emerging,
    }
