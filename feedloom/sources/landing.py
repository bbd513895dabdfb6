"""Landing records of marketplaces and forums mapped to raw reviews."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import DATE_FORMATS, NEGATIVE_WORDS, POSITIVE_WORDS
from ..functions.text import count_present, first_label, snippet, strip
from ..schema import RAW

# --- Catalogue ----------------------------------------------------------------


def catalog_df(spark: SparkSession, nested: dict) -> DataFrame:
    """Flatten {category: {brand: [{asin, name}]}} to one row per product."""
    rows = [
        (category, brand, product["asin"], product["name"])
        for category, brands in nested.items()
        for brand, products in brands.items()
        for product in products
    ]
    return spark.createDataFrame(
        rows, "category string, brand string, product_id string, product_name string"
    )


def explode_catalog(nested: DataFrame, column: str = "catalog") -> DataFrame:
    """The same for a map<category, map<brand, array<struct<asin, name>>>> column."""
    return (
        nested.select(F.explode(column).alias("category", "brands"))
        .select("category", F.explode("brands").alias("brand", "products"))
        .select("category", "brand", F.explode("products").alias("product"))
        .select(
            "category",
            "brand",
            F.col("product.asin").alias("product_id"),
            F.col("product.name").alias("product_name"),
        )
    )


# --- Marketplace items --------------------------------------------------------


def parse_date_multi(text: Column, formats=tuple(DATE_FORMATS)) -> Column:
    """The first format that fits, else null."""
    trimmed = strip(text)
    return F.coalesce(
        *[F.try_to_timestamp(trimmed, F.lit(f)).cast("date") for f in formats]
    )


def map_marketplace(items: DataFrame, catalog: DataFrame, url: str = "https://amazon.com/dp/") -> DataFrame:
    """Items (asin, id, rating, title, text, review, date, ...) as raw reviews."""
    text = lambda name: F.coalesce(F.col(name), F.lit(""))
    return (
        items.join(catalog.withColumnRenamed("product_id", "asin"), "asin")
        .select(
            F.concat(F.lit("amz_"), "asin", F.lit("_"), F.coalesce(F.col("id").cast("string"), F.lit(""))).alias(
                "review_id"
            ),
            F.col("asin").alias("product_id"),
            "product_name",
            "brand",
            "category",
            F.coalesce(F.col("rating").cast("double"), F.lit(0.0)).alias("rating"),
            text("title").alias("title"),
            F.coalesce("text", "review", F.lit("")).alias("review_text"),
            parse_date_multi(F.col("date")).alias("date"),
            F.coalesce("isVerified", F.lit(False)).alias("verified_purchase"),
            F.coalesce(F.col("helpfulVotes").cast("int"), F.lit(0)).alias("helpful_votes"),
            F.lit("amazon").alias("source"),
            text("userName").alias("reviewer_name"),
            F.coalesce("url", F.concat(F.lit(url), "asin")).alias("source_url"),
        )
    )


def latest_per_product(df: DataFrame, n: int = 200, id_col: str = "review_id") -> DataFrame:
    """The n newest reviews of every product; undated ones come last."""
    newest = Window.partitionBy("product_id").orderBy(F.col("date").desc_nulls_last(), id_col)
    return (
        df.withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") <= n).drop("_n")
    )


# --- Forum posts --------------------------------------------------------------


def detect_brand(text: Column, brand_keywords) -> Column:
    """First brand, in the order given, with a keyword in the lower-cased text."""
    return first_label(F.lower(text), list(brand_keywords))


def estimate_rating(text: Column, positive=tuple(POSITIVE_WORDS), negative=tuple(NEGATIVE_WORDS)) -> Column:
    """4 if more different positive than negative words occur, 2 if fewer, else 3."""
    low = F.lower(text)
    balance = count_present(low, positive) - count_present(low, negative)
    return F.when(balance > 0, 4.0).when(balance < 0, 2.0).otherwise(3.0)


def forum_sources(
    spark: SparkSession, forums: dict, category: str | None = None, searches: dict | None = None
) -> DataFrame:
    """The (category, forum, query) sources to read, for one category or all."""
    searches = searches or {}
    rows = [
        (c, forum, searches.get(c, f"{c} review"))
        for c, names in forums.items()
        if category in (None, c)
        for forum in names
    ]
    return spark.createDataFrame(rows, "category string, forum string, query string")


def select_posts(posts: DataFrame, sources: DataFrame) -> DataFrame:
    """Posts of the selected forums with the category they are read for."""
    return posts.join(sources, "forum")


def _forum_review(prefix: Column, brand: Column, body: Column, title: Column, positive, negative) -> list[Column]:
    author, permalink = F.coalesce("author", F.lit("")), F.coalesce("permalink", F.lit(""))
    return [
        prefix.alias("review_id"),
        F.concat(F.lit("reddit_"), F.lower(brand), F.lit("_"), "category").alias("product_id"),
        F.concat(brand, F.lit(" (Reddit mention)")).alias("product_name"),
        brand.alias("brand"),
        F.col("category"),
        estimate_rating(body, positive, negative).alias("rating"),
        title.alias("title"),
        snippet(body, 3000).alias("review_text"),
        F.timestamp_seconds("created_utc").cast("date").alias("date"),
        F.lit(False).alias("verified_purchase"),
        F.col("score").cast("int").alias("helpful_votes"),
        F.lit("reddit").alias("source"),
        author.alias("reviewer_name"),
        F.concat(F.lit("https://reddit.com"), permalink).alias("source_url"),
    ]


def branded_posts(posts: DataFrame, brand_keywords) -> DataFrame:
    text = F.concat("title", F.lit(" "), F.coalesce("selftext", F.lit("")))
    return posts.withColumn("brand", detect_brand(text, brand_keywords)).filter(
        F.col("brand").isNotNull()
    )


def map_posts(
    posts: DataFrame, brand_keywords, positive=tuple(POSITIVE_WORDS), negative=tuple(NEGATIVE_WORDS)
) -> DataFrame:
    """Posts that name a brand and have more than 50 characters as raw reviews."""
    return (
        branded_posts(posts, brand_keywords)
        .filter(F.length("selftext") > 50)
        .select(
            *_forum_review(
                F.concat(F.lit("reddit_"), F.col("id").cast("string")),
                F.col("brand"),
                F.col("selftext"),
                F.col("title"),
                positive,
                negative,
            )
        )
    )


def explode_comments(posts: DataFrame) -> DataFrame:
    """Nested comments of landing posts as rows with their position."""
    return posts.select(
        F.col("id").alias("post_id"), F.posexplode("comments").alias("position", "comment")
    ).select("post_id", "position", "comment.*")


def map_comments(
    posts: DataFrame,
    comments: DataFrame,
    brand_keywords,
    first: int = 20,
    positive=tuple(POSITIVE_WORDS),
    negative=tuple(NEGATIVE_WORDS),
) -> DataFrame:
    """The first comments of every branded post as raw reviews.

    A comment has the brand it names itself, else that of its post. Positions are
    cut before the join, so no post brings more than `first` comments to it.
    """
    parents = branded_posts(posts, brand_keywords).select(
        F.col("id").alias("post_id"),
        F.col("brand").alias("post_brand"),
        "category",
        snippet(F.col("title"), 100).alias("title"),
    )
    brand = F.coalesce(detect_brand(F.col("body"), brand_keywords), F.col("post_brand"))
    digest = F.md5(F.col("id").cast("string"))
    return (
        comments.filter((F.col("position") < first) & (F.length("body") > 50))
        .join(parents, "post_id")
        .withColumn("_brand", brand)
        .select(
            *_forum_review(
                F.concat(F.lit("reddit_c_"), digest),
                F.col("_brand"),
                F.col("body"),
                F.col("title"),
                positive,
                negative,
            )
        )
    )


# --- Union --------------------------------------------------------------------


def union_sources(*tables: DataFrame) -> DataFrame:
    """All sources as one table in the raw schema's column order."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return merged.select(*[c for c in RAW.fieldNames() if c in merged.columns])
