"""Seeded synthetic raw reviews.

Every choice is a hash of the row's id, the seed and the choice's name, so a row
is the same however the work is partitioned or retried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.functions.numbers import choose
from feedloom.sources.landing import union_sources

# --- Fixed values: shares of the star ratings and helpful-vote weights ---------

RATING_SHARES = [(5.0, 0.45), (4.0, 0.15), (3.0, 0.08), (2.0, 0.08), (1.0, 0.24)]

LOW_RATING_VOTES = [(0, 30), (1, 20), (2, 15), (3, 10), (5, 10), (10, 8), (20, 5), (50, 2)]

HIGH_RATING_VOTES = [(0, 50), (1, 25), (2, 15), (3, 7), (5, 3)]

MONTHS = [2, 3, 4, 5, 6, 8, 10, 12]

VERIFIED_SHARE = 0.75

# --- Wording ------------------------------------------------------------------

TEMPLATES = {
    "positive": {
        "power": [
            "{brand} put a strong motor into the {product}; it gets through everything we throw at it.",
            "We used a {competitor} before and the {product} has clearly more power.",
        ],
        "usability": [
            "The {product} took no time to learn, and every control is where we expect it.",
            "Handling the {product} is simple enough for the whole household.",
        ],
        "noise": [
            "The {product} is so quiet that nobody in the next room notices it.",
            "Compared with our {competitor} this one barely makes a sound.",
        ],
        "price_value": [
            "For what {brand} asks, the {product} gives a lot back.",
            "A {competitor} costs more and does not do a better job.",
        ],
    },
    "negative": {
        "durability": [
            "After {months} months the {product} simply gave up, which {brand} should not allow.",
            "A clip on the {product} snapped within {months} months of careful use.",
        ],
        "noise": [
            "The {product} is so loud that we only dare to run it at noon.",
            "Our old {competitor} was far quieter than this {product}.",
        ],
        "cleaning": [
            "Getting the {product} clean again takes longer than using it.",
            "Dirt collects in corners of the {product} that no brush can reach.",
        ],
        "size": [
            "The {product} is bulkier than the photos suggest and fits no cupboard here.",
            "We expected more room inside the {product} for its outer size.",
        ],
    },
}

DETAILS = {
    "positive": [
        "We would choose it again.", "Friends have asked where we got it.",
        "It arrived ready to use.", "The finish feels solid.", "No complaints so far.",
    ],
    "negative": [
        "Support did not help much.", "The spare part made no difference.",
        "We had hoped for better.", "It is now back in its box.", "The manual leaves out the basics.",
    ],
}

TITLES = {
    "high": ["Very pleased", "Does what it should", "Good {theme}", "Glad we bought it"],
    "middle": ["Fair, with flaws", "Neither good nor bad", "So-so {theme}"],
    "low": ["Let down", "Poor {theme}", "Not for us", "Would not buy again"],
}


def draw(key: Column, salt: str) -> Column:
    return F.xxhash64(key, F.lit(salt))


def unit(key: Column, salt: str) -> Column:
    return F.pmod(draw(key, salt), F.lit(1 << 32)).cast("double") / float(1 << 32)


def pick(key: Column, salt: str, values: list) -> Column:
    return choose(draw(key, salt), values)


def _weighted(share: Column, weighted: list[tuple]) -> Column:
    """The value whose slice of the unit interval holds `share`."""
    total = float(sum(w for _, w in weighted))
    edge, result = 0.0, None
    for value, weight in weighted[:-1]:
        edge += weight / total
        condition = share < edge
        result = F.when(condition, value) if result is None else result.when(condition, value)
    return result.otherwise(weighted[-1][0])


def synthesize_from(
    ids: DataFrame, catalog: DataFrame, as_of, seed: int = 42, templates=None, id_col: str = "id"
) -> DataFrame:
    """One synthetic raw review for every id."""
    templates = TEMPLATES if templates is None else templates
    key = F.concat(F.col("_key"), F.lit(f"#{seed}"))
    # Products, brands and categories are numbered, so that a choice is a number and
    # the chosen thing an equi-join away; no row has to carry a whole shelf.
    in_category = Window.partitionBy("category")
    brands = (
        catalog.select("category", "brand")
        .distinct()
        .withColumn("_brand_no", F.row_number().over(in_category.orderBy("brand")) - 1)
    )
    products = catalog.withColumn(
        "_product_no", F.row_number().over(in_category.orderBy("product_id")) - 1
    ).join(brands, ["category", "brand"])
    shelves = (
        catalog.groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("_products"),
            F.countDistinct("brand").alias("_brands"),
        )
        # One row per category.
        .withColumn("_shelf", F.row_number().over(Window.orderBy("category")) - 1)
    )
    shelf_count = catalog.agg(F.countDistinct("category").alias("n"))
    rivals = brands.select("category", F.col("_brand_no").alias("_rival_no"), F.col("brand").alias("_rival"))
    # Steps of 1 to n-1 from the own brand reach every other brand of the category.
    step = F.pmod(draw(key, "competitor"), F.greatest(F.col("_brands") - 1, F.lit(1))) + 1
    rows = (
        ids.select(F.col(id_col).cast("string").alias("_key"))
        .withColumn("_n", shelf_count.scalar())
        .withColumn("_shelf", F.pmod(draw(F.col("_key"), "category"), F.col("_n")).cast("int"))
        .drop("_n")
        .join(shelves, "_shelf")
        .withColumn("_product_no", F.pmod(draw(key, "product"), F.col("_products")).cast("int"))
        .join(products, ["category", "_product_no"])
        .withColumn(
            "_rival_no",
            F.when(
                F.col("_brands") > 1, F.pmod(F.col("_brand_no") + step, F.col("_brands")).cast("int")
            ),
        )
        .join(rivals, ["category", "_rival_no"], "left")
        .withColumn("_rival", F.coalesce("_rival", F.lit("the competition")))
    )
    rating = _weighted(unit(key, "rating"), RATING_SHARES)

    def sentence(side: str) -> tuple[Column, Column]:
        themes = list(templates[side])
        theme = pick(key, "theme", themes)
        text = F.lit(None).cast("string")
        for name in themes:
            text = F.when(F.col("_theme") == name, pick(key, "template", templates[side][name])).otherwise(text)
        return theme, text

    good = F.col("rating") >= 4
    good_theme, good_text = sentence("positive")
    bad_theme, bad_text = sentence("negative")

    def detail(i: int) -> Column:
        return F.when(good, pick(key, f"detail{i}", DETAILS["positive"])).otherwise(
            pick(key, f"detail{i}", DETAILS["negative"])
        )

    details = F.slice(
        F.array(detail(0), detail(1), detail(2)),
        F.lit(1),
        (F.pmod(draw(key, "details"), F.lit(3)) + 1).cast("int"),
    )
    title = (
        F.when(good, pick(key, "title", TITLES["high"]))
        .when(F.col("rating") == 3, pick(key, "title", TITLES["middle"]))
        .otherwise(pick(key, "title", TITLES["low"]))
    )
    votes = F.when(
        F.col("rating") <= 2, _weighted(unit(key, "votes"), LOW_RATING_VOTES)
    ).otherwise(_weighted(unit(key, "votes"), HIGH_RATING_VOTES))
    months = pick(key, "months", [str(m) for m in MONTHS])
    body = F.col("_template")
    for mark, value in (
        ("{brand}", F.col("brand")),
        ("{product}", F.col("product_name")),
        ("{competitor}", F.col("_rival")),
        ("{months}", months),
    ):
        body = F.replace(body, F.lit(mark), value)
    digest = F.substring(F.md5(key), 1, 12)
    day = F.lit(as_of).cast("date")
    age = (F.pmod(draw(key, "age"), F.lit(365)) + 1).cast("int")
    reviews = (
        rows.withColumn("rating", rating)
        .withColumn("_theme", F.when(good, good_theme).otherwise(bad_theme))
        .withColumn("_template", F.when(good, good_text).otherwise(bad_text))
        .withColumns(
            {
                "review_id": F.concat(F.lit("syn_"), digest),
                "title": F.replace(title, F.lit("{theme}"), F.col("_theme")),
                "review_text": F.concat_ws(" ", body, F.array_join(details, " ")),
                "date": F.date_sub(day, age),
                "verified_purchase": unit(key, "verified") < VERIFIED_SHARE,
                "helpful_votes": votes.cast("int"),
                "source": F.lit("amazon"),
                "reviewer_name": F.concat(F.lit("Reviewer_"), F.substring(digest, 1, 6)),
                "source_url": F.concat(F.lit("https://amazon.com/dp/"), "product_id"),
            }
        )
    )
    return union_sources(reviews)


def synthesize_reviews(
    spark: SparkSession, n: int, catalog: DataFrame, as_of, seed: int = 42, templates=None
) -> DataFrame:
    """n synthetic raw reviews over the products of a catalogue."""
    return synthesize_from(spark.range(n), catalog, as_of, seed, templates)
