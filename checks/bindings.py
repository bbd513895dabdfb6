"""Review tables derived from the driver tables.

`reviews_fact` turns every order line into a classified review; `reviews_text`
turns every document into a raw review with real text; `posts` and `comments`
turn every conversation into a forum thread. Each has a twin in `oracle.py`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.config import FAILURE_MODES, THEMES, RuleSet
from feedloom.functions.staging import Stage, sized

AS_OF = "2001-11-05"
OWN_BRANDS = ("Brand#1", "Brand#2")

# Word lists that occur in the invented prose of the documents.
RULES = RuleSet(
    theme_keywords={
        "license": "safety",
        "released under": "packaging",
        "nterb": "noise",
        "eaux": "durability",
        "sche": "cleaning",
        "cion": "battery",
        "ouble": "power",
        "tion": "size",
    },
    failure_modes=dict(FAILURE_MODES),
    hazard_words=("copyright", "password"),
    mention_brands=("Is", "La", "Der", "Und", "The", "Que"),
    feature_words=("the ", "ion", "est", "license", "@", "tion and", "eau", "sch", "http"),
)
NEEDLES = ("ß", "th", "ion", "The MIT License", "eaux la", "released under the mit license", "%_\\", "no such words here")
SIGNALS = ("return", "the ", "ion", "license", "@", "eau")
HEDGE_WORDS = ("ther", "eaux", "sch")
SPAM = (r"released\s+under", r"click\s+here", r"(my|our)\s+(website|link)", r"\bthe\s+the\b")
SHIPPING = (r"^(the|la|der|is|of)\b", r"\b(license|http)\b")
PRODUCT = (r"\b(that|with|que|und)\b",)
BRAND_WORDS = (
    ("Brand#1", ("hthe", "eaux")),
    ("Brand#2", ("tion", "license")),
    ("Brand#3", ("sch", "cion")),
    ("Brand#4", ("e ",)),
)
POSITIVE = ("the", "ion", "est", "eau", "que", "sch")
NEGATIVE = ("ing", "ent", "ung", "ado", "ere", "oua", "and")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table dealt out by a key that it is joined on later.

    The driver stores most tables in one file with one row group, which only one task can
    read; only the columns that a query uses are dealt. Tables of enough files are read as they lie.
    """
    rows = table(spark, sf_dir, name)
    if len(rows.inputFiles()) >= spark.sparkContext.defaultParallelism:
        return rows
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), key)


def product_name() -> Column:
    return F.concat("p_name", F.lit(" "), (F.col("p_partkey") % 20).cast("string"))


def sentiment_of(rating: Column, flag: Column) -> Column:
    return (
        F.when(rating >= 4, "positive")
        .when(rating <= 2, "negative")
        .when(flag == "R", "neutral")
        .otherwise("mixed")
    )


def reviews_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line as a classified review (no arrays).

    Some have no rating, severity, date or mark of a verified purchase.
    """
    order = F.col("l_orderkey")
    lines = dealt(spark, sf_dir, "lineitem", "l_partkey")
    parts = table(spark, sf_dir, "part")
    rows = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("review_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        product_name().alias("product_name"),
        F.col("p_brand").alias("brand"),
        F.lower("p_type").alias("category"),
        (F.lit(1) + F.col("l_quantity").cast("int") % 5).cast("double").alias("_stars"),
        F.concat(F.lit("Order "), F.col("l_orderkey").cast("string")).alias("title"),
        F.concat(
            product_name(),
            F.lit(" order "),
            F.col("l_orderkey").cast("string"),
            F.lit(" flag "),
            F.col("l_returnflag"),
        ).alias("review_text"),
        F.when(order % 61 != 13, F.col("l_shipdate").cast("date")).alias("date"),
        F.when(order % 67 != 5, F.col("l_linestatus") == "F").alias("verified_purchase"),
        (F.col("l_suppkey") % 50).cast("int").alias("helpful_votes"),
        F.when(F.col("l_linenumber") % 2 == 0, "amazon").otherwise("reddit").alias("source"),
        F.col("l_returnflag").alias("_flag"),
        ((F.col("l_linenumber") * 2 + F.col("l_suppkey")) % 15).cast("int").alias("_theme"),
        F.col("l_partkey").alias("_part"),
        (order % 53 != 7).alias("_rated"),
        (order % 59 != 11).alias("_graded"),
    )
    themes = F.array(*[F.lit(t) for t in THEMES])
    base = F.element_at(themes, F.col("_theme") + 1)
    recent = F.col("date") >= F.date_sub(F.lit(AS_OF).cast("date"), 90)
    shifted = F.when(recent & (F.col("_part") % 3 == 0), "battery").otherwise(base)
    hole = (
        (F.col("sentiment") == "positive")
        & F.col("brand").isin(*OWN_BRANDS)
        & (F.col("_shifted") == "smell")
    )
    failure = F.lit(None).cast("string")
    for theme, modes in FAILURE_MODES.items():
        index = (F.col("_part") % len(modes)).cast("int") + 1
        failure = F.when(
            (F.col("primary_theme") == theme) & (F.col("sentiment") == "negative"),
            F.element_at(F.array(*[F.lit(m) for m in modes]), index),
        ).otherwise(failure)
    return (
        rows.withColumn("sentiment", sentiment_of(F.col("_stars"), F.col("_flag")))
        .withColumn("rating", F.when(F.col("_rated"), F.col("_stars")))
        .withColumn("severity", F.when(F.col("_graded"), (F.lit(6) - F.col("_stars")).cast("int")))
        .withColumn("_shifted", shifted)
        .withColumn("primary_theme", F.when(hole, "noise").otherwise(F.col("_shifted")))
        .withColumn("failure_mode", failure)
        .drop("_flag", "_theme", "_part", "_shifted", "_stars", "_rated", "_graded")
    )


def stored_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `reviews_text`, for queries that read it several times: a table in one file is dealt once."""
    documents = dealt(spark, sf_dir, "documents", "doc_id")
    if len(table(spark, sf_dir, "documents").inputFiles()) < spark.sparkContext.defaultParallelism:
        documents = Stage(spark, "documents").write(documents)
    return reviews_text(spark, sf_dir, documents)


def reviews_text(spark: SparkSession, sf_dir: str, documents: DataFrame | None = None) -> DataFrame:
    """Every document as a raw review; `lang` is the known language."""
    documents = documents if documents is not None else dealt(spark, sf_dir, "documents", "doc_id")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    parts = table(spark, sf_dir, "part")
    doc = F.col("doc_id")
    return (
        documents.join(sized(labels), "doc_id", "left")  # else all texts are shuffled to meet a flag
        .withColumn("_part", doc % 200)
        .join(parts, F.col("_part") == F.col("p_partkey"))
        .select(
            doc.cast("string").alias("review_id"),
            doc.alias("doc_id"),
            F.col("p_partkey").cast("string").alias("product_id"),
            product_name().alias("product_name"),
            F.col("p_brand").alias("brand"),
            F.lower("p_type").alias("category"),
            (F.lit(1) + (doc * 7 + F.coalesce("quality", F.lit(0))) % 5)
            .cast("double")
            .alias("rating"),
            F.substring("text", 1, 40).alias("title"),
            F.col("text").alias("review_text"),
            F.date_add(F.lit("2024-01-01").cast("date"), (doc % 365).cast("int")).alias("date"),
            (doc % 4 != 0).alias("verified_purchase"),
            (doc % 50).cast("int").alias("helpful_votes"),
            F.when(doc % 2 == 0, "amazon").otherwise("reddit").alias("source"),
            F.lit("").alias("reviewer_name"),
            F.col("source").alias("source_url"),
            "lang",
        )
    )


# --- Landing records ----------------------------------------------------------

FORUMS = {"economy": ["f0", "f1"], "small": ["f1", "f2"], "promo": ["f3"]}


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a product."""
    return table(spark, sf_dir, "part").select(
        F.lower("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_partkey").cast("string").alias("product_id"),
        product_name().alias("product_name"),
    )


def nested_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue as nested maps, one landing row per product."""
    product = F.struct(F.col("product_id").alias("asin"), F.col("product_name").alias("name"))
    return catalog(spark, sf_dir).select(
        F.create_map("category", F.create_map("brand", F.array(product))).alias("catalog")
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a marketplace item with gaps and dates in many formats."""
    doc = F.col("doc_id")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (doc % 365).cast("int"))
    kind = doc % 6
    date = (
        F.when(kind == 0, F.date_format(day, "MMMM d, yyyy"))
        .when(kind == 1, F.date_format(day, "yyyy-MM-dd"))
        .when(kind == 2, F.date_format(day, "MM/dd/yyyy"))
        .when(kind == 3, F.date_format(day, "d MMMM yyyy"))
        .when(kind == 4, F.concat(F.lit(" \n"), F.date_format(day, "yyyy-MM-dd"), F.lit("\t ")))
        .otherwise("soon")
    )
    text = F.col("text")
    return dealt(spark, sf_dir, "documents", "doc_id").select(
        (doc % 200).cast("string").alias("asin"),
        doc.alias("id"),
        F.when(doc % 9 != 0, (doc % 5 + 1).cast("double")).alias("rating"),
        F.when(doc % 10 != 0, F.substring(text, 1, 40)).alias("title"),
        F.when(doc % 4 != 0, text).alias("text"),
        F.when(doc % 8 != 0, F.concat(F.lit("R:"), text)).alias("review"),
        date.alias("date"),
        F.when(doc % 3 != 0, doc % 2 == 0).alias("isVerified"),
        F.when(doc % 7 != 0, doc % 50).alias("helpfulVotes"),
        F.when(doc % 2 == 0, F.col("source")).alias("userName"),
        F.when(doc % 5 == 0, F.concat(F.lit("https://shop.example/"), doc.cast("string"))).alias("url"),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first turn of every conversation as a forum post."""
    conv = F.col("conv_id")
    return table(spark, sf_dir, "conversations").filter("turn = 0").select(
        conv.cast("string").alias("id"),
        F.concat(F.lit("f"), (conv % 5).cast("string")).alias("forum"),
        F.when(conv % 2 == 0, "economy").otherwise("small").alias("category"),
        F.substring("text", 1, 120).alias("title"),
        F.when(conv % 10 != 0, F.col("text")).alias("selftext"),
        (F.lit(1704067200) + conv * 7200).alias("created_utc"),
        (conv % 100).alias("score"),
        F.col("role").alias("author"),
        F.concat(F.lit("/r/f/"), conv.cast("string")).alias("permalink"),
    )


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later turns as comments of the post."""
    conv = F.col("conv_id")
    key = F.concat_ws("_", conv, "turn")
    return table(spark, sf_dir, "conversations").filter("turn > 0").select(
        conv.cast("string").alias("post_id"),
        (F.col("turn") - 1).cast("int").alias("position"),
        key.alias("id"),
        F.col("text").alias("body"),
        (F.lit(1704067200) + conv * 7200 + F.col("turn") * 60).alias("created_utc"),
        (F.col("turn") * 3).alias("score"),
        F.col("role").alias("author"),
        F.concat(F.lit("/r/f/"), key).alias("permalink"),
    )


def unchecked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw reviews of which some break the schema."""
    doc = F.col("doc_id")
    return reviews_text(spark, sf_dir).withColumns(
        {
            "rating": F.when(doc % 6 == 0, F.col("rating") + 1).when(
                doc % 13 != 0, F.col("rating")
            ),
            "source": F.when(doc % 8 == 0, "blog").otherwise(F.col("source")),
            "brand": F.when(doc % 9 != 0, F.col("brand")),
            "title": F.when(doc % 10 != 0, F.col("title")),
            "helpful_votes": F.when(doc % 3 != 0, F.col("helpful_votes")),
        }
    )


# --- Model traffic ------------------------------------------------------------


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An answer of a model for every document: clean, wrapped, broken or odd.

    Every second one quotes the whole text, escaped as JSON.
    """
    doc = F.col("doc_id")
    theme = F.element_at(F.array(*[F.lit(t) for t in THEMES + ["weather"]]), (doc % 16 + 1).cast("int"))
    mood = F.element_at(
        F.array(*[F.lit(s) for s in ("positive", "negative", "mixed", "neutral", "angry")]),
        (doc % 5 + 1).cast("int"),
    )
    severity = (
        F.when(doc % 7 == 0, '"9"')
        .when(doc % 7 == 1, "null")
        .when(doc % 7 == 2, "3.7")
        .when(doc % 7 == 3, '"high"')
        .otherwise((doc % 9 - 1).cast("string"))
    )
    confidence = F.when(doc % 10 == 0, "1.5").otherwise(
        F.concat(F.lit("0."), (doc % 90 + 10).cast("string"))
    )
    second = F.when(doc % 3 == 0, '["noise", "weather"]').otherwise("[]")
    optional = F.when(
        doc % 2 == 0,
        F.concat(
            F.lit(', "key_phrases": ["n '), doc.cast("string"),
            F.lit('", "m"], "has_actionable_signal": true, "actionable_detail": '), quoted_text(),
        ),
    ).otherwise("")
    body = F.concat(
        F.lit('{"primary_theme": "'), theme, F.lit('", "secondary_themes": '), second,
        F.lit(', "sentiment": "'), mood, F.lit('", "sentiment_confidence": '), confidence,
        F.when(doc % 11 != 0, F.concat(F.lit(', "severity": '), severity)).otherwise(""),
        optional, F.lit("}"),
    )
    kind = doc % 8
    raw = (
        F.when(kind == 0, F.concat(F.lit("Here it is: "), body, F.lit("\nDone.")))
        .when(kind == 1, F.substring(body, 1, 30))
        .when(kind == 2, "no answer")
        .otherwise(body)
    )
    return dealt(spark, sf_dir, "documents", "doc_id").select(
        doc.cast("string").alias("review_id"), raw.alias("response")
    )


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a logged model call."""
    event = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        event.alias("call_id"),
        F.element_at(F.array(F.lit("base"), F.lit("strong"), F.lit("other")), (event % 3 + 1).cast("int")).alias("model"),
        (F.lit(200) + F.col("user_id") % 1000).alias("input_tokens"),
        (F.lit(50) + event % 250).alias("output_tokens"),
    )


def two_passes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Labels of the order lines and a second opinion that sometimes differs."""
    lines = reviews_fact(spark, sf_dir).select(
        "review_id", "primary_theme", "sentiment", "severity", "helpful_votes"
    )
    votes = F.col("helpful_votes")
    first = lines.withColumns(
        {
            "sentiment": F.when(votes != 7, F.col("sentiment")),
            "severity": F.when(votes != 8, F.col("severity")),
        }
    )
    second = first.withColumns(
        {
            "primary_theme": F.when(votes % 10 == 0, "safety").otherwise(F.col("primary_theme")),
            "sentiment": F.when(votes % 4 == 0, "neutral").otherwise(F.col("sentiment")),
            "severity": F.when(votes % 3 == 0, F.col("severity") + 1)
            .when(votes % 3 == 1, F.col("severity") + 2)
            .otherwise(F.col("severity")),
        }
    )
    return first.drop("helpful_votes"), second.drop("helpful_votes")


def quoted_text() -> Column:
    """The whole text as a JSON string, escaped."""
    object_text = F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("t")))
    return F.substring(object_text, F.lit(6), F.length(object_text) - 6)  # without {"t": and }


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated recommendation lists, one per document, that quote it: plain, wrapped or broken."""
    doc = F.col("doc_id")
    size = F.col("n_chars").cast("string")
    body = F.concat(
        F.lit('[{"quote": '), quoted_text(), F.lit(', "rank": 1}, {"quote": "x", "rank": '), size, F.lit("}]")
    )
    kind = doc % 4
    return dealt(spark, sf_dir, "documents", "doc_id").select(
        doc.alias("id"),
        F.when(kind == 0, F.concat(F.lit("Sure: "), body, F.lit(" ok?")))
        .when(kind == 1, F.concat(F.lit('[{"quote": "cut, "rank": '), size))
        .otherwise(body)
        .alias("answer"),
    )
