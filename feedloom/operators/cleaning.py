"""Cleaning of raw reviews: length, copies, language, spam, shipping, white space."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..config import PRODUCT_PATTERNS, SHIPPING_PATTERNS, SPAM_PATTERNS, Settings
from ..functions.numbers import ratio, round_even
from ..functions.staging import sized
from ..functions.text import collapse, let, matches_any, strip, strip_ends, words
from .language import detector
from .neardup import fates

TEXT = "review_text"


def is_short(text: Column, n: int = 20) -> Column:
    return F.length(strip_ends(text)) < n


def drop_short(df: DataFrame, n: int = 20) -> DataFrame:
    """Drop reviews with fewer than n characters between their outer white space."""
    return df.filter(~is_short(F.col(TEXT), n))


def text_hash(text: Column) -> Column:
    """Equal for texts that differ only in letter case and outer white space."""
    return F.md5(strip(F.lower(text)))


def dedup_exact(df: DataFrame, order=("date", "review_id")) -> DataFrame:
    """Keep the first review of every text.

    Spark cuts every text to one row per input partition before the shuffle, so
    many copies of one text do not pile up in one task.
    """
    window = Window.partitionBy("_hash").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return (
        df.withColumn("_hash", text_hash(F.col(TEXT)))
        .withColumn("_n", F.row_number().over(window))
        .filter(F.col("_n") == 1)
        .drop("_hash", "_n")
    )


def is_spam(text: Column, patterns=tuple(SPAM_PATTERNS)) -> Column:
    return matches_any(text, patterns)


def is_shouting(text: Column, rating: Column) -> Column:
    """A five-star text of less than 30 characters with more than three '!'."""
    marks = F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit("")))
    return (F.length(text) < 30) & (rating == 5) & (marks > 3)


def is_repetitive(text: Column) -> Column:
    """More than ten words of which fewer than 30 percent are different."""
    return let(
        words(F.lower(text)),
        lambda w: (F.size(w) > 10) & (ratio(F.size(F.array_distinct(w)), F.size(w)) < 0.3),
    )


def is_bot(text: Column, rating: Column) -> Column:
    return is_shouting(text, rating) | is_repetitive(text)


def is_unwanted(patterns=tuple(SPAM_PATTERNS)) -> Column:
    text = F.col(TEXT)
    return F.coalesce(is_spam(text, patterns) | is_bot(text, F.col("rating")), F.lit(False))


def remove_spam(df: DataFrame, patterns=tuple(SPAM_PATTERNS)) -> DataFrame:
    return df.filter(~is_unwanted(patterns))


def shipping_only(
    text: Column, shipping=tuple(SHIPPING_PATTERNS), product=tuple(PRODUCT_PATTERNS)
) -> Column:
    """Mentions delivery but nothing about the product."""
    return matches_any(text, shipping) & ~matches_any(text, product)


def flag_shipping(
    df: DataFrame, shipping=tuple(SHIPPING_PATTERNS), product=tuple(PRODUCT_PATTERNS)
) -> DataFrame:
    return df.withColumn("is_shipping_only", shipping_only(F.col(TEXT), shipping, product))


def normalize_text(df: DataFrame) -> DataFrame:
    """Collapse white space, then drop what is not printable ASCII; titles only collapse."""
    return df.withColumns(
        {
            TEXT: F.regexp_replace(collapse(F.col(TEXT)), r"[^\x20-\x7E\n]", ""),
            "title": collapse(F.col("title")),
        }
    )


REASONS = ("empty", "exact_dup", "fuzzy_dup", "non_english", "spam")


def judge(
    df: DataFrame,
    settings: Settings,
    profiles: DataFrame | None = None,
    order=("date", "review_id"),
    spam=tuple(SPAM_PATTERNS),
    shipping=tuple(SHIPPING_PATTERNS),
    product=tuple(PRODUCT_PATTERNS),
) -> DataFrame:
    """Every row with the first cleaning step that drops it (`drop_reason`, null: it stays).

    Also adds `is_shipping_only`. The steps come in a fixed order: short texts, copies of an earlier
    text, near-duplicates, other languages (left out without profiles), spam. Near-copies are
    searched once, when this is called; all else is decided in the pass that reads the result.
    """
    long = drop_short(df, settings.min_text)
    seen = fates(
        long, order, settings.near_dup_percent, settings.near_dup_chars, whole=settings.near_dup_whole
    ).select(F.col("id").alias("_first"), "near")
    text = F.col(TEXT)
    foreign = F.lit(False)
    if profiles is not None:
        body = text if settings.language_chars is None else F.substring(text, 1, settings.language_chars)
        foreign = F.coalesce(F.col("_lang") != settings.language, F.lit(False))
    # The language is told for rows that got so far only; short texts keep their null.
    met = df.join(sized(seen), F.col("review_id").cast("string") == F.col("_first"), "left")
    if profiles is not None:
        unique = F.coalesce(~F.col("near"), F.lit(False))
        met = met.withColumn("_lang", detector(profiles)(F.when(unique, body)))
    reason = (
        F.when(F.coalesce(is_short(text, settings.min_text), F.lit(True)), "empty")
        .when(F.col("_first").isNull(), "exact_dup")
        .when(F.col("near"), "fuzzy_dup")
        .when(foreign, "non_english")
        .when(is_unwanted(spam), "spam")
    )
    return flag_shipping(met.withColumn("drop_reason", reason).drop("_first", "near", "_lang"), shipping, product)


def clean(df: DataFrame, settings: Settings, profiles: DataFrame | None = None, *args, **options) -> DataFrame:
    """All cleaning steps in their fixed order; arguments are those of `judge`."""
    return normalize_text(judge(df, settings, profiles, *args, **options).filter("drop_reason IS NULL").drop("drop_reason"))


def counters() -> list[Column]:
    """Counts over judged rows: input, one per reason, flagged_shipping, output."""
    reason = F.col("drop_reason")

    def count(condition: Column, name: str) -> Column:
        return F.count(F.when(condition, 1)).alias(name)

    return [
        F.count(F.lit(1)).alias("input"),
        *[count(reason == name, f"removed_{name}") for name in REASONS],
        count(reason.isNull() & F.col("is_shipping_only"), "flagged_shipping"),
        count(reason.isNull(), "output"),
    ]


def with_retention(counts: DataFrame) -> DataFrame:
    return counts.withColumn("retention_rate", round_even(ratio(F.col("output"), F.col("input")) * 100, 1))


def clean_counted(
    df: DataFrame, settings: Settings, profiles: DataFrame | None = None, *args, **options
) -> tuple[DataFrame, Observation]:
    """As `clean`, with an observation that holds the counters once the table has been written.

    The counters are gathered in the pass that writes the cleaned rows, so nothing is read or
    judged a second time. The first job on the table must read all of it.
    """
    seen = Observation("cleaning")
    judged = judge(df, settings, profiles, *args, **options).observe(seen, *counters())
    return normalize_text(judged.filter("drop_reason IS NULL").drop("drop_reason")), seen


def observed_stats(spark: SparkSession, seen: Observation) -> DataFrame:
    """The counters of an observation as one row, as `cleaning_stats` gives them."""
    counts = seen.get
    names = ["input", *[f"removed_{name}" for name in REASONS], "flagged_shipping", "output"]
    schema = ", ".join(f"{name} long" for name in names)
    return with_retention(spark.createDataFrame([tuple(counts[name] for name in names)], schema))


def cleaning_stats(df: DataFrame, settings: Settings, profiles: DataFrame | None = None, *args, **options) -> DataFrame:
    """One row of removal counters and the retention rate in percent, without a cleaned table."""
    return with_retention(judge(df, settings, profiles, *args, **options).agg(*counters()))
