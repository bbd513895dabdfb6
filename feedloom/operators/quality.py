"""Checks of classified reviews against their own text and rating."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import ratio, round_even
from ..functions.text import let, snippet, words
from .inference import verdict


def _rate(part: str, whole: str) -> Column:
    return F.coalesce(ratio(F.col(part), F.greatest(F.col(whole), F.lit(1))), F.lit(0.0))


def _total(values: Column) -> Column:
    return F.coalesce(F.sum(values), F.lit(0)).cast("long")


def _phrase_found(phrase: Column, low: Column) -> Column:
    """The phrase, or at least 70 percent of its words, occurs in the text."""
    share = let(
        words(F.lower(phrase)),
        lambda tokens: ratio(
            F.size(F.filter(tokens, lambda w: low.contains(w))),
            F.greatest(F.size(tokens), F.lit(1)),
        ),
    )
    return low.contains(F.lower(phrase)) | (share >= 0.7)


def _feature_found(feature: Column, low: Column) -> Column:
    """The feature, or any one of its words, occurs in the text."""
    return low.contains(F.lower(feature)) | F.exists(
        words(F.lower(feature)), lambda w: low.contains(w)
    )


def _counts(df: DataFrame) -> DataFrame:
    """Per review, how many phrases and features it has and how many are grounded.

    Everything is counted inside the row, so texts are neither copied nor shuffled.
    """
    none = F.lit(0)

    def counted(low: Column) -> Column:
        return F.struct(
            F.coalesce(F.size("key_phrases"), none).alias("phrases"),
            F.coalesce(
                F.size(F.filter("key_phrases", lambda p: _phrase_found(p, low))), none
            ).alias("phrases_found"),
            F.coalesce(F.size("features_mentioned"), none).alias("features"),
            F.coalesce(
                F.size(F.filter("features_mentioned", lambda f: _feature_found(f, low))), none
            ).alias("features_found"),
        )

    # Lower-cased once per text; the explode of one element keeps it from being repeated.
    return df.withColumn("_n", F.explode(F.transform(F.array(F.lower("review_text")), counted)))


def phrase_grounding(df: DataFrame) -> DataFrame:
    """Totals and grounding rate of the key phrases."""
    return (
        _counts(df)
        .agg(
            _total(F.col("_n.phrases")).alias("total_phrases"),
            _total(F.col("_n.phrases_found")).alias("grounded"),
        )
        .withColumn("hallucinated", F.col("total_phrases") - F.col("grounded"))
        .withColumn("rate", _rate("grounded", "total_phrases"))
        .withColumn("status", verdict(F.col("rate"), 0.90, 0.80))
        .withColumn("grounding_rate", round_even(F.col("rate"), 4))
        .drop("rate")
    )


def ungrounded_examples(df: DataFrame, n: int = 10) -> DataFrame:
    """The first phrases that are not grounded."""
    missing = let(
        F.lower("review_text"),
        lambda low: F.filter(
            F.transform(
                "key_phrases", lambda p, i: F.struct(i.alias("position"), p.alias("phrase"))
            ),
            lambda e: ~_phrase_found(e["phrase"], low),
        ),
    )
    return (
        df.select(
            "review_id",
            F.explode(missing).alias("entry"),
            snippet(F.col("review_text"), 200).alias("text_snippet"),
        )
        .orderBy("review_id", "entry.position")
        .limit(n)
        .select("review_id", "entry.phrase", "text_snippet")
    )


def feature_grounding(df: DataFrame) -> DataFrame:
    """Totals and grounding rate of the features."""
    return (
        _counts(df)
        .agg(
            _total(F.col("_n.features")).alias("total"),
            _total(F.col("_n.features_found")).alias("grounded"),
        )
        .withColumn("_rate", _rate("grounded", "total"))
        .withColumn("status", verdict(F.col("_rate"), 0.85))
        .withColumn("rate", round_even(F.col("_rate"), 4))
        .drop("_rate")
    )


def is_aligned(rating: Column, sentiment: Column) -> Column:
    """Ratings between 2 and 4 other than 3 never align."""
    return F.coalesce(
        ((rating >= 4) & sentiment.isin("positive", "mixed", "neutral"))
        | ((rating <= 2) & sentiment.isin("negative", "mixed"))
        | ((rating == 3) & sentiment.isin("mixed", "neutral")),
        F.lit(False),
    )


def rating_alignment(df: DataFrame) -> DataFrame:
    aligned = is_aligned(F.col("rating"), F.col("sentiment"))
    return (
        df.agg(
            F.coalesce(F.sum(aligned.cast("long")), F.lit(0)).alias("aligned"),
            F.coalesce(F.sum((~aligned).cast("long")), F.lit(0)).alias("misaligned"),
            F.count(F.lit(1)).alias("total"),
        )
        .withColumn("_rate", _rate("aligned", "total"))
        .withColumn("status", verdict(F.col("_rate"), 0.75))
        .withColumn("rate", round_even(F.col("_rate"), 4))
        .drop("_rate", "total")
    )


def misaligned_examples(df: DataFrame, n: int = 5) -> DataFrame:
    return (
        df.filter(~is_aligned(F.col("rating"), F.col("sentiment")))
        .orderBy("review_id")
        .limit(n)
        .select(
            "review_id",
            "rating",
            "sentiment",
            snippet(F.col("review_text"), 100).alias("snippet"),
        )
    )


def severity_distribution(df: DataFrame) -> DataFrame:
    """Share of each severity, the largest share and its verdict on every row."""
    everything = Window.partitionBy(F.lit(0))  # one row per severity
    return (
        df.groupBy("severity")
        .agg(F.count(F.lit(1)).alias("reviews"))
        .withColumn("total", F.sum("reviews").over(everything))
        .withColumn("share", round_even(ratio(F.col("reviews"), F.col("total")), 3))
        .withColumn("max_concentration", F.max("share").over(everything))
        .withColumn(
            "status", F.when(F.col("max_concentration") < 0.6, "PASS").otherwise("WARN")
        )
        .drop("total")
    )


def coverage(df: DataFrame) -> DataFrame:
    """Share of reviews with each field filled; empty lists and texts count as absent."""

    def share(condition: Column, name: str) -> Column:
        filled = F.coalesce(condition, F.lit(False)).cast("long")
        return round_even(ratio(F.sum(filled), F.count(F.lit(1))), 4).alias(name)

    return df.agg(
        share(F.col("primary_theme") != "", "has_primary_theme"),
        share(F.size("features_mentioned") > 0, "has_features"),
        share(F.col("failure_mode") != "", "has_failure_mode"),
        share(F.size("key_phrases") > 0, "has_key_phrases"),
        share(F.col("has_actionable_signal"), "has_actionable"),
        share(F.size("competitor_mentions") > 0, "has_competitor_mention"),
        share(F.col("is_shipping_complaint"), "shipping_complaints"),
    ).filter(F.col("has_primary_theme").isNotNull())


def quality_checks(df: DataFrame) -> DataFrame:
    """Long table of every check with its rate and verdict, from one pass."""
    n = F.count(F.lit(1))
    levels = range(1, 6)

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(ratio(part, F.greatest(whole, F.lit(1))), F.lit(0.0))

    sums = _counts(df).agg(
        share(_total(F.col("_n.phrases_found")), _total(F.col("_n.phrases"))).alias("phrases"),
        share(_total(F.col("_n.features_found")), _total(F.col("_n.features"))).alias("features"),
        share(
            _total(is_aligned(F.col("rating"), F.col("sentiment")).cast("long")), n
        ).alias("alignment"),
        F.greatest(
            *[
                round_even(share(_total((F.col("severity") == k).cast("long")), n), 3)
                for k in levels
            ]
        ).alias("severity"),
    )
    rows = [
        ("phrase_grounding", F.col("phrases"), verdict(F.col("phrases"), 0.90, 0.80)),
        ("feature_grounding", F.col("features"), verdict(F.col("features"), 0.85)),
        ("rating_alignment", F.col("alignment"), verdict(F.col("alignment"), 0.75)),
        (
            "severity_concentration",
            F.col("severity"),
            F.when(F.col("severity") < 0.6, "PASS").otherwise("WARN"),
        ),
    ]
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("check"), round_even(r, 4).alias("rate"), s.alias("status"))
            for c, r, s in rows
        ]
    )
    return sums.select(F.explode(entries).alias("row")).select("row.*")


def quality_issues(df: DataFrame) -> DataFrame:
    """Checks that did not pass."""
    return quality_checks(df).filter(F.col("status") != "PASS")
