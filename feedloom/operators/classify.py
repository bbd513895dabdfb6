"""Prompts, routing, response parsing and the offline rule classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FAILURE_DETAIL, HEDGES, SENTIMENTS, THEMES, RuleSet
from ..functions.jsontext import OBJECT_TEXT, embedded, of_kind, strict_json
from ..functions.numbers import draw, pick, round_even, unit
from ..functions.text import contains_any, first_label, first_words, let, matched
from ..schema import MENTION

# --- Prompts and routing ------------------------------------------------------


def prompt(
    rating: Column | None = None,
) -> Column:
    """The six-line request for one review."""
    shown = F.col("rating").cast("string") if rating is None else rating
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Product: "), "product_name"),
        F.concat(F.lit("Brand: "), "brand"),
        F.concat(F.lit("Category: "), "category"),
        F.concat(F.lit("Rating: "), shown, F.lit("/5")),
        F.concat(F.lit("Title: "), "title"),
        F.lit("Review:"),
        F.col("review_text"),
    )


def with_prompt(df: DataFrame) -> DataFrame:
    return df.withColumn("prompt", prompt())


def needs_strong_model(hedges=tuple(HEDGES)) -> Column:
    """Middling, long, or hedged reviews go to the stronger model."""
    hedged = contains_any(F.lower("review_text"), hedges) & F.col("rating").isin(2.0, 4.0)
    return (F.col("rating") == 3) | (F.length("review_text") > 1000) | hedged


def route(df: DataFrame, base: str = "base", strong: str = "strong", hedges=tuple(HEDGES)) -> DataFrame:
    return df.withColumn("model", F.when(needs_strong_model(hedges), strong).otherwise(base))


# --- Responses ----------------------------------------------------------------


def parse_response(raw: Column) -> Column:
    """JSON object in the text: the whole text or from the first `{` to the last `}`."""
    whole = strict_json(raw)
    return F.coalesce(
        of_kind(whole, "OBJECT"),
        F.when(whole.isNull(), of_kind(embedded(raw, OBJECT_TEXT), "OBJECT")),
    )


def _kind(value: Column, field: str) -> Column:
    """Type of a field: null if the field is missing, VOID for a JSON null."""
    return F.schema_of_variant(F.try_variant_get(value, f"$.{field}", "variant"))


def _text_field(value: Column, field: str, default: Column) -> tuple[Column, Column]:
    kind = _kind(value, field)
    return (
        F.when(kind.isNull(), default).otherwise(F.try_variant_get(value, f"$.{field}", "string")),
        kind.isNotNull() & (kind != "STRING"),
    )


def _list_field(value: Column, field: str) -> tuple[Column, Column]:
    kind = _kind(value, field)
    empty = F.array().cast("array<string>")
    return (
        F.coalesce(F.try_variant_get(value, f"$.{field}", "array<string>"), empty),
        kind.isNotNull() & ~kind.isin("ARRAY<STRING>", "ARRAY<VOID>"),
    )


def _flag_field(value: Column, field: str) -> Column:
    """Truth of a field: missing, null, false, zero and empty count as false."""
    text = F.try_variant_get(value, f"$.{field}", "string")
    return F.coalesce(~text.isin("", "0", "0.0", "false", "[]", "{}"), F.lit(False))


def coerce_classification(df: DataFrame, raw: str = "response") -> DataFrame:
    """Turn responses into classification columns and a `failed_reason`.

    Unknown themes and sentiments fall back to defaults, severity is clamped; a
    response that cannot be read at all fails the row instead of the job.
    """
    v = F.col("_v")
    theme = F.try_variant_get(v, "$.primary_theme", "string")
    sentiment = F.try_variant_get(v, "$.sentiment", "string")
    confidence_kind, severity_kind = _kind(v, "sentiment_confidence"), _kind(v, "severity")
    confidence = F.when(confidence_kind.isNull(), F.lit(0.5)).otherwise(
        F.try_variant_get(v, "$.sentiment_confidence", "double")
    )
    as_text = F.trim(F.try_variant_get(v, "$.severity", "string"))
    severity = (
        F.when(severity_kind.isNull(), F.lit(3))
        .when(
            severity_kind == "STRING",
            F.when(as_text.rlike(r"^[+-]?\d+$"), as_text.try_cast("int")),
        )
        .otherwise(F.try_variant_get(v, "$.severity", "double").try_cast("int"))
    )
    secondary, bad_secondary = _list_field(v, "secondary_themes")
    features, bad_features = _list_field(v, "features_mentioned")
    phrases, bad_phrases = _list_field(v, "key_phrases")
    detail, bad_detail = _text_field(v, "actionable_detail", F.lit(""))
    mode, bad_mode = _text_field(v, "failure_mode", F.lit(None).cast("string"))
    timeline, bad_timeline = _text_field(v, "failure_timeline", F.lit(None).cast("string"))
    mention_kind = _kind(v, "competitor_mentions")
    mentions = F.coalesce(
        F.try_variant_get(v, "$.competitor_mentions", f"array<{MENTION.simpleString()}>"),
        F.array().cast(f"array<{MENTION.simpleString()}>"),
    )
    void = F.lit("VOID")
    reason = (
        F.when(v.isNull(), "unreadable response")
        .when(bad_secondary, "secondary_themes")
        .when(
            (confidence_kind == void)
            | F.coalesce(confidence, F.lit(-1.0)).between(0, 1).__invert__(),
            "sentiment_confidence",
        )
        .when(F.col("severity").isNull(), "severity")
        .when(bad_features, "features_mentioned")
        .when(bad_mode & (_kind(v, "failure_mode") != void), "failure_mode")
        .when(bad_timeline & (_kind(v, "failure_timeline") != void), "failure_timeline")
        .when(mention_kind.isNotNull() & ~mention_kind.startswith("ARRAY"), "competitor_mentions")
        .when(bad_detail, "actionable_detail")
        .when(bad_phrases, "key_phrases")
    )
    return (
        df.withColumn("_v", parse_response(F.col(raw)))
        .withColumn("severity", F.least(F.lit(5), F.greatest(F.lit(1), severity)))
        .withColumn("severity", F.when(severity.isNotNull(), F.col("severity")))
        .withColumn("failed_reason", reason)
        .withColumns(
            {
                "primary_theme": F.when(theme.isin(THEMES), theme).otherwise("usability"),
                "secondary_themes": F.filter(secondary, lambda t: t.isin(THEMES)),
                "sentiment": F.when(sentiment.isin(SENTIMENTS), sentiment).otherwise("neutral"),
                "sentiment_confidence": confidence,
                "features_mentioned": features,
                "failure_mode": mode,
                "failure_timeline": timeline,
                "competitor_mentions": mentions,
                "has_actionable_signal": _flag_field(v, "has_actionable_signal"),
                "actionable_detail": detail,
                "is_shipping_complaint": _flag_field(v, "is_shipping_complaint"),
                "is_spam": F.lit(False),
                "key_phrases": phrases,
            }
        )
        .drop("_v")
    )


# --- Rules --------------------------------------------------------------------
#
# `low` is the lower-cased text. Choices the rules leave open are drawn from the
# review id, so a rerun on other partitions gives the same labels.


def rule_theme(low: Column, rules: RuleSet) -> Column:
    labelled = [(theme, [word]) for word, theme in rules.theme_keywords.items()]
    return F.coalesce(first_label(low, labelled), F.lit(rules.default_theme))


def rule_sentiment(rating: Column) -> Column:
    return (
        F.when(rating >= 4, "positive")
        .when(rating <= 2, "negative")
        .when(rating == 3, "mixed")
        .otherwise("neutral")
    )


def rule_confidence(sentiment: Column, key: Column, rules: RuleSet) -> Column:
    """A draw from the band of the sentiment, three places."""
    share = unit(key, f"confidence{rules.seed}")
    value = (
        F.when(sentiment == "positive", share * 0.15 + 0.85)
        .when(sentiment == "negative", share * 0.20 + 0.80)
        .when(sentiment == "mixed", share * 0.30 + 0.60)
        .otherwise(F.lit(0.70))
    )
    return round_even(value, 3)


def rule_severity(low: Column, rating: Column, rules: RuleSet) -> Column:
    by_rating = F.greatest(F.lit(1), F.least(F.lit(5), F.lit(6) - rating.cast("int")))
    return F.when(contains_any(low, rules.hazard_words), F.lit(5)).otherwise(by_rating)


def rule_failure_mode(theme: Column, sentiment: Column, key: Column, rules: RuleSet) -> Column:
    chosen = F.lit(None).cast("string")
    for name, modes in rules.failure_modes.items():
        chosen = F.when(theme == name, pick(key, f"failure{rules.seed}", modes)).otherwise(chosen)
    return F.when(sentiment == "negative", chosen)


def rule_timeline(low: Column, failure_mode: Column) -> Column:
    number = F.regexp_extract(low, r"(\d+)\s*months?", 1)
    return F.when(
        failure_mode.isNotNull() & (number != ""), F.concat(number, F.lit(" months"))
    )


def rule_competitors(low: Column, brand: Column, rating: Column, rules: RuleSet) -> Column:
    context = F.when(rating >= 4, "favorable").otherwise("unfavorable")
    names = F.array(*[F.lit(n) for n in rules.mention_brands])
    others = F.filter(names, lambda n: low.contains(F.lower(n)) & (n != brand))
    return F.transform(others, lambda n: F.struct(n.alias("brand"), context.alias("context")))


def rule_key_phrases(text: Column, key: Column, rules: RuleSet) -> Column:
    """Five successive words of a text with more than five, from one of the first eleven.

    The phrase ends with the fifteenth word at the latest, and longer texts draw
    their start like one of fifteen words, so no further words are looked at.
    """
    number = draw(key, f"phrase{rules.seed}")

    def phrase(tokens: Column) -> Column:
        starts = F.greatest(F.size(tokens) - 5, F.lit(0)) + 1
        start = F.pmod(number, starts.cast("long")).cast("int") + 1
        return F.when(
            F.size(tokens) > 5, F.array(F.array_join(F.slice(tokens, start, F.lit(5)), " "))
        ).otherwise(F.array().cast("array<string>"))

    return let(first_words(text, 15), phrase)


def rule_features(low: Column, rules: RuleSet) -> Column:
    return matched(low, rules.feature_words)


def rule_classify(df: DataFrame, rules: RuleSet | None = None) -> DataFrame:
    """Classify raw reviews offline: no model, no Python, no shuffle."""
    rules = rules or RuleSet()
    low, key, rating = F.col("_low"), F.col("review_id"), F.col("rating")
    theme, sentiment, severity = F.col("primary_theme"), F.col("sentiment"), F.col("severity")
    negative = sentiment == "negative"
    failure = F.col("failure_mode")
    return (
        df.withColumn("_low", F.lower("review_text"))
        .withColumns(
            {
                "primary_theme": rule_theme(low, rules),
                "secondary_themes": F.array().cast("array<string>"),
                "sentiment": rule_sentiment(rating),
                "severity": rule_severity(low, rating, rules),
                "features_mentioned": rule_features(low, rules),
                "competitor_mentions": rule_competitors(low, F.col("brand"), rating, rules),
                "key_phrases": rule_key_phrases(F.col("review_text"), key, rules),
            }
        )
        .withColumns(
            {
                "sentiment_confidence": rule_confidence(sentiment, key, rules),
                "failure_mode": rule_failure_mode(theme, sentiment, key, rules),
                "has_actionable_signal": negative & (severity >= 3),
                "is_shipping_complaint": F.lit(False),
                "is_spam": F.lit(False),
            }
        )
        .withColumns(
            {
                "failure_timeline": rule_timeline(low, failure),
                "actionable_detail": F.when(failure.isNotNull(), FAILURE_DETAIL).otherwise(""),
            }
        )
        .drop("_low", "reviewer_name", "source_url")
    )
