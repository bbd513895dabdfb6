"""Record types of the review tables."""

from __future__ import annotations

from pyspark.sql import types as T

RAW = T.StructType(
    [
        T.StructField("review_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("title", T.StringType()),
        T.StructField("review_text", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("verified_purchase", T.BooleanType()),
        T.StructField("helpful_votes", T.IntegerType()),
        T.StructField("source", T.StringType()),
        T.StructField("reviewer_name", T.StringType()),
        T.StructField("source_url", T.StringType()),
    ]
)

MENTION = T.StructType(
    [T.StructField("brand", T.StringType()), T.StructField("context", T.StringType())]
)

_LABELS = [
    T.StructField("primary_theme", T.StringType()),
    T.StructField("secondary_themes", T.ArrayType(T.StringType())),
    T.StructField("sentiment", T.StringType()),
    T.StructField("sentiment_confidence", T.DoubleType()),
    T.StructField("severity", T.IntegerType()),
    T.StructField("features_mentioned", T.ArrayType(T.StringType())),
    T.StructField("failure_mode", T.StringType()),
    T.StructField("failure_timeline", T.StringType()),
    T.StructField("competitor_mentions", T.ArrayType(MENTION)),
    T.StructField("has_actionable_signal", T.BooleanType()),
    T.StructField("actionable_detail", T.StringType()),
    T.StructField("is_shipping_complaint", T.BooleanType()),
    T.StructField("is_spam", T.BooleanType()),
    T.StructField("key_phrases", T.ArrayType(T.StringType())),
]

CLASSIFIED = T.StructType(
    [f for f in RAW.fields if f.name not in ("reviewer_name", "source_url")] + _LABELS
)

# What an absent optional field becomes.
RAW_DEFAULTS = {
    "title": "",
    "verified_purchase": False,
    "helpful_votes": 0,
    "reviewer_name": "",
    "source_url": "",
}

CLASSIFIED_DEFAULTS = {
    "has_actionable_signal": False,
    "actionable_detail": "",
    "is_shipping_complaint": False,
    "is_spam": False,
}

CLASSIFIED_LISTS = ["secondary_themes", "features_mentioned", "competitor_mentions", "key_phrases"]
