"""Schema validation with a quarantine instead of exceptions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SENTIMENTS, SOURCES, THEMES
from ..schema import CLASSIFIED, CLASSIFIED_DEFAULTS, CLASSIFIED_LISTS, RAW, RAW_DEFAULTS

REASONS = "reasons"

_REQUIRED = [
    "review_id", "product_id", "product_name", "brand", "category", "rating",
    "review_text", "source",
]

_REQUIRED_LABELS = ["title", "verified_purchase", "helpful_votes", "primary_theme",
                    "sentiment", "sentiment_confidence", "severity"]


def with_reasons(df: DataFrame, kind: str = "raw") -> DataFrame:
    """Fill defaults and list everything that is wrong with a row.

    `kind` is "raw" or "classified". Missing columns are added as nulls first.
    """
    schema, defaults = (RAW, RAW_DEFAULTS) if kind == "raw" else (CLASSIFIED, CLASSIFIED_DEFAULTS)
    missing = {
        f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns
    }
    df = df.withColumns(missing) if missing else df
    required, rules = list(_REQUIRED), {}
    rules["source is unknown"] = ~F.col("source").isin(SOURCES)
    if kind == "raw":
        rules["rating is not within 1 and 5"] = ~F.col("rating").between(1, 5)
    else:
        required += _REQUIRED_LABELS
        rules["primary_theme is unknown"] = ~F.col("primary_theme").isin(THEMES)
        rules["secondary_themes has an unknown theme"] = F.exists(
            "secondary_themes", lambda t: ~t.isin(THEMES)
        )
        rules["sentiment is unknown"] = ~F.col("sentiment").isin(SENTIMENTS)
        rules["sentiment_confidence is not within 0 and 1"] = ~F.col(
            "sentiment_confidence"
        ).between(0, 1)
        rules["severity is not within 1 and 5"] = ~F.col("severity").between(1, 5)
        empty = {c: F.coalesce(F.col(c), F.array().cast(df.schema[c].dataType)) for c in CLASSIFIED_LISTS}
        df = df.withColumns(empty)
    df = df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
    checks = [F.when(F.col(c).isNull(), F.lit(f"{c} is missing")) for c in required]
    checks += [F.when(bad, F.lit(reason)) for reason, bad in rules.items()]
    return df.withColumn(REASONS, F.array_compact(F.array(*checks)))


def validate(df: DataFrame, kind: str = "raw") -> tuple[DataFrame, DataFrame]:
    """Split into valid rows and a quarantine with the reasons."""
    checked = with_reasons(df, kind)
    return checked.filter(F.size(REASONS) == 0).drop(REASONS), checked.filter(F.size(REASONS) > 0)
