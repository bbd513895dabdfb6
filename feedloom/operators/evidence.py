"""Evidence tables behind recommendations, and parsing of generated answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.jsontext import ARRAY_TEXT, OBJECT_TEXT, embedded, of_kind, strict_json
from .issues import summary_stats


def issue_line(quote_chars: int = 150) -> Column:
    """Three lines of prompt text about one ranked issue."""
    quote = F.substring(F.coalesce(F.try_element_at("sample_quotes", F.lit(1)), F.lit("")), 1, quote_chars)
    number = lambda name: F.col(name).cast("string")
    return F.concat(
        F.lit("- ["), "brand", F.lit("] "), "primary_theme",
        F.lit(": impact="), number("impact_score"),
        F.lit(", freq="), number("frequency"),
        F.lit(", severity="), number("avg_severity"),
        F.lit("\n  Failure mode: "), F.coalesce("top_failure_mode", F.lit("None")),
        F.lit('\n  Quote: "'), quote, F.lit('..."\n'),
    )


def engineering_evidence(issues: DataFrame, per_category: int = 5) -> DataFrame:
    """Prompt text per category: a heading and its first issues in rank order."""
    lines = F.array_sort(F.collect_list(F.struct("rank", issue_line().alias("line"))))
    return (
        issues.filter(F.col("rank") <= per_category)
        .groupBy("category")
        .agg(lines.alias("lines"))
        .select(
            "category",
            F.concat(
                F.lit("\n## "),
                F.upper("category"),
                F.lit("\n"),
                F.array_join(F.transform("lines", lambda e: e["line"]), ""),
            ).alias("evidence"),
        )
    )


_COMPARISON_KEYS = ["category", "our_brand", "competitor", "theme"]


def _first(df: DataFrame, n: int, *order) -> DataFrame:
    return df.orderBy(*order).limit(n)


def advantages(comparison: DataFrame, limit: float = 0.15, n: int = 10) -> DataFrame:
    return _first(
        comparison.filter(F.col("delta") > limit), n, F.desc("delta"), *_COMPARISON_KEYS
    )


def weaknesses(comparison: DataFrame, limit: float = 0.15, n: int = 10) -> DataFrame:
    return _first(comparison.filter(F.col("delta") < -limit), n, "delta", *_COMPARISON_KEYS)


def gap_evidence(gaps: DataFrame, n: int = 10) -> DataFrame:
    return _first(
        gaps, n, F.desc("competitor_positive_count"), "category", "competitor", "theme"
    )


def marketing_evidence(comparison: DataFrame, gaps: DataFrame) -> DataFrame:
    """Advantages, weaknesses and gaps in one table with a `kind`."""
    columns = ["kind", "category", "our_brand", "competitor", "theme", "value"]
    compared = [
        part.withColumns({"kind": F.lit(kind), "value": F.col("delta")}).select(*columns)
        for kind, part in (("advantage", advantages(comparison)), ("weakness", weaknesses(comparison)))
    ]
    missing = gap_evidence(gaps).withColumns(
        {
            "kind": F.lit("gap"),
            "our_brand": F.lit(None).cast("string"),
            "value": F.col("competitor_positive_count").cast("double"),
        }
    ).select(*columns)
    return compared[0].unionByName(compared[1]).unionByName(missing)


def riskiest_products(risk: DataFrame, n: int = 5) -> DataFrame:
    return _first(risk, n, F.desc("return_risk_count"), "product")


def complaint_themes(issues: DataFrame, per_category: int = 3) -> DataFrame:
    return issues.filter(F.col("rank") <= per_category)


def scorecard_evidence(
    df: DataFrame, comparison: DataFrame, emerging: DataFrame, positions: int = 15, trends: int = 10
) -> dict[str, DataFrame]:
    """Summary, largest score differences and fastest growing issues."""
    return {
        "summary": summary_stats(df),
        "positions": _first(
            comparison, positions, F.desc(F.abs("delta")), *_COMPARISON_KEYS
        ),
        "emerging": _first(emerging, trends, F.desc("growth_factor"), "category", "theme"),
    }


def briefs(issues: DataFrame, comparison: DataFrame, pairs) -> dict[str, DataFrame]:
    """Issues and context for every (category, brand) of a list."""
    out = {}
    for category, brand in pairs:
        out[f"{category}_{brand}_issues"] = brief_issues(issues, category, brand)
        out[f"{category}_{brand}_context"] = brief_context(comparison, category)
    return out


def brief_issues(issues: DataFrame, category: str, brand: str, n: int = 5) -> DataFrame:
    """An own brand's first issues in a category, or everybody's if it has none."""
    ranked = issues.filter(F.col("category") == category)
    # As many rows as the ranking keeps per category.
    everything = Window.partitionBy("category")
    own = F.col("brand") == brand
    order = everything.orderBy("rank")
    return (
        ranked.withColumn("_has_own", F.max(own).over(everything))
        .filter(own | ~F.col("_has_own"))
        .withColumn("_n", F.row_number().over(order))
        .filter(F.col("_n") <= n)
        .drop("_has_own", "_n")
    )


def brief_context(comparison: DataFrame, category: str, n: int = 10) -> DataFrame:
    return _first(
        comparison.filter(F.col("category") == category), n, F.desc(F.abs("delta")), *_COMPARISON_KEYS
    )


# --- Generated answers --------------------------------------------------------


def parse_list(raw: Column) -> Column:
    """Variant array in the text: all of it if it starts with `[`, else from the
    first `[` to the last `]`."""
    starts = F.regexp_replace(raw, r"\A\s+", "").startswith("[")
    return of_kind(
        F.when(starts, strict_json(raw)).otherwise(embedded(raw, ARRAY_TEXT)), "ARRAY"
    )


def parse_object(raw: Column) -> Column:
    """Variant object in the text: from the first `{` to the last `}`."""
    return of_kind(embedded(raw, OBJECT_TEXT), "OBJECT")


def recommendation_rows(answers: DataFrame, raw: str = "answer", key: str = "id") -> DataFrame:
    """One row per recommendation; an unreadable answer keeps its text and an error flag."""
    parsed = answers.withColumn("_list", parse_list(F.col(raw)))
    items = F.coalesce(
        F.try_variant_get("_list", "$", "array<variant>"),
        F.array(F.lit(None).cast("variant")),
    )
    return parsed.select(
        key,
        F.posexplode(items).alias("position", "item"),
        F.col("_list").isNull().alias("parse_error"),
        F.when(F.col("_list").isNull(), F.col(raw)).alias("raw_response"),
    )
