"""Issue ranking, emerging issues, customer phrases and return risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import ISSUE_SENTIMENTS, RISK_SIGNALS
from ..functions.numbers import ratio, round_even, round_exact
from ..functions.staging import Stage
from ..functions.text import let, matched, snippet, strip
from .cube import is_cube, mean_of, measures, n_all, n_where, review_cube, verified_share

ISSUE_KEYS = ["category", "brand", "primary_theme"]


# --- Summary ------------------------------------------------------------------


def summary_stats(df: DataFrame) -> DataFrame:
    """Row count, distinct categories and brands, date range, verified rate."""
    return measures(df).agg(
        n_all().alias("total_reviews"),
        F.countDistinct("category").alias("categories"),
        F.countDistinct("brand").alias("brands"),
        F.min("first_date").alias("min_date"),
        F.max("last_date").alias("max_date"),
        verified_share().alias("verified_purchase_rate"),
    )


def avg_rating_by(df: DataFrame, column: str = "brand") -> DataFrame:
    return (
        measures(df)
        .groupBy(column)
        .agg(round_even(mean_of("rating_sum"), 2).alias("avg_rating"))
        .orderBy(column)
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts per value, largest first; nulls are not counted."""
    return (
        measures(df)
        .filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(n_all().alias("reviews"))
        .orderBy(F.desc("reviews"), column)
    )


# --- Top issues ---------------------------------------------------------------


def issue_scores(df: DataFrame, as_of, decay_days: int = 180) -> DataFrame:
    """Frequency, severity, recency and impact of every category, brand and theme.

    Reviews are first reduced to one row per issue and failure mode, all by sums; the
    leading failure mode comes from that small table.
    """
    by_mode = (
        measures(df, as_of)
        .filter(F.col("sentiment").isin(ISSUE_SENTIMENTS))
        .groupBy(*ISSUE_KEYS, "failure_mode")
        .agg(
            F.sum("n_reviews").alias("n_reviews"),
            F.sum("severity_sum").alias("severity_sum"),
            F.sum("graded").alias("graded"),
            F.sum("age_sum").alias("age_sum"),
            F.sum("dated").alias("dated"),
        )
    )
    # The most frequent failure mode, the first by name among equals.
    mode_rank = F.when(
        F.col("failure_mode").isNotNull(),
        F.struct((-F.col("n_reviews")).alias("order"), F.col("failure_mode").alias("mode")),
    )
    age = ratio(F.sum("age_sum"), F.sum("dated"))
    scored = by_mode.groupBy(*ISSUE_KEYS).agg(
        F.sum("n_reviews").alias("frequency"),
        mean_of("severity_sum").alias("severity"),
        F.coalesce(F.exp(-age / F.lit(float(decay_days))), F.lit(0.5)).alias("recency"),
        F.min(mode_rank)["mode"].alias("top_failure_mode"),
    )
    impact = F.col("frequency").cast("double") * F.col("severity") * F.col("recency")
    return scored.select(
        *ISSUE_KEYS,
        "frequency",
        round_even(F.col("severity"), 2).alias("avg_severity"),
        round_exact(F.col("recency"), 3).alias("recency_weight"),
        round_even(impact, 2).alias("impact_score"),
        "top_failure_mode",
    )


def affected_products(df: DataFrame, issues: DataFrame) -> DataFrame:
    """The product names of some issues as sorted lists; only their reviews are grouped."""
    return (
        df.filter(F.col("sentiment").isin(ISSUE_SENTIMENTS))
        .select(*ISSUE_KEYS, "product_name")
        .join(issues.select(*ISSUE_KEYS), ISSUE_KEYS, "left_semi")
        .groupBy(*ISSUE_KEYS)
        .agg(F.array_sort(F.collect_set("product_name")).alias("affected_products"))
    )


def rank_issues(scores: DataFrame, top_n: int = 10) -> DataFrame:
    """Keep the highest-impact issues of each category, ties by brand and theme."""
    order = Window.partitionBy("category").orderBy(
        F.desc("impact_score"), F.asc("brand"), F.asc("primary_theme")
    )
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_n)


def first_texts(
    df: DataFrame,
    keys: list[str],
    n: int,
    order: list[str],
    value: Column,
    name: str,
) -> DataFrame:
    """The first n values per key as an ordered array.

    The filter on row_number lets Spark cut every key to n rows before the
    shuffle, so a key that holds a third of the table costs no more than others.
    """
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return (
        df.withColumn("_value", value)
        .select(*keys, "_value", *[c for c in order if c not in keys])
        .withColumn("_position", F.row_number().over(window))
        .filter(F.col("_position") <= n)
        .groupBy(*keys)
        .agg(
            F.array_sort(F.collect_list(F.struct("_position", "_value"))).alias("_values")
        )
        .select(*keys, F.transform("_values", lambda v: v["_value"]).alias(name))
    )


def top_issues(
    df: DataFrame,
    as_of,
    top_n: int = 10,
    decay_days: int = 180,
    quotes: int = 3,
    order: tuple = ("date", "review_id"),
    texts: DataFrame | None = None,
) -> DataFrame:
    """Ranked issues per category with quotes and affected products.

    `df` may be the reviews or their cube; with a cube, `texts` supplies the
    reviews the quotes are taken from. Reviews are reduced to a cube of their complaints first,
    which is written down when this is called: scores and products both come from it, so the
    reviews are read once for them and once for the quotes of the ranked issues.
    """
    texts = texts if texts is not None else df
    if not is_cube(df):
        complaints = df.filter(F.col("sentiment").isin(ISSUE_SENTIMENTS))
        df = Stage(df.sparkSession, "complaints").write(review_cube(complaints, as_of))
    ranked = rank_issues(issue_scores(df, as_of, decay_days), top_n)
    listed = ranked.join(affected_products(df, ranked), ISSUE_KEYS)
    if is_cube(texts):
        return listed.withColumn("sample_quotes", F.array().cast("array<string>"))
    # The keys of the ranked issues meet the reviews; everything else joins the three
    # quotes that are left of each.
    candidates = (
        texts.filter(F.col("sentiment").isin(ISSUE_SENTIMENTS))
        .select(*ISSUE_KEYS, "review_text", *order)
        .join(ranked.select(*ISSUE_KEYS), ISSUE_KEYS, "left_semi")
    )
    quoted = first_texts(
        candidates, ISSUE_KEYS, quotes, list(order), F.col("review_text"), "sample_quotes"
    )
    return listed.join(quoted, ISSUE_KEYS)


# --- Emerging issues ----------------------------------------------------------


def emerging_issues(
    df: DataFrame, as_of, days: int = 90, ratio_limit: float = 1.5, min_recent: int = 5
) -> DataFrame:
    """Themes whose share of a category grew in the last `days` days.

    The reviews are aggregated once to category and theme; the category totals
    and the check for an empty older window use that small table only.
    """
    recent, older = F.col("is_recent"), ~F.col("is_recent")
    themes = (
        measures(df, as_of, days)
        .groupBy("category", "primary_theme")
        .agg(
            n_where(recent).alias("recent_count"),
            n_where(older).alias("older_count"),
            mean_of("severity_sum", recent).alias("severity"),
        )
    )
    category = Window.partitionBy("category")
    # One row per category and theme is all that meets in this window.
    everything = Window.partitionBy(F.lit(0))
    recent_all = F.greatest(F.sum("recent_count").over(category), F.lit(1))
    older_all = F.greatest(F.sum("older_count").over(category), F.lit(1))
    return (
        themes.withColumn("recent_rate", ratio(F.col("recent_count"), recent_all))
        .withColumn("older_rate", ratio(F.col("older_count"), older_all))
        .withColumn("older_total", F.sum("older_count").over(everything))
        .filter(
            (F.col("recent_rate") > F.col("older_rate") * ratio_limit)
            & (F.col("recent_count") >= min_recent)
            & (F.col("older_total") > 0)
        )
        .select(
            "category",
            F.col("primary_theme").alias("theme"),
            "recent_count",
            "older_count",
            round_exact(
                F.col("recent_rate") / F.greatest(F.col("older_rate"), F.lit(0.001)), 2
            ).alias("growth_factor"),
            round_even(F.col("severity"), 2).alias("recent_severity_avg"),
        )
        .orderBy(F.desc("growth_factor"), "category", "theme")
    )


# --- Customer phrases ---------------------------------------------------------


def phrase_counts(df: DataFrame, top_n: int = 20) -> DataFrame:
    """Most used key phrases: overall, in positive and in negative reviews.

    The overall list merges phrases that differ in outer white space, the two
    others do not. One explode feeds all three lists.
    """
    lowered = F.lower("phrase")
    entries = F.array(
        F.struct(F.lit("all").alias("list"), strip(lowered).alias("phrase")),
        F.when(
            F.col("sentiment").isin("positive", "negative"),
            F.struct(F.col("sentiment").alias("list"), lowered.alias("phrase")),
        ),
    )
    order = Window.partitionBy("list").orderBy(F.desc("uses"), F.asc("phrase"))
    return (
        df.select("sentiment", F.explode("key_phrases").alias("phrase"))
        .select(F.explode(F.array_compact(entries)).alias("entry"))
        .groupBy("entry.list", "entry.phrase")
        .agg(F.count(F.lit(1)).alias("uses"))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top_n)
    )


# --- Return risk --------------------------------------------------------------


def return_risk_rows(df: DataFrame, signals=tuple(RISK_SIGNALS)) -> DataFrame:
    """Reviews rated 2 or lower whose text holds a return signal."""
    return (
        df.filter(F.col("rating") <= 2)
        # Found once per text: as elements of an array the signals are not computed again
        # for the filter.
        .withColumn(
            "risk_signals",
            F.explode(
                let(F.lower("review_text"), lambda low: F.array(matched(low, signals)))
            ),
        )
        .filter(F.size("risk_signals") > 0)
        .select(
            "review_id",
            "brand",
            F.col("product_name").alias("product"),
            "category",
            "rating",
            "risk_signals",
            "severity",
            F.col("primary_theme").alias("theme"),
            snippet(F.col("review_text"), 200).alias("snippet"),
        )
    )


def return_risk(df: DataFrame, signals=tuple(RISK_SIGNALS), samples: int = 3) -> DataFrame:
    """Return-risk reviews per product with their themes and first samples.

    The texts are read once, when this is called: both parts of the result come from the risk
    rows, which are few and narrow and are written down.
    """
    rows = Stage(df.sparkSession, "return-risk").write(return_risk_rows(df, signals))
    totals = rows.groupBy("product").agg(
        F.count(F.lit(1)).alias("return_risk_count"),
        round_exact(ratio(F.sum("severity"), F.count("severity")), 2).alias("avg_severity"),
        F.array_sort(F.collect_set("theme")).alias("top_themes"),
    )
    sample = F.struct(
        "review_id", "brand", "category", "rating", "risk_signals", "severity", "theme", "snippet"
    )
    first = first_texts(rows, ["product"], samples, ["review_id"], sample, "sample_reviews")
    return totals.join(first, "product").orderBy(F.desc("return_risk_count"), "product")


# --- Verified and unverified purchases ----------------------------------------


def verified_split(df: DataFrame) -> DataFrame:
    """One row: counts, ratings, severity and sentiments of both segments."""
    verified, unverified = F.col("verified_purchase"), ~F.col("verified_purchase")
    columns = []
    for name, condition in (("verified", verified), ("unverified", unverified)):
        columns.append(n_where(condition).alias(f"{name}_count"))
        columns.append(
            round_even(mean_of("rating_sum", condition), 2).alias(f"{name}_avg_rating")
        )
        columns.append(
            round_even(mean_of("severity_sum", condition), 2).alias(f"{name}_severity_avg")
        )
        for sentiment in ("positive", "negative", "mixed", "neutral"):
            columns.append(
                n_where(condition & (F.col("sentiment") == sentiment)).alias(
                    f"{name}_{sentiment}"
                )
            )
    return measures(df).agg(*columns)
