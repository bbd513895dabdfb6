"""Batch runs: raw reviews to classified reviews, analyses and exports."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.staging import Stage
from ..operators import (
    cleaning,
    competition,
    evidence,
    explore,
    inference,
    issues,
    quality,
    scorecards,
    star,
)
from ..operators.classify import coerce_classification, route, rule_classify, with_prompt
from ..operators.cube import review_cube
from ..sources.sinks import write_bundle, write_csv, write_report, write_reviews
from ..sources.validation import validate


def run_all(df: DataFrame, settings: Settings, cube: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every analysis by name; of the return risk the rows it is based on are computed.

    All aggregate analyses read the cube. Pass a persisted or stored one to pay for
    the pass over the reviews once; otherwise each analysis builds it for itself.
    """
    cube = cube if cube is not None else review_cube(df, settings.as_of, settings.recent_days)
    own = settings.own_brands
    return {
        "summary_stats": issues.summary_stats(cube),
        "avg_rating_by_brand": issues.avg_rating_by(cube, "brand"),
        "review_count_by_category": issues.value_counts(cube, "category"),
        "review_count_by_brand": issues.value_counts(cube, "brand"),
        "sentiment_distribution": issues.value_counts(cube, "sentiment"),
        "top_issues": issues.top_issues(
            cube, settings.as_of, settings.top_n, settings.decay_days, texts=df
        ),
        "competitor_comparison": competition.competitor_comparison(cube, own, settings.min_sample),
        "emerging_issues": issues.emerging_issues(
            cube, settings.as_of, settings.recent_days, settings.growth_ratio, settings.min_recent
        ),
        "feature_gaps": competition.feature_gaps(cube, own, settings.min_sample),
        "language_patterns": issues.phrase_counts(df, settings.phrase_n),
        "return_risk": issues.return_risk(df, settings.risk_signals),
        "verified_vs_unverified": issues.verified_split(cube),
    }


def quality_tables(df: DataFrame) -> dict[str, DataFrame]:
    checks = Stage(df.sparkSession, "checks").write(quality.quality_checks(df))
    return {
        "checks": checks,
        "issues": checks.filter("status <> 'PASS'"),
        "phrase_grounding": quality.phrase_grounding(df),
        "ungrounded_examples": quality.ungrounded_examples(df),
        "feature_grounding": quality.feature_grounding(df),
        "rating_alignment": quality.rating_alignment(df),
        "misaligned_examples": quality.misaligned_examples(df),
        "severity_distribution": quality.severity_distribution(df),
        "coverage": quality.coverage(df),
    }


class ModelRun(NamedTuple):
    """What a classification with a model gives: no row is lost between the two tables."""

    classified: DataFrame
    failed: DataFrame  # with failed_reason
    calls: DataFrame  # the paid calls: cache_key, model, input_tokens, output_tokens, cost_usd


def classify_raw(
    raw: DataFrame, settings: Settings, profiles: DataFrame | None = None, classify=None
) -> tuple[DataFrame, DataFrame]:
    """Validate, clean and classify; return the classified rows and the quarantine.

    `classify` turns cleaned into classified reviews; the offline rules by default. Of a
    `ModelRun` the classified rows are returned.
    """
    valid, rejected = validate(raw, "raw")
    labelled = _label(cleaning.clean(valid, settings, profiles), settings, classify)
    rows = labelled.classified if isinstance(labelled, ModelRun) else labelled
    return rows.drop("is_shipping_only"), rejected


def _label(cleaned: DataFrame, settings: Settings, classify) -> DataFrame | ModelRun:
    return classify(cleaned) if classify is not None else rule_classify(cleaned, settings.rules)


def classify_with_model(
    df: DataFrame,
    make_scorer,
    cache: str | inference.AnswerCache,
    budget: float,
    order=("review_id",),
    hedges=None,
    batch_id: str | None = None,
    **options,
) -> ModelRun:
    """Classify with a model: route, look up, keep to the budget, ask, store, read the answers.

    `cache` holds the answers of earlier runs (a folder, which may not exist yet); new ones
    are stored under the batch id, a fresh one by default. A run that is repeated with its batch id
    asks only what it has no answer for and stores nothing twice. Equal prompts share a call. Calls are
    made in the order of the first review that needs them, in waves, until the money spent reaches the budget;
    tokens are estimated as a quarter of the characters, 200 for an answer that has not come yet.
    Options go to `infer_within_budget` and `infer`. Prompts are made anew from the reviews when their calls
    are released, so keys, estimates and places are planned with and the texts stay where they are. Runs
    jobs when called.
    """
    spark = df.sparkSession
    stage = Stage(spark, "model")
    cache = cache if isinstance(cache, inference.AnswerCache) else inference.AnswerCache(spark, cache)
    routed = route(df) if hedges is None else route(df, hedges=hedges)
    keyed = inference.with_cache_key(with_prompt(routed))
    asked = stage.write(keyed.withColumn("_tokens", inference.tokens_of(F.col("prompt"))).drop("prompt"))
    place = F.min(F.struct(*order)).alias("place")
    wanted = stage.write(
        asked.groupBy("cache_key").agg(
            F.any_value("model").alias("model"), F.any_value("_tokens").alias("input_tokens"), place
        )
    )
    # The cache is read once, for these keys; its buckets stay where they are.
    known = stage.write(inference.split_cached(wanted.select("cache_key"), cache.read())[0])
    calls = wanted.join(known, "cache_key", "left_anti").withColumn("output_tokens", F.lit(200).cast("long"))

    def prompts(released: DataFrame) -> DataFrame:
        """Released calls with the prompt of the first review that needs them; texts are shuffled once."""
        first = with_prompt(asked).select("cache_key", "prompt", F.struct(*order).alias("place"))
        plan = {c: F.any_value(c).alias(c) for c in released.columns if c != "cache_key"}
        same = (first["cache_key"] == released["cache_key"]) & first["place"].eqNullSafe(released["place"])
        met = first.join(released.hint("shuffle_hash"), same).select(*[released[c] for c in released.columns], "prompt")
        return met.groupBy("cache_key").agg(*plan.values(), F.any_value("prompt").alias("prompt"))

    answered, failed, _ = inference.infer_within_budget(calls, make_scorer, budget, ["place"], prompts=prompts, **options)
    cache.add(batch_id or uuid.uuid4().hex, answered)
    responses = known.select("cache_key", "response").unionByName(answered.select("cache_key", "response"))
    failures = failed.select("cache_key", F.col("failed_reason").alias("call_failed"))
    rows = coerce_classification(
        asked.join(responses, "cache_key", "left").join(failures, "cache_key", "left")
    )
    unanswered = F.when(
        F.col("response").isNull(), F.coalesce("call_failed", F.lit("not asked: over the budget"))
    )
    rows = stage.write(
        rows.withColumn("failed_reason", F.coalesce(unanswered, F.col("failed_reason"))).drop(
            "call_failed", "cache_key", "response", "model", "_tokens"
        )
    )
    fine = F.col("failed_reason").isNull()
    paid = answered.select("cache_key", "model", "input_tokens", "output_tokens", "cost_usd")
    return ModelRun(rows.filter(fine).drop("failed_reason"), rows.filter(~fine), paid)


def model_consistency(
    df: DataFrame, make_scorer, n: int = 100, seed: int = 42, key: str = "review_id", **options
) -> DataFrame:
    """Agreement of two passes of the base model over the same n reviews.

    Reviews that either pass could not classify are left out; `sample_size` says how many counted.
    Neither pass uses a cache. Options go to `infer`. Runs jobs when called.
    """
    stage = Stage(df.sparkSession, "consistency")
    sample = stage.write(with_prompt(inference.sample_n(df, n, seed, key)).select(key, "prompt"))
    passes = []
    for _ in range(2):
        answered, _failed = inference.infer(sample, make_scorer, **options)
        passes.append(coerce_classification(answered.drop("failed_reason")).filter("failed_reason IS NULL"))
    return inference.consistency(*passes, key)


def exports(df: DataFrame, cube: DataFrame, own_brands) -> dict[str, DataFrame]:
    """Flat tables for other tools."""
    return {
        "flat_reviews": star.flat_reviews(df, own_brands),
        "brand_sentiment": star.brand_sentiment_pivot(cube),
        "theme_category": star.theme_category_pivot(cube),
        "brand_scorecard": scorecards.brand_scorecard(cube),
        "negative_reviews": explore.negative_extract(df),
        "summary": explore.summary_extract(cube),
    }


def analyse(df: DataFrame, settings: Settings, out: str) -> dict[str, DataFrame]:
    """Write all analyses, quality checks and BI tables of classified reviews.

    The cube is stored once and feeds every aggregate; later tables are built from
    the stored results of earlier ones.
    """
    stage = Stage(df.sparkSession, "analysis")
    cube = stage.write(review_cube(df, settings.as_of, settings.recent_days))
    results = {n: stage.write(t) for n, t in run_all(df, settings, cube).items()}
    write_report(results, f"{out}/analysis")
    write_report(quality_tables(df), f"{out}/quality")
    write_bundle(
        star.star_tables(
            df,
            settings.own_brands,
            settings.as_of,
            results["competitor_comparison"],
            results["emerging_issues"],
            results["top_issues"],
        ),
        f"{out}/star",
    )
    write_report(
        {
            "engineering": evidence.engineering_evidence(results["top_issues"]),
            "marketing": evidence.marketing_evidence(
                results["competitor_comparison"], results["feature_gaps"]
            ),
            "service": evidence.riskiest_products(results["return_risk"]),
            "complaint_themes": evidence.complaint_themes(results["top_issues"]),
            **{
                f"brief_{name}": table
                for name, table in evidence.briefs(
                    results["top_issues"], results["competitor_comparison"], settings.briefs
                ).items()
            },
            **{
                f"scorecard_{name}": table
                for name, table in evidence.scorecard_evidence(
                    cube, results["competitor_comparison"], results["emerging_issues"]
                ).items()
            },
        },
        f"{out}/evidence",
    )
    for name, table in exports(df, cube, settings.own_brands).items():
        write_csv(table, f"{out}/exports/{name}")
    return results


def run_batch(
    raw: DataFrame,
    settings: Settings,
    out: str,
    profiles: DataFrame | None = None,
    classify=None,
    recheck=None,
) -> dict[str, DataFrame]:
    """The whole run, from raw reviews to analyses, evidence and exports in one folder.

    The cleaned table is written once, and its counters come from the pass that writes it; the
    classified table is written once and read by all analyses. `classify` returns classified
    rows or a `ModelRun`, whose failed rows and costs are written too. `recheck` gets the
    cleaned reviews and returns a table that is kept with the checks, such as `model_consistency`.
    """
    spark = raw.sparkSession
    valid, rejected = validate(raw, "raw")
    cleaned, seen = cleaning.clean_counted(valid, settings, profiles)
    write_reviews(cleaned, f"{out}/cleaned")
    write_reviews(rejected, f"{out}/quarantine", "json")
    write_report({"cleaning": cleaning.observed_stats(spark, seen)}, out)
    cleaned = spark.read.parquet(f"{out}/cleaned")
    labelled = _label(cleaned, settings, classify)
    if isinstance(labelled, ModelRun):
        write_reviews(labelled.failed.drop("is_shipping_only"), f"{out}/failed", "json")
        write_report({"calls": labelled.calls, "costs": inference.cost_breakdown(labelled.calls)}, f"{out}/model")
        labelled = labelled.classified
    write_reviews(labelled.drop("is_shipping_only"), f"{out}/classified")
    if recheck is not None:
        write_report({"consistency": recheck(cleaned)}, f"{out}/quality")
    return analyse(spark.read.parquet(f"{out}/classified"), settings, out)
