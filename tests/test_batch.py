import os

from feedloom.config import Settings
from feedloom.plans.batch import run_batch
from feedloom.sources.landing import catalog_df
from feedloom.sources.sinks import write_reviews
from synthesis import synthesize_reviews
from pyspark.sql import functions as F

from test_synthesis import NESTED


def test_whole_run(spark, tmp_path):
    raw = synthesize_reviews(spark, 400, catalog_df(spark, NESTED), "2024-07-01")
    broken = raw.limit(3).withColumn("rating", F.lit(9.0)).withColumn("review_id", F.concat(F.lit("x"), "review_id"))
    write_reviews(raw.unionByName(broken), str(tmp_path / "raw"))
    stored = spark.read.parquet(str(tmp_path / "raw"))
    settings = Settings(own_brands=("Ours",), as_of="2024-07-01")
    out = str(tmp_path / "out")
    results = run_batch(stored, settings, out)
    assert spark.read.json(f"{out}/quarantine").count() == 3
    kept = spark.read.parquet(f"{out}/classified")
    assert 0 < kept.count() <= 400
    assert results["summary_stats"].first()["total_reviews"] == kept.count()
    assert results["top_issues"].count() > 0 and results["competitor_comparison"].count() > 0
    for folder in ("analysis/top_issues", "quality/checks", "star/fact_reviews", "star/dim_date", "evidence/marketing",
                   "quality/issues", "evidence/scorecard_positions", "evidence/complaint_themes", "exports/summary",
                   "exports/negative_reviews", "exports/theme_category", "cleaning"):
        assert os.path.isdir(f"{out}/{folder}"), folder
