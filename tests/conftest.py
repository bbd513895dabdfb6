import datetime as dt
import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from feedloom.schema import CLASSIFIED, RAW  # noqa: E402

DAY = dt.date(2024, 6, 1)

RAW_ROW = dict(
    review_id="test",
    product_id="P1",
    product_name="Test Product",
    brand="Ours",
    category="vacuums",
    rating=3.0,
    title="Test",
    review_text="A text that is long enough to keep.",
    date=DAY,
    verified_purchase=True,
    helpful_votes=0,
    source="amazon",
    reviewer_name="",
    source_url="",
)

LABELS = dict(
    primary_theme="durability",
    secondary_themes=[],
    sentiment="negative",
    sentiment_confidence=0.95,
    severity=4,
    features_mentioned=["motor"],
    failure_mode="Motor failure",
    failure_timeline="3 months",
    competitor_mentions=[],
    has_actionable_signal=True,
    actionable_detail="Improve motor durability",
    is_shipping_complaint=False,
    is_spam=False,
    key_phrases=["motor died after 3 months"],
)


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="feedloom-tests-")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", shared)
        .config("spark.sql.warehouse.dir", f"{shared}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def _table(spark, schema, base, rows):
    names = schema.fieldNames()
    records = [
        tuple({**base, "review_id": f"r{i:03d}", **row}[n] for n in names)
        for i, row in enumerate(rows)
    ]
    return spark.createDataFrame(records, schema)


@pytest.fixture(scope="session")
def raw(spark):
    """Build raw reviews from the fields that matter to a test."""
    return lambda *rows: _table(spark, RAW, RAW_ROW, rows)


@pytest.fixture(scope="session")
def labelled(spark):
    """Build classified reviews from the fields that matter to a test."""
    base = {**RAW_ROW, **LABELS}
    return lambda *rows: _table(spark, CLASSIFIED, base, rows)


def ids(df):
    return sorted(r["review_id"] for r in df.select("review_id").collect())
