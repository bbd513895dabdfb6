"""Additive measures of the classified reviews.

Every ranking and comparison is built from sums, so all of them can be answered
either from the review table itself or from one pre-aggregated table. `measures`
gives both the same shape: on reviews it only adds columns (nothing is shuffled),
on a cube it does nothing. A full run builds the cube in one pass over the
reviews and answers every aggregate analysis from that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = [
    "category", "brand", "primary_theme", "sentiment", "verified_purchase",
    "product_name", "failure_mode", "is_recent",
]

_COUNT = "n_reviews"


def is_cube(df: DataFrame) -> bool:
    return _COUNT in df.columns


def as_date(value) -> Column:
    return F.lit(value).cast("date") if isinstance(value, str) else F.lit(value)


def _built_for(df: DataFrame, day: Column, recent_days: int) -> DataFrame:
    """The cube with its dated measures; using them fails if it was built for other dates."""
    same_day = F.col("cube_as_of") == day
    other = F.raise_error(F.lit("the cube was built for another date or window"))
    return df.withColumns(
        {
            "age_sum": F.when(same_day, F.col("age_sum")).otherwise(other.cast("long")),
            "is_recent": F.when(
                same_day & (F.col("cube_days") == recent_days), F.col("is_recent")
            ).otherwise(other.cast("boolean")),
        }
    )


def measures(df: DataFrame, as_of=None, recent_days: int = 90) -> DataFrame:
    """One row per review (or cube cell) with additive measures.

    Sums of ratings and severities come with the number of reviews that have one, so
    that means leave out nulls. `is_recent` is null for undated reviews: they belong to
    neither window.
    """
    if is_cube(df):
        return df if as_of is None else _built_for(df, as_date(as_of), recent_days)
    extra = {
        _COUNT: F.lit(1).cast("long"),
        "rating_sum": F.col("rating"),
        "rated": F.col("rating").isNotNull().cast("long"),
        "severity_sum": F.col("severity").cast("long"),
        "graded": F.col("severity").isNotNull().cast("long"),
        "dated": F.col("date").isNotNull().cast("long"),
        "first_date": F.col("date"),
        "last_date": F.col("date"),
    }
    if as_of is not None:
        day = as_date(as_of)
        extra["age_sum"] = F.datediff(day, F.col("date")).cast("long")
        extra["is_recent"] = F.col("date") >= F.date_sub(day, recent_days)
    return df.withColumns(extra)


def totals() -> list[Column]:
    """Aggregates that turn measures into measures of a coarser grain."""
    return [
        F.sum(_COUNT).alias(_COUNT),
        F.sum("rating_sum").alias("rating_sum"),
        F.sum("rated").alias("rated"),
        F.sum("severity_sum").alias("severity_sum"),
        F.sum("graded").alias("graded"),
        F.sum("dated").alias("dated"),
        F.sum("age_sum").alias("age_sum"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
    ]


def review_cube(df: DataFrame, as_of, recent_days: int = 90) -> DataFrame:
    """Aggregate the reviews once to the finest grain the analyses need.

    The grain is products x themes x a few flags, so its size follows the
    catalogue rather than the number of reviews.
    """
    built = {"cube_as_of": as_date(as_of), "cube_days": F.lit(recent_days)}
    return measures(df, as_of, recent_days).groupBy(*KEYS).agg(*totals()).withColumns(built)


# --- Cubes by day -------------------------------------------------------------

DAY_KEYS = [key for key in KEYS if key != "is_recent"]
_DAY_SUMS = ("n_reviews", "rating_sum", "rated", "severity_sum", "graded", "dated")


def day_cells(df: DataFrame) -> DataFrame:
    """Reviews reduced to a cell per day and cube key; undated ones have no day.

    Nothing here depends on today: ages and recency follow from the day when a cube is asked for.
    """
    cells = measures(df).withColumn("day", F.col("date").cast("date")).groupBy(*DAY_KEYS, "day")
    return cells.agg(*[F.sum(c).alias(c) for c in _DAY_SUMS])


def write_days(df: DataFrame, path: str, period: str = "day") -> None:
    """Store the cells of the reviews by period, in place of those periods' earlier cells.

    `df` must hold all reviews of its periods, which may be one new day or a corrected one: only
    their partitions are rewritten. Where days are small, a `period` of "week" or "month"
    makes fewer files; a folder keeps to one period.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = day_cells(df).withColumn("period", F.date_trunc(period, "day").cast("date"))
    writer = cells.repartition(tasks, "period").write.option("partitionOverwriteMode", "dynamic")
    writer.mode("overwrite").partitionBy("period").parquet(path)


def read_days(spark: SparkSession, path: str) -> DataFrame:
    """The stored cells; filters on `period` (its first day) read the matching partitions only."""
    kinds = {
        "verified_purchase": "boolean", "rating_sum": "double", "day": "date", "period": "date",
        **{c: "long" for c in _DAY_SUMS if c != "rating_sum"},
    }
    schema = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in [*DAY_KEYS, "day", *_DAY_SUMS, "period"])
    return spark.read.schema(schema).parquet(path)


def cube_of_days(cells: DataFrame, as_of, recent_days: int = 90) -> DataFrame:
    """The review cube of a date from stored cells, equal to `review_cube` of all their reviews."""
    today, day = as_date(as_of), F.col("day")
    dated = cells.withColumns(
        {
            "age_sum": F.col("dated") * F.datediff(today, day),
            "is_recent": day >= F.date_sub(today, recent_days),
            "first_date": day,
            "last_date": day,
        }
    )
    built = {"cube_as_of": today, "cube_days": F.lit(recent_days)}
    return dated.groupBy(*KEYS).agg(*totals()).withColumns(built)


# --- Aggregates -------------------------------------------------------------------


def n_where(condition: Column) -> Column:
    """Number of reviews that satisfy the condition."""
    return F.coalesce(F.sum(F.when(condition, F.col(_COUNT))), F.lit(0)).cast("long")


def n_all() -> Column:
    return F.coalesce(F.sum(_COUNT), F.lit(0)).cast("long")


# Number of reviews that have the value of a summed measure.
KNOWN = {"rating_sum": "rated", "severity_sum": "graded"}


def mean_of(total: str, condition: Column | None = None) -> Column:
    """Average of a summed measure over all reviews that have it or those that match."""
    parts = [F.col(total), F.col(KNOWN[total])]
    if condition is not None:
        parts = [F.when(condition, p) for p in parts]
    return F.try_divide(*[F.sum(p).cast("double") for p in parts])


def share_where(condition: Column, known: Column | None = None) -> Column:
    """Share of the reviews (of those with `known` true) that satisfy the condition."""
    whole = F.sum(_COUNT) if known is None else n_where(known)
    return F.try_divide(n_where(condition).cast("double"), whole.cast("double"))


def verified_share() -> Column:
    """Share of verified purchases among the reviews that tell."""
    verified = F.col("verified_purchase")
    return share_where(verified, verified.isNotNull())
