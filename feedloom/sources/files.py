"""Readers of review files and saved reports."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CLASSIFIED, RAW

CORRUPT = "_corrupt_record"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])


def _read_json(spark: SparkSession, path: str, schema: T.StructType, keep_corrupt: bool) -> DataFrame:
    df = (
        spark.read.schema(_with_corrupt(schema))
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", "*.json*")
        .json(path)
    )
    return df if keep_corrupt else df.drop(CORRUPT)


def read_reviews(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    """Raw reviews from a JSON-lines file or folder with the fixed schema.

    Blank lines are skipped. Lines that are not JSON give a row of nulls that
    `validate` rejects; `keep_corrupt` keeps their text.
    """
    return _read_json(spark, path, RAW, keep_corrupt)


def read_classified(spark: SparkSession, path: str) -> DataFrame:
    """Classified reviews; a path that does not exist gives an empty table."""
    try:
        return _read_json(spark, path, CLASSIFIED, False)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CLASSIFIED)


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with an inferred schema; `date` is coerced, bad dates become null."""
    df = spark.read.json(path)
    if "date" not in df.columns:
        return df
    text = F.col("date").cast("string")
    return df.withColumn("date", F.try_to_timestamp(text).cast("date"))


def read_report(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """A saved result: one table of a report folder, or a multi-line JSON document.

    A table is read with the schema that stands beside it, or an inferred one without.
    """
    if table is not None:
        try:
            stored = spark.read.text(f"{path}/_schemas/{table}").first()["value"]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.read.json(f"{path}/{table}")
        schema = T.StructType.fromJson(json.loads(stored))
        return spark.read.schema(schema).json(f"{path}/{table}")
    return spark.read.option("multiLine", True).json(path)
