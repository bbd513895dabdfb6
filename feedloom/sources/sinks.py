"""Writers of review tables, reports and BI bundles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_reviews(df: DataFrame, path: str, fmt: str = "parquet", by: str | None = None) -> None:
    """Write raw, cleaned or classified reviews; `fmt` is parquet or json."""
    writer = df.write.mode("overwrite")
    if by is not None:
        writer = writer.partitionBy(by)
    writer.format(fmt).save(path)


def write_report(tables: dict[str, DataFrame], path: str) -> None:
    """Write every result table as JSON lines under one folder, its schema beside it.

    The schema keeps the columns of tables without rows and of columns without values.
    """
    for name, df in tables.items():
        df.write.mode("overwrite").json(f"{path}/{name}")
        schema = df.sparkSession.createDataFrame([(df.schema.json(),)], "value string")
        schema.coalesce(1).write.mode("overwrite").text(f"{path}/_schemas/{name}")


def flat_columns(df: DataFrame) -> list[Column]:
    """Columns a CSV file can hold: lists and structs become JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return [
        F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
        for f in df.schema.fields
    ]


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header in UTF-8; quotes and line breaks in texts are kept."""
    (
        df.select(*flat_columns(df))
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .csv(path)
    )


def read_csv(spark, path: str, schema: T.StructType) -> DataFrame:
    """Read back what `write_csv` wrote."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", True)
        .csv(path)
    )


def write_bundle(tables: dict[str, DataFrame], path: str, fmt: str = "csv") -> None:
    """One folder per table under a common root, in place of a workbook's sheets."""
    for name, df in tables.items():
        if fmt == "csv":
            write_csv(df, f"{path}/{name}")
        else:
            df.write.mode("overwrite").format(fmt).save(f"{path}/{name}")
