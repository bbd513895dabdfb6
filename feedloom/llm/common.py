"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows that a Python step handles at once, so that long texts are not copied all together.
ROWS_AT_ONCE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


# Rows drawn by hash before an exact choice, as a multiple of those wanted.
SURPLUS = 4


def thinned(key: Column, wanted: int, total: Column) -> Column:
    """Condition that keeps about SURPLUS times the wanted rows of a total, by a hash of the key.

    An exact choice of the wanted rows then meets few candidates however many there are.
    """
    unit = F.pmod(F.xxhash64(key, F.lit("thin")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return unit * total < F.lit(SURPLUS * wanted)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def map_rows(df: DataFrame, fn: Callable[[list[dict]], list[dict]], schema: str) -> DataFrame:
    """Apply fn to lists of at most ROWS_AT_ONCE rows, inside the tasks, through Arrow."""
    kinds = T._parse_datatype_string(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = arrow_schema(kinds)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows = fn(batch.slice(at, ROWS_AT_ONCE).to_pylist())
                yield pa.RecordBatch.from_pylist(rows, schema=out)

    return df.mapInArrow(run, kinds)
