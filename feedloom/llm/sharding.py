"""Shards that are balanced in bytes, tokens and rows at once, by vector bin packing.

Groups of equal texts are the items. Each has a vector: its share of a shard's bytes,
tokens and rows. From the largest down, each goes to the shard where the dot product of
its vector with what is left of the shard's capacity is highest.

The driver sees a bounded number of items however large the table is. A group that is a
noticeable part of a shard is an item of its own, and there can only be so many of them.
All others are dealt into a fixed number of bundles by the hash of their text, and a
bundle is placed as one. A group that is larger than a shard is cut into pieces.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.functions.staging import Stage

# Bundles per shard. A group of at least one such part of a shard is placed by itself.
PER_SHARD = 512
# A group that exceeds a shard is cut into pieces of about one such part of a shard.
PIECES = 4
# Bytes, tokens, rows: how much each counts in the dot product. Bytes come first.
WEIGHTS = (4.0, 1.0, 1.0)
# Rows that are numbered together.
BUCKET_ROWS = 50_000

DIMENSIONS = ("bytes", "tokens", "rows")
OVERHEAD = 16


def place(vectors: np.ndarray, shards: int, weights: tuple[float, ...] = WEIGHTS) -> np.ndarray:
    """Shard of every item; vectors has one row per item and is in the wanted order of ties.

    Shards share the total equally. What is left of one may fall below zero; equal dot
    products go to the lowest number.
    """
    capacity = vectors.sum(axis=0) / shards
    shares = np.divide(vectors, capacity, out=np.zeros_like(vectors, dtype=float), where=capacity > 0)
    order = np.argsort(-shares.max(axis=1, initial=0), kind="stable")
    shares = shares * np.array(weights)
    left = np.tile(np.array(weights), (shards, 1))
    out = np.zeros(len(vectors), np.int32)
    for item in order:
        shard = int(np.argmax(left @ shares[item]))
        out[item] = shard
        left[shard] -= shares[item]
    return out


def measured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One narrow row per document: id, digest of its text, bytes, tokens and checksum."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("bytes"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
        F.crc32(text.cast("binary")).alias("crc"),
    )


def summed(*more: Column) -> list[Column]:
    return [F.sum(c).cast("long").alias(c) for c in DIMENSIONS] + list(more)


def numbered(rows: DataFrame, total: int, shards: int, bucket_rows: int) -> DataFrame:
    """Adds slot, gapless from 0 in every shard: rows are numbered within buckets of a shard,
    and every bucket starts where those before it end."""
    buckets = max(1, -(-total // (shards * bucket_rows)))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "crc"), F.lit(buckets)).cast("int"))
    before = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        rows.groupBy("shard", "bucket").count()
        .select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    )
    own = F.row_number().over(W.partitionBy("shard", "bucket").orderBy("doc_id", "crc", "bytes"))
    return (
        rows.withColumn("own", own).join(starts, ["shard", "bucket"])
        .withColumn("slot", F.col("first") + F.col("own") - 1).drop("bucket", "own", "first")
    )


def assign(
    docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", per_shard: int = PER_SHARD,
    weights: tuple[float, ...] = WEIGHTS, bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """The shard of every row and its slot there.

    Columns: doc_id, digest (SHA-256 of the text), bytes (of the text in UTF-8, plus 16),
    tokens (words between blanks), crc, shard (from 0), slot (gapless from 0 in each shard).
    Rows of equal texts share a shard, null and empty texts being equal; only a group that
    exceeds an equal share of bytes, tokens or rows is cut into pieces, by a hash of the id,
    so rows that repeat an id stay together. Null ids are an id like any other. The result
    depends on the rows alone, not on their order or partitions; of rows that are alike in
    id and text any may have either slot. An empty table gives an empty result. Other
    columns, whatever their names, are not looked at. Jobs run when this is called; the driver receives at most
    4 * shards * per_shard items and the pieces of groups larger than a shard.
    """
    spark = docs.sparkSession
    stage = Stage(spark, "shards")
    rows = stage.write(measured(docs, id_col, text_col))
    groups = stage.write(rows.groupBy("digest").agg(*summed()[:2], F.count(F.lit(1)).alias("rows")))
    totals = groups.agg(*summed()).first()
    share = F.greatest(*[F.col(c) * shards / max(totals[c] or 0, 1) for c in DIMENSIONS])
    bundle = F.pmod(F.xxhash64("digest"), F.lit(shards * per_shard))
    # Shares of a dimension add up to `shards`, so at most 3 * shards * per_shard groups are large.
    pieces = F.when(share > 1, F.ceil(share * PIECES)).otherwise(1)
    large = stage.write(groups.filter(share * per_shard >= 1).withColumn("pieces", pieces).coalesce(1))
    cut = F.broadcast(large.filter("pieces > 1").select("digest", "pieces"))
    piece = F.pmod(F.xxhash64("doc_id"), F.col("pieces"))
    nothing = F.lit(bytearray())
    items = stage.write(
        groups.filter(share * per_shard < 1).groupBy(nothing.alias("key"), bundle.alias("part")).agg(*summed())
        .unionByName(large.filter("pieces = 1").select(F.col("digest").alias("key"), F.lit(0).cast("long").alias("part"), *DIMENSIONS))
        .unionByName(
            rows.join(cut, "digest").groupBy(F.col("digest").alias("key"), piece.alias("part"))
            .agg(*summed()[:2], F.count(F.lit(1)).alias("rows"))
        )
    )
    table = items.orderBy("key", "part").toArrow()
    vectors = np.stack([table[c].to_numpy() for c in DIMENSIONS], axis=1).astype(float)
    shard = pa.array(place(vectors, shards, weights), pa.int32())
    placed = stage.write(spark.createDataFrame(table.select(["key", "part"]).append_column("shard", shard)).coalesce(1))
    # Both sides that are broadcast have the bounds above.
    keyed = rows.join(F.broadcast(large.select("digest", "pieces")), "digest", "left").withColumns({
        "key": F.when(F.col("pieces").isNull(), nothing).otherwise(F.col("digest")),
        "part": F.when(F.col("pieces").isNull(), bundle).when(F.col("pieces") > 1, piece).otherwise(0),
    }).drop("pieces")
    assigned = stage.write(keyed.join(F.broadcast(placed), ["key", "part"]).drop("key", "part"))
    return numbered(assigned, totals["rows"] or 0, shards, bucket_rows)


def balance(assigned: DataFrame) -> DataFrame:
    """Rows, bytes and tokens of every shard."""
    return assigned.groupBy("shard").agg(F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))


def write_shards(spark: SparkSession, docs: DataFrame, assigned: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the rows under one folder per shard. Rows meet their shard by id and text."""
    where = assigned.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "shard").distinct()
    text = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256))
    met = docs.join(where, F.col(id_col).eqNullSafe(F.col("_id")) & (text == F.col("_digest")))
    met.drop("_id", "_digest").write.partitionBy("shard").parquet(path)
