"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order. Every segment of the vectors
keeps an inverted file: for each pivot, the position it has in each vector's list. A query
is ranked against a segment by Spearman's footrule between the lists, read pivot by pivot
from the file, and the best share is ranked again by the exact inner product.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.staging import Stage

# Pivots are a sample of this many vectors; each vector keeps its PREFIX nearest in order.
PIVOTS = 128
PREFIX = 32
# Share of a segment that is ranked again, and the least number.
SHARE = 0.3
AT_LEAST = 256
# Vectors in a segment and queries in a block, on average.
SEGMENT = 4096
BLOCK = 4096


def as_matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Vectors that take part, with a digest of their components: id and vector not null, all
    components finite, not all zero, and of the length that most of these have."""
    x = F.col("vector")
    fine = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")).filter(
        F.col("vec_id").isNotNull()
        & x.isNotNull()
        & F.exists(x, lambda v: v != 0)
        & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < math.inf))
    )
    common = fine.groupBy(F.size(x).alias("n")).count().orderBy(F.desc("count"), "n").first()
    fine = fine.filter(F.size(x) == (common["n"] if common else 0))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = as_matrix(batch.column("vector")) + 0.0  # no negative zeros
            keys = pa.array([hashlib.md5(r.tobytes()).digest() for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], names=["vec_id", "vector", "digest"])

    kinds = T.StructType([*fine.schema, T.StructField("digest", T.BinaryType())])
    return fine.mapInArrow(digest, kinds)


def orders(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Numbers of each vector's nearest pivots (largest inner product), nearest first."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :prefix]


def inverted_file(order: np.ndarray, n_pivots: int) -> np.ndarray:
    """Row p holds pivot p's position in every vector's list; where it is missing, the list's length."""
    file = np.full((n_pivots, len(order)), order.shape[1], np.int16)
    file[order, np.arange(len(order))[:, None]] = np.arange(order.shape[1], dtype=np.int16)
    return file


def footrule(order: np.ndarray, file: np.ndarray) -> np.ndarray:
    """Footrule distance of one query's list to all vectors of the file.

    A pivot that is missing in a list stands behind its end, on either side.
    """
    prefix = len(order)
    found = file[order]
    apart = np.abs(found - np.arange(prefix, dtype=np.int16)[:, None]).sum(axis=0, dtype=np.int32)
    # Pivots that only the vector has: all its positions, less those of the shared ones.
    return apart + prefix * (prefix + 1) // 2 - (prefix - found).sum(axis=0, dtype=np.int32)


def search(queries: pa.Table, vectors: pa.Table, pivots: np.ndarray, k: int) -> pa.Table:
    """The k vectors of the segment with the largest inner product among those footrule keeps."""
    out = {"query": [], "vec_id": [], "score": []}
    if queries.num_rows and vectors.num_rows:
        q, x = as_matrix(queries["wanted"]), as_matrix(vectors["vector"])
        names, ids = queries["query"].to_pylist(), vectors["vec_id"].to_numpy()
        prefix = min(PREFIX, len(pivots))
        file, lists = inverted_file(orders(x, pivots, prefix), len(pivots)), orders(q, pivots, prefix)
        # More than the rounding of two sums of products can differ by, for a vector of length 1.
        slack = 4 * x.shape[1] * np.finfo(float).eps * math.sqrt((x * x).sum(axis=1).max())
        keep = min(len(x), max(AT_LEAST, math.ceil(SHARE * len(x))))
        for name, vector, order in zip(names, q, lists, strict=True):
            near = np.arange(len(x))
            if keep < len(x):
                near = np.argpartition(footrule(order, file), keep - 1)[:keep]
            rough = x[near] @ vector
            if len(near) > 2 * k:
                # Equal scores stay together: among them the ids decide.
                margin = slack * float(np.sqrt(vector @ vector))
                near = near[rough >= np.partition(rough, -2 * k)[-2 * k] - margin]
            exact = (x[near] * vector).sum(axis=1)
            best = np.lexsort((ids[near], -exact))[:k]
            out["query"] += [name] * len(best)
            out["vec_id"] += ids[near[best]].tolist()
            out["score"] += exact[best].tolist()
    return pa.table(out, schema=pa.schema({"query": pa.binary(), "vec_id": pa.int64(), "score": pa.float64()}))


def nearest(
    vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The k nearest found for every query row: query_id, rank (from 1), vec_id, score.

    Nearness is the inner product in double precision; ties go to the smaller id, and a row
    is not its own neighbour. `is_query` turns the id column into a condition. Null, zero and
    non-finite vectors, null ids and vectors of another length than most take no part.
    Equal vectors are searched once: of each only the k + 1 smallest ids can be needed, so
    a vector with very many copies costs no more than others. Rows that repeat an id and
    its vector count once. Every vector is in the index; only the pivots are a sample.
    """
    spark = vectors.sparkSession
    stage = Stage(spark, "neighbours")
    all_rows = stage.write(usable(vectors, id_col, vector_col))
    same = W.partitionBy("digest").orderBy("vec_id")
    members = stage.write(
        all_rows.select("digest", "vec_id")
        .withColumn("n", F.dense_rank().over(same))
        .filter(F.col("n") <= k + 1)
        .distinct()
    )
    one = members.filter("n = 1").select("digest", "vec_id")
    classes = stage.write(all_rows.join(one, ["digest", "vec_id"], "left_semi").dropDuplicates(["digest", "vec_id"]))
    # PIVOTS rows at most; the class is told by its smallest id.
    sample = classes.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).select("vector").collect()
    n = classes.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    pivots = np.array([r["vector"] for r in sample])

    asking = all_rows.filter(is_query(F.col("vec_id"))).select("digest", F.col("vec_id").alias("query_id")).distinct()
    asked = stage.write(asking)
    query_rows = stage.write(
        classes.join(asked.select("digest").distinct(), "digest", "left_semi").select(
            F.col("digest").alias("query"), F.col("vector").alias("wanted")
        )
    )
    segments, blocks = math.ceil(n / SEGMENT), math.ceil(asked.count() / BLOCK) or 1
    left = query_rows.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int")).withColumn(
        "segment", F.explode(F.sequence(F.lit(0), F.lit(segments - 1)))
    )
    right = classes.withColumn("segment", F.pmod(F.xxhash64("digest"), F.lit(segments)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    found = (
        left.groupBy("block", "segment")
        .cogroup(right.groupBy("block", "segment"))
        .applyInArrow(lambda q, x: search(q, x, pivots, k + 1), "query binary, vec_id long, score double")
    )
    per_query = W.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("n", F.row_number().over(per_query)).filter(F.col("n") <= k + 1)
    # From classes to their members, then to the queries that share the vector.
    kin = members.withColumnRenamed("digest", "kin").drop("n")
    with_kin = (
        best.select("query", "vec_id", "score")
        .join(one.withColumnRenamed("digest", "kin"), "vec_id")
        .select("query", "kin", "score")
        .join(kin, "kin")
    )
    ordered = with_kin.groupBy("query").agg(
        F.slice(
            F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id", "score"))), 1, k + 1
        ).alias("near")
    )
    others = F.filter("near", lambda x: x["vec_id"] != F.col("query_id"))
    return (
        asked.join(ordered, asked["digest"] == ordered["query"])
        .select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "hit"))
        .select("query_id", (F.col("at") + 1).alias("rank"), "hit.vec_id", "hit.score")
    )
