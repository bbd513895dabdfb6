"""Exact duplicates by a heavy-hitter split.

Misra-Gries summaries of the partitions name the digests that may be frequent. Their
groups are counted exactly and, being few by proof, broadcast: rows of frequent
digests are decided where they are read. All other digests are shuffled as usual, and
none of them can be a large share of the rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.functions.staging import Stage

# Counters of a summary. Of N rows, every digest with more than 2 * N / COUNTERS of them is found.
COUNTERS = 1024


def shrink(counts: Counter, counters: int) -> Counter:
    """At most `counters` entries; each loses the largest count that has no room."""
    if len(counts) <= counters:
        return counts
    cut = sorted(counts.values(), reverse=True)[counters]
    return Counter({key: n - cut for key, n in counts.items() if n > cut})


def summaries(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One Misra-Gries summary per partition: (digest, n), n being a lower bound there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            counts.update(batch.column(0).to_pylist())
            counts = shrink(counts, counters)
        yield pa.RecordBatch.from_pydict(
            {"digest": pa.array(counts.keys(), pa.binary()), "n": pa.array(counts.values(), pa.int64())}
        )

    return digests.select("digest").mapInArrow(run, "digest binary, n long")


def frequent_groups(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Exact groups of the digests that the summaries name: at most `counters` rows."""
    named = (
        summaries(digests, counters)
        .groupBy("digest")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "digest")
        .limit(counters)
        .select("digest")
    )
    counted = digests.join(F.broadcast(named), "digest").groupBy("digest")
    return counted.agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")).filter(
        F.col("group_size") > 1
    )


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS
) -> DataFrame:
    """For every row: the row of the same text that stays, and the size of their group.

    Columns: doc_id, keep_id, group_size, kept, text_sha256. Texts are equal when they
    are identical; a null text counts as empty. The largest id stays. Ids that are null
    only stay where a group has no other; rows that repeat an id share its decision. An
    empty table gives an empty result. Other columns are not looked at.
    """
    stage = Stage(docs.sparkSession, "exact")
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    digests = stage.write(
        docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"))
    )
    # At most `counters` rows, so the broadcasts below are bounded.
    winners = stage.write(frequent_groups(digests, counters).coalesce(1))
    same = W.partitionBy("digest")
    frequent = digests.join(F.broadcast(winners), "digest")
    others = (
        digests.join(F.broadcast(winners), "digest", "left_anti")
        .withColumn("keep_id", F.max("doc_id").over(same))
        .withColumn("group_size", F.count("*").over(same))
    )
    return frequent.unionByName(others).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
