"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.staging import Stage


def summary(edges: DataFrame) -> tuple:
    """Number of the edges and a digest of all of them."""
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("digest")).first()
    return row["n"], row["digest"]


def hang(edges: DataFrame) -> DataFrame:
    """Replace every edge (u, v) by (v, m) and (u, m), m being the smallest of u and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return edges.join(least, "u")


def components(stage: Stage, links: DataFrame) -> DataFrame:
    """Smallest node of the component of every linked node: columns node, component.

    Each step is a partial aggregation and a join on the node, with no group collected, and
    is written down. The number of steps grows with the logarithm of the largest component.
    The result goes to the caller's stage, the steps are removed.
    """
    steps = Stage(stage.spark, "components")
    edges = steps.write(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct())
    seen = summary(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = hang(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = steps.write(large.filter("u <> v").distinct())
        small = hang(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        edges = steps.write(small.filter("u <> v").distinct())
        # Finished when nothing moves: every node then hangs below its smallest one.
        last, seen = seen, summary(edges)
        if seen == last:
            break
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    found = stage.write(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(tops))
    steps.drop()
    return found
