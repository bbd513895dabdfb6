"""Text search with trigram posting lists.

Texts are dealt into blocks of a bounded number of rows and numbered within their block. For
every trigram of a block's lower-cased texts the index holds the sorted numbers of the
texts that have it, as differences. The lists are sorted by trigram, so a search reads only
the parts of the index that hold its trigrams. Texts that have all of them are candidates;
only the partitions with candidates are read, and only candidates are compared.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Rows of a block, and blocks of a partition of the stored texts.
BLOCK_ROWS, SHELF_BLOCKS = 1024, 64

_MASK = (1 << 21) - 1


def grams_of(text: str) -> np.ndarray:
    """Numbers of the different trigrams of a text: 21 bits for each character."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.unique((codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:])


def gram_text(gram: int) -> str:
    return "".join(chr(c) for c in (gram >> 42, gram >> 21 & _MASK, gram & _MASK))


def _post(table: pa.Table) -> pa.Table:
    """Posting lists of one block (block, place, low)."""
    places = table["place"].to_pylist()
    found = [grams_of(low) if low else np.zeros(0, np.int64) for low in table["low"].to_pylist()]
    grams = np.concatenate([np.zeros(0, np.int64), *found])
    owners = np.repeat(np.array(places, np.int32), [len(g) for g in found])
    order = np.lexsort((owners, grams))
    grams, owners = grams[order], owners[order]
    starts = np.flatnonzero(np.append(True, grams[1:] != grams[:-1])) if len(grams) else np.zeros(0, np.int64)
    steps = np.diff(owners, prepend=0)
    steps[starts] = owners[starts]  # the first of a list as it is
    lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(grams)), pa.int32()), pa.array(steps, pa.int32()))
    return pa.table(
        {
            "gram": pa.array([gram_text(int(g)) for g in grams[starts]], pa.string()),
            "block": pa.array(np.full(len(starts), table["block"][0].as_py(), np.int64)),
            "steps": lists,
        }
    )


class TextIndex:
    """A stored index over the texts of a table; the same sizes must build and search it."""

    def __init__(self, spark: SparkSession, path: str, block_rows: int = BLOCK_ROWS, shelf_blocks: int = SHELF_BLOCKS):
        self.spark, self.path, self.block_rows, self.shelf_blocks = spark, path, block_rows, shelf_blocks

    def build(self, df: DataFrame, id_col: str = "review_id", text: str = "review_text") -> TextIndex:
        """Store the texts, lower-cased, and their posting lists; null texts are left out.

        Ids that repeat are indexed each for itself. Rows of an id go to one block.
        """
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        rows = df.filter(F.col(text).isNotNull()).select(
            F.col(id_col).cast("string").alias("id"), F.lower(text).alias("low")
        )
        blocks = max(1, -(-rows.count() // self.block_rows))
        block = F.pmod(F.xxhash64("id"), F.lit(blocks))
        place = F.row_number().over(Window.partitionBy("block").orderBy("id", "low")) - 1
        numbered = (
            rows.withColumn("block", block)
            .withColumn("place", place)
            .withColumn("shelf", F.floor(F.col("block") / self.shelf_blocks))
        )
        numbered.write.mode("overwrite").partitionBy("shelf").parquet(f"{self.path}/texts")
        postings = self.texts().select("block", "place", "low").groupBy("block")
        lists = postings.applyInArrow(_post, "gram string, block long, steps array<int>")
        sorted_lists = lists.repartitionByRange(tasks, "gram", "block").sortWithinPartitions("gram", "block")
        sorted_lists.write.mode("overwrite").parquet(f"{self.path}/postings")
        return self

    def texts(self) -> DataFrame:
        schema = "id string, low string, block long, place int, shelf long"
        return self.spark.read.schema(schema).parquet(f"{self.path}/texts")

    def candidates(self, needle: str) -> DataFrame:
        """Places (block, place) of the texts that have all trigrams of the needle (3 characters or more)."""
        grams = [gram_text(int(g)) for g in grams_of(needle)]
        lists = self.spark.read.schema("gram string, block long, steps array<int>").parquet(f"{self.path}/postings")
        wanted = lists.filter(F.col("gram").isin(grams))

        def meet(table: pa.Table) -> pa.Table:
            # A block that lacks one of the trigrams has no candidate.
            places = np.zeros(0, np.int64)
            if table.num_rows == len(grams):
                every = sorted((np.cumsum(s.values.to_numpy()) for s in table["steps"]), key=len)
                places = reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True), every)
            block = table["block"][0].as_py()
            return pa.table({"block": pa.array([block] * len(places), pa.int64()), "place": pa.array(places, pa.int32())})

        return wanted.groupBy("block").applyInArrow(meet, "block long, place int")

    def search(self, query: str) -> DataFrame:
        """Ids of the texts that hold the literal query in any letter case.

        Queries of one or two characters have no trigram and read all texts.
        """
        needle = query.lower()
        holds = F.col("low").contains(needle)
        if len(needle) < 3:
            return self.texts().filter(holds).select("id")
        places = self.candidates(needle).withColumn("shelf", F.floor(F.col("block") / self.shelf_blocks))
        return self.texts().join(places, ["shelf", "block", "place"]).filter(holds).select("id")
