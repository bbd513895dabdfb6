"""Line dedup by winnowing over line hashes.

A window is the shortest stretch of lines that holds MIN_WORDS words, counted forwards
from its first line or backwards from its last. The smallest line hash of a window is a
fingerprint, so two stretches that agree in a whole window share one for certain.
Windows whose fingerprint occurs only once need no further look. The others meet by the
hash of all their lines; every place but the first is a match. Windows that run forwards
and backwards extend a match both ways to its ends, and what overlaps becomes one run.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.staging import Stage
from feedloom.llm.common import ROWS_AT_ONCE, arrow_schema

# Words that a run must hold to be deleted where it is repeated.
MIN_WORDS = 50

SCANNED = (
    "doc_id long, text_key long, n_lines int, prints array<long>, "
    "windows array<struct<print:long,high:long,low:long,first:int,last:int>>"
)


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def windows_of(words: list[int], min_words: int) -> set[tuple[int, int]]:
    """Shortest stretches (first, last) of at least min_words words, from either end."""
    found, last, held = set(), -1, 0
    for first in range(len(words)):
        while held < min_words and last + 1 < len(words):
            last += 1
            held += words[last]
        if held < min_words:
            break
        found.add((first, last))
        held -= words[first]
    first, held = len(words), 0
    for last in range(len(words) - 1, -1, -1):
        while held < min_words and first > 0:
            first -= 1
            held += words[first]
        if held < min_words:
            break
        found.add((first, last))
        held -= words[last]
    return found


def scan_text(text: str, min_words: int) -> dict:
    """Fingerprints and windows of a text; line numbers count all lines from 0."""
    lines = text.split("\n")
    places, words, hashes = [], [], []
    for place, line in enumerate(lines):
        if n := len(line.split()):
            places.append(place)
            words.append(n)
            hashes.append(xxhash.xxh3_64_intdigest(line.strip().encode("utf-8", "surrogatepass")))
    raw = [h.to_bytes(8, "little") for h in hashes]
    chosen, windows = set(), []
    for first, last in sorted(windows_of(words, min_words)):
        lowest = min(range(last, first - 1, -1), key=hashes.__getitem__)  # the last of equal minima
        chosen.add(lowest)
        key = xxhash.xxh3_128_digest(b"".join(raw[first : last + 1]))
        windows.append(
            {
                "print": signed(hashes[lowest]),
                "high": int.from_bytes(key[:8], "big", signed=True),
                "low": int.from_bytes(key[8:], "big", signed=True),
                "first": places[first],
                "last": places[last],
            }
        )
    return {"n_lines": len(lines), "prints": [signed(hashes[i]) for i in sorted(chosen)], "windows": windows}


def text_key(text: Column) -> Column:
    """Tells rows apart that share an id but not their text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def scan(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    kinds = T._parse_datatype_string(SCANNED)
    kinds["doc_id"].dataType = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = arrow_schema(kinds)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows = [
                    {"doc_id": r["doc_id"], "text_key": r["text_key"], **scan_text(r["text"] or "", min_words)}
                    for r in batch.slice(at, ROWS_AT_ONCE).to_pylist()
                ]
                yield pa.RecordBatch.from_pylist(rows, schema=out)

    text = F.col(text_col)
    return docs.select(
        F.col(id_col).alias("doc_id"), text_key(text).alias("text_key"), text.alias("text")
    ).mapInArrow(run, kinds)


def repeated_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """Runs of lines that occur earlier, one row per text that has any.

    Columns: doc_id, text_key, runs (array of first and last line, merged and in order).
    Earlier means a smaller id (null ids last), then the smaller text key among rows with
    one id, then the earlier line. Rows that repeat both id and text are one place.
    """
    stage = Stage(docs.sparkSession, "lines")
    found = stage.write(scan(docs, id_col, text_col, min_words))
    shared = (
        found.select(F.explode("prints").alias("print"))
        .groupBy("print")
        .count()
        .filter("count > 1")
        .select("print")
    )
    windows = found.select("doc_id", "text_key", F.inline("windows"))
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_key", "first")
    met = stage.write(windows.join(shared, "print", "left_semi").withColumn("place", place).drop("print"))
    origins = (
        met.groupBy("high", "low")
        .agg(F.min("place").alias("origin"), F.max("place").alias("latest"))
        .filter(~F.col("origin").eqNullSafe(F.col("latest")))
        .drop("latest")
    )
    matches = met.join(origins, ["high", "low"]).filter(~F.col("place").eqNullSafe(F.col("origin")))
    spans = matches.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_set(F.struct("first", "last"))).alias("spans")
    )

    def merge(runs: Column, span: Column) -> Column:
        top = F.element_at(runs, -1)
        longer = F.struct(top["first"].alias("first"), F.greatest(top["last"], span["last"]).alias("last"))
        touches = (F.size(runs) > 0) & (span["first"] <= F.try_element_at(runs, F.lit(-1))["last"] + 1)
        return F.when(
            touches, F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(longer))
        ).otherwise(F.concat(runs, F.array(span)))

    empty = F.array().cast("array<struct<first:int,last:int>>")
    return spans.select("doc_id", "text_key", F.aggregate("spans", empty, merge).alias("runs"))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """Every row with the repeated runs taken out of its text, plus what was done.

    Columns: `row` (the whole input row, its text replaced), `n_lines`, `runs` (deleted
    runs as first and last line, numbered from 0; empty if none), `n_removed` (lines).
    A run is deleted if it holds at least min_words words and the same lines stand at an
    earlier place, in this text or another; lines are equal up to blanks at their ends, and
    blank lines hold no words and separate nothing. The first place of every line stays.
    Null and empty texts are returned as they are. Input columns may have any names.
    """
    text = F.col(text_col)
    keyed = docs.select(
        F.struct("*").alias("row"), F.col(id_col).alias("own_id"), text_key(text).alias("own_key"), text.alias("body")
    )
    runs = repeated_runs(docs, id_col, text_col, min_words)
    met = keyed.join(
        runs.hint("shuffle_hash"),
        keyed["own_id"].eqNullSafe(runs["doc_id"]) & (keyed["own_key"] == runs["text_key"]),
        "left",
    )
    lines = F.split("body", "\n")
    inside = lambda i: F.exists("runs", lambda r: (r["first"] <= i) & (i <= r["last"]))
    kept = F.array_join(F.filter(lines, lambda _, i: ~inside(i)), "\n")
    removed = F.aggregate("runs", F.lit(0), lambda n, r: n + r["last"] - r["first"] + 1)
    return met.select(
        F.col("row").withField(f"`{text_col}`", F.when(F.col("runs").isNull(), F.col("body")).otherwise(kept)).alias("row"),
        F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"),
        F.coalesce("runs", F.array().cast("array<struct<first:int,last:int>>")).alias("runs"),
        F.coalesce(removed, F.lit(0)).alias("n_removed"),
    )
