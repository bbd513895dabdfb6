"""Periodic runs of words, by uniting suffix classes in the order of falling common prefixes.

Suffixes of a text that agree in their first l words form a class. Going through the
neighbours of the suffix array by falling LCP, as Kruskal's algorithm goes through edges,
a union-find grows these classes, and each keeps its positions in order. Positions i < j
that become neighbours when classes are united at LCP l agree in exactly l words, so the
stretch from i to j + l has period j - i. If that is at most l and the word before i
differs from the word before j, the stretch is a maximal run, and every maximal run of
at least two periods comes up exactly once: its start and the place one period later
become neighbours at the level where they meet. Were its smallest period shorter, a place
between the two would have joined before them.

Texts are independent of each other; each one is worked on inside the task that reads it.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.text import let
from feedloom.llm.common import ROWS_AT_ONCE, arrow_schema

# Runs of at least so many words and so many periods.
MIN_WORDS, MIN_PERIODS = 6, 4

FOUND = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"

# Odd multipliers of the hashes by which words that stand in no repeated gram are passed over.
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def least_lcp(min_words: int, min_periods: int) -> int:
    """Smallest LCP of two suffixes that can start a run."""
    return min(max((min_periods - 1) * d, min_words - d, 1) for d in range(1, max(min_words, 2)))


def may_repeat(words: list[bytes], n: int) -> bool:
    """Whether some n words in a row may stand at two places; never wrongly False."""
    if len(words) <= n:
        return False
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    grams = hashes[: len(words) - n + 1].copy()
    for k in range(1, n):
        grams *= MULTIPLIER
        grams += hashes[k : len(words) - n + 1 + k]
    grams.sort()
    return bool((grams[1:] == grams[:-1]).any())


def suffix_neighbours(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in their order, and the LCP of each with the next; codes are 0, 1, 2 and so on."""
    n = len(codes)
    ranks = [codes.astype(np.int64)]  # ranks[t] compares the first 2**t words
    while int(ranks[-1].max()) + 1 < n:
        last, step = ranks[-1], 1 << (len(ranks) - 1)
        key = last * (n + 1)
        key[: max(n - step, 0)] += last[step:] + 1
        order = np.argsort(key, kind="stable")
        in_order = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(in_order[1:] != in_order[:-1])))
        ranks.append(rank)
    order = np.argsort(ranks[-1], kind="stable")
    left, right = order[:-1].copy(), order[1:].copy()
    lcp = np.zeros(max(n - 1, 0), np.int64)
    for t in range(len(ranks) - 2, -1, -1):
        rank = np.append(ranks[t], -1)  # past the end nothing is equal
        same = (rank[left] == rank[right]).astype(np.int64) << t
        lcp, left, right = lcp + same, left + same, right + same
    return order, lcp


def runs_of(words: list[bytes], min_words: int, min_periods: int) -> list[tuple[int, int, int]]:
    """Maximal runs (start, length, smallest period) in order of start and period."""
    least = least_lcp(min_words, min_periods)
    if not may_repeat(words, least):
        return []
    numbers: dict[bytes, int] = {}
    codes = [numbers.setdefault(w, len(numbers)) for w in words]
    order, lcp = suffix_neighbours(np.array(codes))
    # Suffix classes are stretches of the suffix array; `owner` leads to the first place of one.
    edges = np.flatnonzero(lcp >= least)
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    owner: dict[int, int] = {}
    places: dict[int, list[int]] = {}
    positions = order.tolist()
    runs = []

    def find(at: int) -> int:
        top = at
        while (up := owner.get(top, top)) != top:
            top = up
        while at != top:
            owner[at], at = top, owner.get(at, at)
        return top

    def seed(i: int, j: int, level: int) -> None:
        period = j - i
        if level + period >= min_words and level >= (min_periods - 1) * period and (i == 0 or codes[i - 1] != codes[j - 1]):
            runs.append((i, level + period, period))

    for at, level in zip(edges.tolist(), lcp[edges].tolist()):
        a, b = find(at), find(at + 1)
        large, small = places.pop(a, None) or [positions[at]], places.pop(b, None) or [positions[at + 1]]
        if len(large) < len(small):
            large, small = small, large
        last = len(small) - 1
        for k, p in enumerate(small):
            here = bisect_left(large, p)
            # Neighbours that come from the same class are not new.
            if here and (k == 0 or small[k - 1] < large[here - 1]):
                seed(large[here - 1], p, level)
            if here < len(large) and (k == last or small[k + 1] > large[here]):
                seed(p, large[here], level)
        if len(small) * 8 < len(large):
            for p in small:
                insort(large, p)
        else:
            large = sorted(large + small)  # two sorted stretches: one merge
        owner[b] = a
        places[a] = large
    return sorted((s, n, q) for s, n, q in runs)


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    kept = bytearray(b"\x01") * len(words)
    for start, length, period in runs:
        kept[start + period : start + length] = bytes(length - period)
    return [w for w, keep in zip(words, kept) if keep]


def find_runs(
    docs: DataFrame, id_col: str = "doc_id", text: Column | str = "text",
    min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS,
) -> DataFrame:
    """Maximal periodic runs of words in every text, and the text with each cut to one period.

    Columns: doc_id, n_words, runs (start, length, period; words from 0; by start, then
    period), collapsed. Words are stretches without blanks (space, tab to carriage return).
    A run is a stretch with smallest period q, of at least min_words words and min_periods
    periods, that no neighbouring word extends keeping that period. Runs may overlap. In
    `collapsed` words are dropped that some run contains after its first q words; the others
    are joined by one space. Null and empty texts have no words and no runs, and collapse
    to an empty text. Rows are independent: repeated ids and null ids each give their own
    row, and other columns, whatever their names, are not looked at. Work grows with n log^2 n
    for n words; a text is held by one task, whole.
    """
    kinds = T._parse_datatype_string(FOUND)
    kinds = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), *kinds.fields])
    body = F.col(text) if isinstance(text, str) else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = arrow_schema(kinds)
        names = ("start", "length", "period")
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                counts, runs, texts = [], [], []
                for value in part.column(1):
                    words = (value.as_py() or b"").split()
                    found = runs_of(words, min_words, min_periods)
                    counts.append(len(words))
                    runs.append([dict(zip(names, r)) for r in found])
                    texts.append(b" ".join(collapse(words, found) if found else words))
                columns = [part.column(0), *(pa.array(v, out.field(k + 1).type) for k, v in enumerate((counts, runs, texts)))]
                yield pa.RecordBatch.from_arrays(columns, schema=out)

    found = docs.select(F.col(id_col).alias("doc_id"), body.cast("binary").alias("body")).mapInArrow(run, kinds)
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def greatest_run(runs: Column) -> Column:
    """The run of the largest exact length / period; of equal ones the first in their order."""

    def better(best: Column, run: Column) -> Column:
        return F.when(best["length"] * run["period"] >= run["length"] * best["period"], best).otherwise(run)

    return F.reduce(F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.try_element_at(runs, F.lit(1)), better)


def with_planted_runs(doc_id: Column, text: Column) -> Column:
    """The text, in a tenth of the documents made periodic from some word on.

    With h = crc32 of the id as text and g = h div 10, texts with h mod 10 = 0 repeat the p
    words from word a = g mod n on, p being 1 + (n - a) div (3 + g mod 8). A null id plants nothing.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def planted(w: Column) -> Column:
        n = F.size(w)
        a = (g % F.greatest(n, F.lit(1))).cast("int")
        p = (F.floor((n - a) / (3 + g % 8)) + 1).cast("int")
        times = F.ceil((n - a) / p).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(F.slice(w, a + 1, p), times)), F.lit(1), n - a)
        return F.when(n == 0, text).otherwise(F.concat_ws(" ", F.slice(w, F.lit(1), a), tail))

    return F.when(F.coalesce(h % 10 == 0, F.lit(False)), let(words, planted)).otherwise(text)
