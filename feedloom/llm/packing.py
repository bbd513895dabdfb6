"""Best-fit packing by the linear grouping scheme.

Only the histogram of piece lengths (at most CAPACITY counts) is planned with. Large
lengths are put into groups of equal cardinality and rounded up to the largest of their
group. Configurations of these few sizes are optimised by column generation; then the
actual documents take the slots of their group, in order of length, which gives back
what the rounding lost. What is left over, and all small lengths, are placed by best fit,
longest first. The plan says for every length and rank where the piece goes, so the
documents are only numbered within their length and looked up.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.staging import Stage
from feedloom.llm.common import ROWS_AT_ONCE, arrow_schema

CAPACITY = 2048
END_ID = 0
# Lengths over CAPACITY / SMALL count as large; these are put into GROUPS groups.
SMALL = 3
GROUPS = 96
# Columns that are generated at most; any number gives a valid plan.
ROUNDS = 800

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
# Texts of only these characters are cut into words alike by both tokenizer libraries.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-ɏ]*")


@cache
def encoders(path: str):
    """The tokenizer of the file, and a faster encoder with the same vocabulary for plain texts."""
    import tiktoken
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(path)
    # Byte-level vocabularies write each byte as one printable character, in this order.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}
    special = {t.content for t in full.get_added_tokens_decoder().values()}
    ranks = {
        bytes(byte_of[c] for c in token): i for token, i in full.get_vocab().items() if token not in special
    }
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    plain = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return full, plain, special


def encode(path: str, text: str) -> list[int]:
    full, plain, special = encoders(path)
    if PLAIN.fullmatch(text) and not any(s in text for s in special):
        return plain.encode_ordinary(text)
    return full.encode(text, add_special_tokens=False).ids


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Pieces (start, length) of a document; all but the first are full."""
    first = n % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def pieces(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False
) -> DataFrame:
    """Token pieces of all documents; with keep_ids also their ids."""
    kinds = T._parse_datatype_string(PIECES + (", ids array<int>" if keep_ids else ""))
    kinds["doc_id"].dataType = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = arrow_schema(kinds)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows = []
                for r in batch.slice(at, ROWS_AT_ONCE).to_pylist():
                    ids = np.array([*encode(tokenizer, r["text"] or ""), END_ID], "<u4")
                    for piece, (start, length) in enumerate(cut(len(ids))):
                        own = ids[start : start + length]
                        row = {
                            "doc_id": r["doc_id"], "piece": piece, "start": start, "length": length,
                            "ids_crc32": zlib.crc32(own.tobytes()),
                        }
                        rows.append(row | ({"ids": own.tolist()} if keep_ids else {}))
                yield pa.RecordBatch.from_pylist(rows, schema=out)

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, kinds)


def group_sizes(counts: np.ndarray, lowest: int, groups: int) -> list[tuple[int, int, int]]:
    """Linear grouping of the lengths from `lowest` on, longest first: (largest, smallest, items).

    Groups hold equally many items, up to lengths that are not divided between groups.
    """
    lengths = [n for n in range(len(counts) - 1, lowest - 1, -1) if counts[n]]
    total = int(counts[lowest:].sum())
    out, seen = [], 0
    for n in lengths:
        k = seen * groups // max(total, 1)
        if out and out[-1][3] == k:
            out[-1] = (out[-1][0], n, out[-1][2] + int(counts[n]), k)
        else:
            out.append((n, n, int(counts[n]), k))
        seen += int(counts[n])
    return [g[:3] for g in out]


def best_pattern(sizes: list[int], values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the pattern of largest value that fits."""
    best, taken = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.array(sizes)
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        fits = order <= room
        if fits.any():
            value = np.where(fits, values + best[room - np.minimum(order, room)], -1.0)
            k = int(value.argmax())
            if value[k] > best[room] + 1e-12:
                best[room], taken[room] = value[k], k
    pattern, room = np.zeros(len(sizes), int), capacity
    while room > 0:
        if taken[room] < 0:
            room -= 1
        else:
            pattern[taken[room]] += 1
            room -= sizes[taken[room]]
    return float(best[capacity]), pattern


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often each is used, from the linear program by column generation.

    Shares are rounded down; what they leave over is placed by best fit afterwards.
    """
    n = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    need = np.array(demand, float)
    for _ in range(ROUNDS):
        inverse = np.linalg.inv(basis)
        value, pattern = best_pattern(sizes, np.maximum(np.ones(n) @ inverse, 0.0), capacity)
        if value <= 1 + 1e-7:
            break
        amounts, direction = inverse @ need, inverse @ pattern
        usable = direction > 1e-9
        ratio = np.where(usable, np.maximum(amounts, 0.0) / np.where(usable, direction, 1.0), np.inf)
        basis[:, int(ratio.argmin())] = pattern
    amounts = np.linalg.solve(basis, need)
    return [(basis[:, j].astype(int), int(amounts[j] + 1e-6)) for j in range(n) if amounts[j] >= 1 - 1e-6]


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> dict[int, np.ndarray]:
    """For every length the rows (first rank, first sequence, offset), ranks ascending.

    The pieces of a length with ranks from the first one on go to consecutive sequences,
    all at the same offset, up to the next row's first rank. The number of rows depends on
    the number of different lengths, not on the number of pieces.
    """
    counts = counts.astype(np.int64).copy()
    rows: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    used = np.zeros(capacity + 1, np.int64)  # ranks given out per length
    room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # open (first sequence, number)
    sequences = int(counts[capacity])
    if sequences:  # full pieces fill a sequence each
        rows[capacity].append((0, 0, 0))
    counts[capacity] = 0

    groups = group_sizes(counts, capacity // SMALL + 1, GROUPS)
    if groups:
        left = {g: [(n, int(counts[n])) for n in range(hi, lo - 1, -1) if counts[n]] for g, (hi, lo, _) in enumerate(groups)}
        for pattern, times in configurations([g[0] for g in groups], [g[2] for g in groups], capacity):
            slots = []  # per slot: stretches of equal length over the pattern's sequences
            for g in np.flatnonzero(pattern):
                for _ in range(pattern[g]):
                    stretches, missing = [], times
                    while missing and left[g]:
                        n, have = left[g][0]
                        take = min(have, missing)
                        stretches.append((n, take))
                        missing -= take
                        left[g][0] = (n, have - take)
                        if have == take:
                            left[g].pop(0)
                    slots.append(stretches + [(0, missing)] * bool(missing))
            ends = sorted({0, times, *(int(e) for s in slots for e in np.cumsum([t for _, t in s]))})
            for a, b in pairwise(ends):
                offset = 0
                for s in slots:
                    n = s[int(np.searchsorted(np.cumsum([t for _, t in s]), a, side="right"))][0]
                    if n:
                        rows[n].append((int(used[n]), sequences + a, offset))
                        used[n] += b - a
                        offset += n
                if offset:
                    room[capacity - offset].append((sequences + a, b - a))
            sequences += times

    for n in range(capacity - 1, 0, -1):  # best fit, longest first
        missing, free = int(counts[n] - used[n]), n
        while missing:
            while free <= capacity and not room[free]:
                free += 1
            if free > capacity:  # open as many sequences as the rest needs
                new = -(-missing // (capacity // n))
                room[capacity].append((sequences, new))
                sequences += new
                free = capacity
            first, number = room[free].pop()
            take = min(number, missing)
            if number > take:
                room[free].append((first + take, number - take))
            rows[n].append((int(used[n]), first, capacity - free))
            used[n] += take
            missing -= take
            room[free - n].append((first, take))
            free = n if free - n >= n else free
    return {n: np.array(sorted(r), np.int64) for n, r in rows.items()}


def pack(pieces_: DataFrame) -> DataFrame:
    """Add sequence_id and offset to pieces: gapless from 0, no sequence over CAPACITY tokens.

    Ranks within a length come from counts per length and part (a hash of the piece), so
    that a length that very many pieces share is spread over tasks.
    """
    spark = pieces_.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)).alias("part")
    staged = Stage(spark, "packing").write(pieces_.select("*", part))
    sizes = staged.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    # At most CAPACITY rows reach the driver.
    histogram = staged.groupBy("length").count().collect()
    counts = np.zeros(CAPACITY + 1, np.int64)
    for row in histogram:
        counts[row["length"]] = row["count"]
    places = plan(counts)
    offsets = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = W.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        staged.withColumn("own", F.row_number().over(own) - 1)
        .join(offsets, ["length", "part"])
        .withColumn("rank", F.col("own") + F.col("before"))
        .drop("own", "before", "part")
    )
    kinds = T.StructType(
        [f for f in ranked.schema if f.name != "rank"]
        + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = arrow_schema(kinds)
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for n in np.unique(lengths):
                mine, table = lengths == n, places[int(n)]
                at = np.searchsorted(table[:, 0], ranks[mine], side="right") - 1
                sequence[mine] = table[at, 1] + ranks[mine] - table[at, 0]
                offset[mine] = table[at, 2]
            columns = [batch.column(f.name) for f in kinds if f.name in batch.schema.names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], schema=out)

    return ranked.mapInArrow(place, kinds)


def pack_documents(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False
) -> DataFrame:
    """Pack all documents into as few sequences of CAPACITY tokens as the scheme finds.

    A document is its token ids and the end id 0; a null text counts as empty, so it is
    the end id alone. Longer ones are cut into full pieces, the first of which may be
    shorter. Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset and, with
    keep_ids, ids. Repeated rows are packed each for itself; an empty table gives none.
    `tokenizer` is the path of a byte-level tokenizer file that every executor can read.
    """
    return pack(pieces(docs, tokenizer, id_col, text_col, keep_ids))
