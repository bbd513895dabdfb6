"""Near-duplicate removal, exact and without comparing all pairs.

Two texts are near-duplicates when `200 * LCS / (la + lb)` of their lower-cased,
stripped heads exceeds `percent`; with `whole`, of their whole texts as well. A text is
dropped when an earlier kept text is a near-duplicate of it.

Candidates. If heads a and b are that close, a becomes b with at most
`edits(la, lb)` single-character deletions and insertions. Cut a into more blocks
than that and at least one block survives untouched in b, moved by a bounded
distance. The blocks may lie anywhere as long as they do not overlap. So every head is indexed
by as many disjoint blocks as it needs, chosen so that the most frequent one of them is as rare as
can be, and looked up by its substrings of block width that are as rare as that one or rarer (its top):
of two close heads the one whose top is rarer has a block that the other looks up, so an
equi-join of the two misses no pair. Common openings and words are in neither. How rare a block is
was learned from a sample of heads; another order costs time and changes no result.
Rows of this join are a hash, a number, positions and marks; heads join later.

Marks. Unrelated heads of one language share blocks too, and their pairs grow as the
square of the table. Every row therefore carries how often its head has each kind of character,
in a code of which one deletion or insertion turns at most one bit. The join itself drops
pairs that differ in more bits than they may in characters, which are nearly all unrelated ones, and
compares rows of the same part of the head only.

Hot blocks. Equal texts are reduced to the earliest one first, so plain
copies never meet. A block that is still shared by more than `hot` heads is not
joined pair by pair at once: every head that holds it is first compared with the
earliest holder only. A head that is close to it waits; when the holder is kept,
the head is dropped and its other pairs are never needed. Only heads that stay
undecided look at the whole block.

Crowds. If whole texts count, many different texts may have one head. More than `crowd` of
them do not meet by its blocks: each is compared with the earliest one and may wait as
above. Those that do not wait meet by blocks of their whole texts, whose rarest ones
leave the common opening out unless it is a large part of the text.

Sizes. Texts that are compared whole only meet those of a size within the bound: the join has a
step of the size's logarithm beside the part of the head.

Portions. Families of near-copies grow with the table, and their pairs as the square. So the rows are decided
in portions of the input's order, each larger than all before it. A portion first meets the kept
texts of those before, which drop most of a family, and only what is left meets among itself.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.staging import Stage, sized
from ..functions.text import strip, strip_ends

# Twenty blocks of six characters fit into a head of 200 behind an opening of 78 characters, which
# wider ones would have to use.
WIDTH = 6
# Heads from which the order of the blocks is learned, and the bits of a counter's number.
LEARN = 50_000
COUNTERS = 22
# Heads whose blocks are chosen at once, some 10 KB each.
HEADS_AT_ONCE = 2_048
# Widest blocks of whole texts.
WHOLE_WIDTH = 7
# Places of a head whose blocks are joined together.
ZONE = 16
MARKS = ("m0", "m1", "m2", "m3")
# More holders of a block, of about one size, are first compared with the earliest one. In large portions that many
# share a block by chance: there it takes one of so many rows.
HOT = 100
HOT_SHARE = 2_000
# Index rows that a task of the join holds.
HELD = 1_000_000
# Rows of the first portion, and how many times as many rows as before it there are after the next one.
FIRST_ROWS = 50_000
GROWTH = 4


def head_of(text: Column, head_chars: int) -> Column:
    return F.substring(strip(F.lower(text)), 1, head_chars)


def edits(la: Column, lb: Column, percent: int) -> Column:
    """Most deletions plus insertions between two heads above the threshold."""
    return F.floor(((la + lb) * (100 - percent) - 1) / 100).cast("int")


def longest(length: Column, percent: int, head_chars: int) -> Column:
    """Longest head that can still be close to one of this length."""
    bound = F.floor((length * (200 - percent) - 1) / percent).cast("int")
    return F.least(F.greatest(bound, length), F.lit(head_chars))


def shortest(length: Column, percent: int) -> Column:
    """Shortest head that can still be close to one of this length."""
    bound = (F.floor(length * percent / (200 - percent)) + 1).cast("int")
    return F.greatest(F.least(bound, length), F.lit(1))


def needed(length: Column, percent: int, head_chars: int) -> Column:
    """Number of blocks of which at least one survives in every close head."""
    return edits(length, longest(length, percent, head_chars), percent) + 1


def width(length: Column, percent: int, head_chars: int) -> Column:
    fitting = F.floor(length / needed(length, percent, head_chars)).cast("int")
    return F.greatest(F.least(fitting, F.lit(WIDTH)), F.lit(1))


def common_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence, bit-parallel (Hyyrö, 2004)."""

    def one(x: str, y: str) -> int:
        places: dict[str, int] = {}
        for i, c in enumerate(x):
            places[c] = places.get(c, 0) | (1 << i)
        full = (1 << len(x)) - 1
        row = full
        for c in y:
            hit = row & places.get(c, 0)
            row = ((row + hit) | (row - hit)) & full
        return len(x) - row.bit_count()

    # Defined here so that it travels to the executors by value.
    @F.pandas_udf(T.IntegerType())
    def lengths(xs: pd.Series, ys: pd.Series) -> pd.Series:
        return pd.Series([one(x, y) for x, y in zip(xs, ys)], dtype="int32")

    return lengths(a, b)


def alike(a: str, b: str, percent: int) -> bool:
    """Whether 200 * LCS exceeds percent of the joint length.

    What the texts share at both ends is taken off. Then each may only leave out so many
    characters that the rest can still reach the bound, so matches lie in a band around the
    diagonal: the bit-parallel rows (Hyyrö, 2004) are as wide as the band and move along it, and the
    search ends when the characters that are left cannot make up for those that were missed.
    """
    least = percent * (len(a) + len(b)) // 200 + 1
    if min(len(a), len(b)) < least:
        return False
    spare_a, spare_b = len(a) - least, len(b) - least
    shared = 0
    for _ in range(2):  # the opening, then, turned round, the end
        most = min(len(a), len(b))
        step, at = 1, 0
        while at < most and a[at : at + step] == b[at : at + step]:
            at, step = min(at + step, most), step * 2
        while step > 1:
            step //= 2
            if at + step <= most and a[at : at + step] == b[at : at + step]:
                at += step
        shared += at
        a, b = a[at:][::-1], b[at:][::-1]
    found, rows = shared, max(256, spare_a + spare_b)
    low, width, state = 0, 0, 0  # state has a bit for each place of b from low on, 0 where the LCS grows
    for start in range(0, len(a), rows):
        part = a[start : start + rows]
        first, last = max(0, start - spare_a), min(len(b), start + len(part) + spare_b)
        if last <= first:
            break
        gone = min(first - low, width)
        found += gone - (state & ((1 << gone) - 1)).bit_count()
        state >>= gone
        state |= ((1 << (last - first)) - 1) >> (width - gone) << (width - gone)
        low, width = first, last - first
        places: dict[str, int] = {}
        bit = 1
        for c in b[first:last]:
            places[c] = places.get(c, 0) | bit
            bit <<= 1
        full = bit - 1
        for c in part:
            hit = state & places.get(c, 0)
            if hit:
                state = ((state + hit) | (state - hit)) & full
        if found + width - state.bit_count() + len(a) - start - len(part) < least:
            return False
    return found + width - state.bit_count() >= least


def marks(text: Column) -> Column:
    """Four longs (m0 to m3) that differ in no more bits than the texts in deletions and insertions.

    Characters are of 32 kinds. A count's code is that of a ring of sixteen places in eight bits (Johnson),
    where neighbours differ in one bit.
    """

    schema = T.StructType([T.StructField(name, T.LongType()) for name in MARKS])

    @F.pandas_udf(schema)
    def coded(texts: pd.Series) -> pd.DataFrame:
        ring = np.array([(1 << k) - 1 if k <= 8 else (255 << (k - 8)) & 255 for k in range(16)], np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        cells = np.repeat(np.arange(len(texts)), lengths) * 32 + codes % 32
        counts = np.bincount(cells, minlength=32 * len(texts)).reshape(-1, 32)
        return pd.DataFrame(ring[counts % 16].view(np.int64), columns=list(MARKS))

    return coded(text)


def span(size: Column, percent: int) -> Column:
    """Step of a size; texts that can be close are of the same or the next one."""
    step = max(2 * math.log((200 - percent) / percent), 0.01)
    return F.floor(F.log(F.greatest(size, F.lit(1)).cast("double")) / step).cast("int")


def cell(pos: Column, step: Column, head_chars: int) -> Column:
    """Number of a part of the head and a step of the size."""
    return (F.floor(pos / ZONE) + step * (head_chars // ZONE + 1)).cast("int")


@lru_cache(maxsize=100_000)
def head_plan(length: int, percent: int, head_chars: int) -> tuple[int, tuple[int, ...]]:
    """As `needed`, and the block widths of all heads that can be close to one of this length."""

    def high(n: int) -> int:
        return min(max((n * (200 - percent) - 1) // percent, n), head_chars)

    def need(n: int) -> int:
        return most_edits(n, high(n), percent) + 1

    low = max(min(length * percent // (200 - percent) + 1, length), 1)
    widths = {max(min(n // need(n), WIDTH), 1) for n in range(low, high(length) + 1)}
    return need(length), tuple(sorted(w for w in widths if w <= length))


def hashes(letters: np.ndarray, w: int) -> np.ndarray:
    """Of every substring of w letters; rows are places, columns are texts."""
    places = letters.shape[0] - w + 1
    out = np.full((places, letters.shape[1]), w, np.uint64)
    for k in range(w):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += letters[k : k + places]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def hashed_parts(
    heads: Iterator[pa.RecordBatch], percent: int, head_chars: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, int, np.ndarray, np.ndarray]]:
    """Heads of one block width at a time: their rows, how many blocks each needs, the width, hashes by place and text, places in use."""
    for batch in heads:
        for start in range(0, batch.num_rows, HEADS_AT_ONCE):
            part = batch.slice(start, HEADS_AT_ONCE)
            texts = part.column("head").to_pylist()
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            plans = [head_plan(n, percent, head_chars) for n in lengths.tolist()]
            codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
            starts = np.cumsum(lengths) - lengths
            owner = np.repeat(np.arange(len(texts)), lengths)
            letters = np.zeros((int(lengths.max()), len(texts)), np.uint64)
            letters[np.arange(len(codes)) - starts[owner], owner] = codes
            for w in sorted({w for _, widths in plans for w in widths}):
                mine = np.array([i for i, (_, widths) in enumerate(plans) if w in widths])
                n = lengths[mine]
                need = np.array([plans[i][0] for i in mine.tolist()])
                found = hashes(letters[: int(n.max()), mine], w)
                yield part.take(pa.array(mine)), need, w, found, np.arange(found.shape[0])[:, None] <= n - w


def learned(heads: DataFrame, percent: int, head_chars: int, rows: int = LEARN) -> np.ndarray:
    """How often blocks occur in some of the heads, by the first bits of their hashes.

    Only the order in which blocks are preferred follows from this, never which heads are close.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNTERS, np.int32)
        for _, _, _, found, used in hashed_parts(batches, percent, head_chars):
            np.add.at(total, (found[used] >> np.uint64(64 - COUNTERS)).astype(np.int64), 1)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], names=["at", "n"])

    step = max(1, heads.count() // rows)
    some = heads.filter(F.pmod(F.xxhash64("nid"), F.lit(step)) == 0).select("head")
    # Counters of one block are as good as none.
    sums = some.mapInArrow(count, "at int, n int").groupBy("at").agg(F.sum("n").cast("int").alias("n")).filter("n > 1").toArrow()
    out = np.zeros(1 << COUNTERS, np.int32)
    out[sums.column("at").to_numpy()] = sums.column("n").to_numpy()
    return out


def chosen(order: np.ndarray, used: np.ndarray, need: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Of every text the highest order that `need` disjoint substrings must have at least, and which ones these are.

    Rows of `order` are places. Texts without so many get none, and an order above all others.
    """
    places, texts = order.shape

    def fitting(top: np.ndarray, mark: np.ndarray | None = None) -> np.ndarray:
        number, free = np.zeros(texts, np.int64), np.zeros(texts, np.int64)
        for at in range(places):
            # From left to right: no other choice of substrings of one width has more of them.
            take = (order[at] <= top) & (free <= at)
            number += take
            free[take] = at + w
            if mark is not None:
                mark[at] = take
        return number

    ranked = np.sort(order, axis=0)
    column, most = np.arange(texts), used.sum(axis=0)
    possible = (most + w - 1) // w >= need  # all of them, side by side
    low, high = np.minimum(need, most) - 1, most - 1
    while (low < high).any():
        middle = (low + high) // 2
        enough = fitting(ranked[middle, column]) >= need
        low, high = np.where(enough, low, np.minimum(middle + 1, high)), np.where(enough, middle, high)
    top = ranked[low, column]
    mark = np.zeros(order.shape, bool)
    fitting(top, mark)
    mark[:, ~possible] = False
    return np.where(possible, top, NEVER - 1), mark


NEVER = np.iinfo(np.int64).max


def entries(heads: DataFrame, percent: int, head_chars: int, counts: Broadcast) -> DataFrame:
    """Substrings by which every head is looked up (key, nid, pos, top, len, size, crowd, marks), with its blocks marked (block)."""
    names = ["nid", "len", "size", "crowd", *MARKS]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, need, w, found, used in hashed_parts(batches, percent, head_chars):
            order = counts.value[(found >> np.uint64(64 - COUNTERS)).astype(np.int64)].astype(np.int64) << 32
            order |= (found & np.uint64(0xFFFFFFFF)).astype(np.int64)
            order[~used] = NEVER
            top, mark = chosen(order, used, need, w)
            text, place = np.nonzero((order <= top).T)
            columns = [rows.column(name).take(pa.array(text)) for name in names]
            columns += [pa.array(x) for x in (found[place, text].view(np.int64), place.astype(np.int32), top[text], mark[place, text])]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "key", "pos", "top", "block"])

    marked = ", ".join(f"{m} long" for m in MARKS)
    return heads.select(*names, "head").mapInArrow(
        cut, f"nid long, len int, size int, crowd long, {marked}, key long, pos int, top long, block boolean"
    )


def rarest(cut: DataFrame, number: Column) -> DataFrame:
    """Of every text the given number of its least used blocks, with how often each occurs."""
    counts = cut.groupBy("key").agg(F.count(F.lit(1)).alias("uses"))
    order = Window.partitionBy("nid").orderBy("uses", "pos")
    return (
        cut.join(counts.hint("merge"), "key")
        .withColumn("_n", F.row_number().over(order))
        .filter(F.col("_n") <= number)
        .drop("_n")
    )


def placed(rows: DataFrame, percent: int, head_chars: int, sizes: bool = False) -> DataFrame:
    """Lookups with the part of the head they lie in; with `sizes` placed by size as well."""
    return rows.withColumn("zone", cell(F.col("pos"), span(F.col("size"), percent) if sizes else F.lit(0), head_chars))


def zoned(index: DataFrame, percent: int, head_chars: int, sizes: bool = False) -> DataFrame:
    """Index entries, once for every zone into which the edits can move their block, and every step of a close size."""
    n, size = F.col("len"), F.col("size")
    low, high = shortest(n, percent), longest(n, percent, head_chars)
    left, right = (edits(n, low, percent) + n - low) / 2, (edits(n, high, percent) + high - n) / 2
    at = lambda pos, step: cell(pos, step, head_chars)
    first, last = F.greatest(F.col("pos") - F.floor(left), F.lit(0)), F.col("pos") + F.floor(right)
    if not sizes:
        return index.withColumn("zone", F.explode(F.sequence(at(first, F.lit(0)), at(last, F.lit(0)))))
    steps = F.sequence(span(shortest(size, percent), percent), span(longest(size, percent, 1 << 30), percent))
    zones = F.flatten(F.transform(steps, lambda step: F.sequence(at(first, step), at(last, step))))
    return index.withColumn("zone", F.explode(zones))


def most_edits(la: int, lb: int, percent: int) -> int:
    return ((la + lb) * (100 - percent) - 1) // 100


def needed_of(length: int, percent: int) -> int:
    """As `needed`, for whole texts."""
    return most_edits(length, max((length * (200 - percent) - 1) // percent, length), percent) + 1


@lru_cache(maxsize=100_000)
def width_of(length: int, percent: int, opening: int) -> int:
    """Widest blocks of a whole text that leave out as many as an opening holds, if any do."""
    number = needed_of(length, percent)
    for w in range(WHOLE_WIDTH, 2, -1):
        if length // w - number >= opening // w + 2:
            return w
    return max(1, min(WHOLE_WIDTH, length // number))


def widths_of(length: int, percent: int, opening: int) -> set[int]:
    """Block widths of all texts that can be close to one of this length."""
    if length > 20 * opening and length > 4000:
        return {WHOLE_WIDTH}  # all of them are long enough for the widest blocks
    low = max(min(length * percent // (200 - percent) + 1, length), 1)
    high = max((length * (200 - percent) - 1) // percent, length)
    return {w for n in range(low, high + 1) if (w := width_of(n, percent, opening)) <= length}


def whole_grams(bodies: DataFrame, percent: int, opening: int, index: bool) -> DataFrame:
    """Blocks of whole texts (nid, crowd, body) for the index, or all substrings that can meet one.

    Texts only meet within their crowd.
    """
    names = ("nid", "crowd", "len", "need", "w", "pos", "block")
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for nid, crowd, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                text = body.as_py()
                n = len(text)
                for w in [width_of(n, percent, opening)] if index else sorted(widths_of(n, percent, opening)):
                    starts = range(0, n // w * w, w) if index else range(n - w + 1)
                    fixed = (nid, crowd, n, needed_of(n, percent), w)
                    columns = [pa.repeat(pa.scalar(v, k), len(starts)) for v, k in zip(fixed, kinds)]
                    columns += [pa.array(starts, kinds[5]), pa.array([text[p : p + w] for p in starts], kinds[6])]
                    yield pa.RecordBatch.from_arrays(columns, names=list(names))

    schema = "nid long, crowd long, len int, need int, w int, pos int, block string"
    key = F.xxhash64("block", "w", "crowd")
    rows = bodies.select("nid", "crowd", "body").mapInArrow(cut, schema).withColumn("key", key)
    rows = rows.withColumn("size", F.col("len")).drop("block", "w", "crowd")
    return rarest(rows, F.col("need")).drop("need") if index else rows.drop("need")


def _meet(probe: DataFrame, index: DataFrame, percent: int, later: str = "probe", since: int = 0, tasks: int = 0) -> DataFrame:
    """Pairs (later, earlier) that share a block at positions the edits allow.

    `later` says which side has the later text of a pair: probe, index or either; one of at least `since` counts.
    Spark sizes an exploded table like the table before the explode and would broadcast it,
    so a shuffled join is asked for; adaptive execution also splits skewed blocks, unless a number
    of `tasks` is given. Members of one crowd do not meet here.
    Heads meet in their zones and only if their tops and marks allow it.
    """
    keys = ["key", "zone"] if "zone" in index.columns else ["key"]
    if tasks:
        probe, index = probe.repartition(tasks, *keys), index.repartition(tasks, *keys)
    p, i = probe.alias("p"), index.alias("i")
    ends = F.col("p.nid"), F.col("i.nid")
    ordered = {"probe": ends[1] < ends[0], "index": ends[0] < ends[1], "either": ends[0] != ends[1]}[later]
    if since:
        ordered &= F.greatest(*ends) >= since
    apart = F.lit(True)
    if "crowd" in index.columns:
        apart = F.coalesce(F.col("p.crowd") != F.col("i.crowd"), F.lit(True))
    shift = F.col("p.pos") - F.col("i.pos")
    growth = F.col("p.len") - F.col("i.len")
    allowed = edits(F.col("p.len"), F.col("i.len"), percent)
    sizes = F.col("p.size"), F.col("i.size")
    likely = F.lit(True)
    if "zone" in index.columns:
        ordered = (F.col("i.top") <= F.col("p.top")) & ordered
        turned = [F.bit_count(F.col(f"p.{m}").bitwiseXOR(F.col(f"i.{m}"))) for m in MARKS]
        likely = reduce(Column.__add__, turned) <= allowed
    return (
        p.join(
            i.hint("shuffle_hash"),
            reduce(Column.__and__, [F.col(f"p.{k}") == F.col(f"i.{k}") for k in keys])
            & ordered
            & (F.abs(shift) + F.abs(growth - shift) <= allowed)
            & likely
            & apart
            & (F.abs(sizes[0] - sizes[1]) <= edits(*sizes, percent)),
        )
        .select(F.greatest(*ends).alias("later"), F.least(*ends).alias("earlier"))
        .distinct()
    )


def _verify(pairs: DataFrame, heads: DataFrame, percent: int, head_chars: int) -> DataFrame:
    """Keep the pairs above the threshold.

    The bounded edit distance of the JVM never exceeds the number of deletions and
    insertions, so it rejects most candidates before any reaches Python. Equal heads need neither.
    """
    tasks = int(heads.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    later = heads.select(F.col("nid").alias("later"), F.col("head").alias("b"), F.col("size").alias("size_b"))
    earlier = heads.select(F.col("nid").alias("earlier"), F.col("head").alias("a"), F.col("size").alias("size_a"))
    most = ((100 - percent) * 2 * head_chars - 1) // 100
    total = F.length("a") + F.length("b")
    # Beyond its bound the distance is -1; as a huge number it fails the same test.
    distance = F.pmod(F.levenshtein("a", "b", most), F.lit(1 << 30))
    return (
        # Pairs are few bytes but much work: an explicit number of tasks keeps
        # them from being merged into one.
        pairs.repartition(tasks, "later")
        .join(later, "later")
        .join(earlier, "earlier")
        .filter(distance <= edits(F.length("a"), F.length("b"), percent))
        .filter(common_length(F.col("a"), F.col("b")) * 200 > total * percent)
        .select("later", "earlier", (F.greatest("size_a", "size_b") > head_chars).alias("longer"))
    )


def _confirm(pairs: DataFrame, bodies: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """Of pairs of close heads, those whose whole texts are close too."""
    stage = Stage(pairs.sparkSession, "whole-texts")
    pairs = stage.write(pairs)
    open_pairs = pairs.filter("longer").drop("longer")
    texts = bodies(open_pairs.select(F.explode(F.array("later", "earlier")).alias("nid")).distinct())
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    @F.pandas_udf(T.BooleanType())
    def close(xs: pd.Series, ys: pd.Series) -> pd.Series:
        return pd.Series([alike(x, y, percent) for x, y in zip(xs, ys)], dtype="bool")

    later = texts.select(F.col("nid").alias("later"), F.col("body").alias("b"))
    earlier = texts.select(F.col("nid").alias("earlier"), F.col("body").alias("a"))
    confirmed = (
        open_pairs.repartition(tasks, "later", "earlier")
        .join(later, "later")
        .join(earlier, "earlier")
        .filter(close(F.col("a"), F.col("b")))
        .select("later", "earlier")
    )
    return pairs.filter(~F.col("longer")).drop("longer").unionByName(confirmed)


def portions(heads: DataFrame, first: int) -> list[tuple[int, int, int]]:
    """Ranges of numbers from one up to another, with the rows up to there, each several times as large as all before it, the last one at least as large.

    They end where a task's numbers do, so as many counts as there are tasks reach the driver.
    """
    counts = heads.groupBy(F.shiftright("nid", 33).alias("task")).count().orderBy("task").collect()
    cuts, rows, seen, goal, total = [0], [], 0, first, sum(row["count"] for row in counts)
    for row in counts:
        if goal <= seen <= total - seen:
            cuts.append(row["task"] << 33)
            rows.append(seen)
            goal = seen * GROWTH
        seen += row["count"]
    return list(zip(cuts, [*cuts[1:], (1 << 63) - 1], [*rows, total]))


def close_copies(
    heads: DataFrame,
    percent: int = 95,
    head_chars: int = 200,
    hot: int = HOT,
    bodies: Callable[[DataFrame], DataFrame] | None = None,
    first_rows: int = FIRST_ROWS,
) -> DataFrame:
    """Numbers of the texts that have an earlier kept near-duplicate.

    `heads` has one row per text: nid (its place in the input), head, its `marks`, len, size, the length of
    what is compared in the end, and crowd, a number of the head where many share it. With
    `bodies`, which returns (nid, body) for a table of numbers, the whole text is compared,
    and pairs of close heads count if their bodies are close; else heads must be distinct.
    """
    stage = Stage(heads.sparkSession, "near-duplicates")
    sizes = bodies is not None
    filled = heads.filter("len > 0")
    counts = heads.sparkSession.sparkContext.broadcast(learned(filled, percent, head_chars))
    index = stage.write(entries(filled, percent, head_chars, counts).withColumn("span", span(F.col("size"), percent)))
    counts.destroy()
    fewest = int(heads.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members = heads.filter("crowd IS NOT NULL").select("nid", "crowd", "size")
    texts = held = None
    if sizes and not members.isEmpty():
        texts = stage.write(bodies(members.select("nid")).join(members.drop("size"), "nid"))
        held = stage.write(whole_grams(texts, percent, head_chars, index=True))

    def verified(pairs: DataFrame) -> DataFrame:
        close = _verify(pairs, heads, percent, head_chars)
        return stage.write(_confirm(close, bodies, percent) if sizes else close.drop("longer"))

    def met(probe: DataFrame, index: DataFrame, later: str = "either", since: int = 0, tasks: int = 0) -> DataFrame:
        probe, index = placed(probe, percent, head_chars, sizes), zoned(index, percent, head_chars, sizes)
        return _meet(probe, index, percent, later, since, tasks)

    def from_first(later: DataFrame, earlier: DataFrame) -> DataFrame:
        """Members of crowds with the earliest one of others, where sizes allow it."""
        first = earlier.groupBy("crowd").agg(F.min("nid").alias("earlier"), F.min_by("size", "nid").alias("_size"))
        allowed = edits(F.col("size"), F.col("_size"), percent)
        close = (F.col("nid") > F.col("earlier")) & (F.abs(F.col("size") - F.col("_size")) <= allowed)
        return later.join(first, "crowd").filter(close).select(F.col("nid").alias("later"), "earlier")

    def by_whole_texts(nids: DataFrame, how: str, index: DataFrame) -> DataFrame:
        return _meet(whole_grams(texts.join(nids, "nid", how), percent, head_chars, index=False), index, percent)

    nowhere = heads.select("nid").limit(0)
    dropped = nowhere
    for low, high, rows in portions(heads, first_rows):
        inside = (F.col("nid") >= low) & (F.col("nid") < high)
        mine, crowded = index.filter(inside), members.filter(inside)
        many = mine.filter("block").groupBy("key", "span").count().filter(F.col("count") > max(hot, rows // HOT_SHARE))
        busy = stage.write(many.select("key", "span"))
        any_busy = not busy.isEmpty()
        probe, target = mine, mine.filter("block")
        if any_busy:
            keys = stage.write(busy.select("key").distinct())
            target = target.join(sized(busy), ["key", "span"], "left_anti")
        if low:
            gone = stage.write(dropped)
            before = F.col("nid") < low
            old = index.filter(before).join(sized(gone), "nid", "left_anti")
            probe, target = probe.unionByName(old), target.unionByName(old.filter("block"))
        # More tasks than usual where one could not hold its blocks, of which most lie in two or three zones.
        tasks = rows * 50 // HELD
        candidates = met(probe, target, since=low, tasks=tasks if tasks > fewest else 0)
        if low and any_busy:  # blocks of many meet kept texts like all others
            hot_index = mine.filter("block").join(sized(busy), ["key", "span"], "left_semi")
            candidates = candidates.unionByName(met(old.join(sized(keys), "key", "left_semi"), hot_index, "index"))
        if low:
            candidates = stage.write(candidates)
            if sizes:  # read at once what both comparisons need
                bodies(candidates.select(F.explode(F.array("later", "earlier")).alias("nid")).distinct())
            against = candidates.filter(F.col("earlier") < low)
            if held is not None:
                kept = stage.write(members.filter(before).join(gone, "nid", "left_anti"))
                against = against.unionByName(from_first(crowded, kept)).distinct()
            falls = stage.write(verified(against).select(F.col("later").alias("nid")).distinct())
            if held is not None:
                rest = crowded.select("nid").join(falls, "nid", "left_anti")
                near = verified(by_whole_texts(rest, "left_semi", held.join(kept.select("nid"), "nid", "left_semi")))
                falls = stage.write(falls.union(near.select(F.col("later").alias("nid"))).distinct())
            dropped = dropped.union(falls)
            mine, crowded = (t.join(sized(falls), "nid", "left_anti") for t in (mine, crowded))
            candidates = _without(candidates.filter(F.col("earlier") >= low), falls)
        edges = verified(candidates)

        # Near pairs with the earliest of many, and ways to all pairs of those that need them.
        near_first, searches = [], []
        if any_busy:
            hot_rows = stage.write(mine.join(sized(keys), "key", "left_semi"))
            hot_held = hot_rows.join(sized(busy), ["key", "span"], "left_semi")
            hot_index = stage.write(hot_held.filter("block"))
            first = F.min_by(F.struct("nid", "len", "size", "crowd", "pos", *MARKS), "nid").alias("first")
            holders = hot_held.groupBy("key", "span").agg(first).select("key", "first.*", F.lit(0).cast("long").alias("top"))
            near_first.append(verified(met(hot_rows, holders, "probe")))

            def hot_pairs(nids: DataFrame, how: str, rows=hot_rows, index=hot_index) -> DataFrame:
                """The later text of a pair looks a block up or has it."""
                looking, having = rows.join(nids, "nid", how), index.join(nids, "nid", how)
                return met(looking, index, "probe").unionByName(met(rows, having, "index"))

            searches.append(hot_pairs)
        if held is not None:
            near_first.append(verified(from_first(crowded, crowded)))
            own = stage.write(crowded.select("nid"))
            searches.append(
                lambda nids, how, own=own: by_whole_texts(
                    own.join(nids, "nid", how), "left_semi", held.join(own, "nid", "left_semi")
                )
            )
        dropped = dropped.union(_settled(stage, edges, near_first, searches, verified))
    return dropped


def _settled(
    stage: Stage,
    edges: DataFrame,
    near_first: list[DataFrame],
    searches: list[Callable[[DataFrame, str], DataFrame]],
    verified: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Numbers of the texts that an earlier kept one drops.

    `edges` are near pairs, `near_first` those with the earliest of many; `searches` find the pairs of given texts
    among many, or of all but these.
    """
    waiting = None
    if near_first:
        firsts = reduce(DataFrame.unionByName, near_first)
        waiting = stage.write(firsts.select(F.col("later").alias("nid")).distinct())

        def all_pairs(nids: DataFrame, how: str) -> DataFrame:
            """Near pairs of the given texts among many, or of all but these."""
            return verified(reduce(DataFrame.unionByName, [search(nids, how) for search in searches]).distinct())

        edges = stage.write(edges.unionByName(firsts).unionByName(all_pairs(waiting, "left_anti")).distinct())

    alive, parts = edges, []
    nowhere = edges.select(F.col("later").alias("nid")).limit(0)
    while True:
        blocked = alive.select(F.col("later").alias("nid")).distinct()
        undecided = blocked if waiting is None else blocked.union(waiting)
        kept = alive.join(undecided.withColumnRenamed("nid", "earlier"), "earlier", "left_anti").select("earlier")
        falls = stage.write(
            alive.join(kept, "earlier", "left_semi").select(F.col("later").alias("nid")).distinct()
        )
        if not falls.isEmpty():
            parts.append(falls)
            alive = stage.write(_without(alive, falls))
            continue
        dropped = nowhere
        for part in parts:
            dropped = dropped.union(part)
        if waiting is None:
            return dropped
        # Texts that waited for a holder that was dropped look at their whole blocks.
        free = stage.write(waiting.join(dropped, "nid", "left_anti").join(blocked, "nid", "left_anti"))
        if free.isEmpty():
            return dropped
        alive = stage.write(_without(alive.unionByName(all_pairs(free, "left_semi")).distinct(), dropped))
        waiting = stage.write(waiting.join(free, "nid", "left_anti"))


def _without(edges: DataFrame, nids: DataFrame) -> DataFrame:
    for end in ("later", "earlier"):
        edges = edges.join(nids.withColumnRenamed("nid", end), end, "left_anti")
    return edges


def fates(
    df: DataFrame,
    order=("date", "review_id"),
    percent: int = 95,
    head_chars: int = 200,
    hot: int = HOT,
    crowd: int = 50,
    id_col: str = "review_id",
    text: str = "review_text",
    whole: bool = False,
    first_rows: int = FIRST_ROWS,
) -> DataFrame:
    """The first row of every text (id) and whether it has an earlier kept near-duplicate (near).

    Rows that are not listed are exact copies: lower-cased and stripped, their text is that of
    an earlier row. Options are those of `dedup_fuzzy`. Only ids, order columns, a hash and
    the heads are moved. Jobs run when this is called.
    """
    stage = Stage(df.sparkSession, "heads")
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    body = strip_ends(F.lower(F.col(text)))
    # Undated rows come last, as in a window.
    place = [F.col(c).asc_nulls_last() for c in order]
    same = Window.partitionBy("_hash").orderBy(*place)
    firsts = (
        df.withColumn("_body", body)
        .select(
            id_col, *[c for c in order if c != id_col],
            F.md5("_body").alias("_hash"),
            F.substring("_body", 1, head_chars).alias("_head"),
            F.length("_body").alias("_size"),
        )
        .withColumn("_n", F.row_number().over(same))
        .filter(F.col("_n") == 1)
    )
    # Sorted parts number the rows in the input's order: one long stands for id and place.
    heads = stage.write(
        firsts.repartitionByRange(tasks, *place)
        .sortWithinPartitions(*place)
        .select(
            F.col(id_col).cast("string").alias("id"),
            F.monotonically_increasing_id().alias("nid"),
            F.col("_head").alias("head"),
            F.length("_head").alias("len"),
            F.col("_size").alias("size"),
        )
    )

    read = []  # staged parts of the whole texts that were asked for so far

    def bodies(nids: DataFrame) -> DataFrame:
        wanted = stage.write(nids)
        missing = heads.join(wanted, "nid", "left_semi").select("nid", F.col("id").alias("_id"))
        for part in read:
            missing = missing.join(part.select("nid"), "nid", "left_anti")
        ids = stage.write(missing)
        if not read or not ids.isEmpty():
            texts = df.select(F.col(id_col).cast("string").alias("_id"), F.col(text).alias("_text"))
            # Only what was asked for is lower-cased and stripped, and kept.
            met = texts.join(sized(ids), "_id").select("nid", strip_ends(F.lower(F.col("_text"))).alias("body"))
            read.append(stage.write(met))
        return reduce(DataFrame.unionByName, read).join(sized(wanted), "nid", "left_semi")

    nobody = F.lit(None).cast("long").alias("crowd")
    if whole:
        # Heads that more texts share than a crowd needs are few, or else short of the table by that factor.
        many = heads.filter(F.col("size") > head_chars).groupBy("head").count().filter(F.col("count") > crowd)
        many = many.select("head", F.xxhash64("head").alias("crowd"))
        marked = heads.drop("id").join(many.hint("shuffle_hash"), "head", "left").withColumn("_marks", marks(F.col("head")))
        rows = stage.write(marked.select("nid", "head", "len", "size", "crowd", "_marks.*"))
        near = close_copies(rows, percent, head_chars, hot, bodies, first_rows)
        return stage.write(heads.select("id", "nid").join(near.withColumn("_near", F.lit(True)), "nid", "left")
                           .select("id", F.coalesce("_near", F.lit(False)).alias("near")))
    # Texts of one head are copies of its first one.
    groups = stage.write(
        heads.withColumn("_n", F.row_number().over(Window.partitionBy("head").orderBy("nid")))
        .filter(F.col("_n") == 1)
        .withColumn("_marks", marks(F.col("head")))
        .select("nid", "head", "len", F.col("len").alias("size"), nobody, "_marks.*")
    )
    near = close_copies(groups, percent, head_chars, hot, first_rows=first_rows)
    kept = groups.select("nid").join(near, "nid", "left_anti").withColumn("_kept", F.lit(True))
    return stage.write(heads.select("id", "nid").join(kept, "nid", "left").select("id", F.col("_kept").isNull().alias("near")))


def dedup_fuzzy(df: DataFrame, order=("date", "review_id"), id_col: str = "review_id", **options) -> DataFrame:
    """Drop every review with an earlier kept near-duplicate in the whole table.

    The order columns and the id must identify a row. Only the first `head_chars`
    characters are compared; that is how near-duplicates are defined by default, so long
    texts that share such an opening count as copies. With `whole` the whole texts must be
    as close as well. `percent` is what the ratio must exceed. The result does not depend on `hot`
    and `crowd`, which only say from how many holders on a block or head is first compared with
    its earliest one, nor on `first_rows`, the rows of the first portion.
    Jobs run when this function is called.
    """
    kept = fates(df, order, id_col=id_col, **options).filter(~F.col("near")).select(F.col("id").alias("_kept"))
    return df.join(sized(kept), F.col(id_col).cast("string") == F.col("_kept"), "left_semi")


def near_copy_ids(df: DataFrame, order=("date", "review_id"), **options) -> DataFrame:
    """Ids of the reviews `dedup_fuzzy` drops."""
    kept = dedup_fuzzy(df, order, **options).select("review_id")
    return df.select("review_id").join(kept, "review_id", "left_anti")
