"""N-gram Jaccard join with signature trees.

Equal shingle sets form a class. Two sets can only be similar if they share a shingle of
their prefixes: the first fifth of each set in one order of all shingles, in which the most
frequent ones come last. The prefixes are taken a twentieth longer, so similar sets share
that many shingles of them, and sets that share fewer with others are left out. The classes
that share a prefix shingle are a block; of blocks with the same members one is kept.

In rounds, every class is compared with one centre of its blocks; verified links grow
components, and a block that lies within one component is finished. The blocks that are
left are searched by signature trees. A node holds the OR of its members' token bitmaps,
their range of sizes and their components. Two trees are traversed together; a pair of
nodes is left out if sizes, components or the largest possible overlap allow no new link.
Whatever remains is verified on the whole sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.staging import Stage
from feedloom.llm.common import ROWS_AT_ONCE, map_rows
from feedloom.llm.graph import components
from feedloom.llm.line_dedup import text_key

SHINGLE = 5
# Similar: 100 * intersection >= 80 * union. The prefixes and size bounds below follow from it.
PART, WHOLE = 80, 100
# Shingles that stand last in the order: the FREQUENT most frequent ones that occur in at
# least COMMON of the texts that a task handles at once. Results do not depend on them.
FREQUENT, COMMON = 50_000, 4
# By this share of a set its prefix is longer, and so many shingles of it must be shared.
LONGER = 0.05
# Rounds of comparing with centres before the trees.
ROUNDS = 2
# Members of a leaf table row, leaves of an upper node, members below a node that is not split.
LEAF, FANOUT, SMALLEST = 256, 16, 8
# Members of more blocks than this do not carry the list of them, which would grow with the
# square of a text's length; pairs of theirs may be found more than once.
LISTED = 64

ROTATE = (np.uint64(23), np.uint64(41))
MULTIPLY = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def shingles(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; a shorter text is one shingle as a whole."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    own = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    size = min(SHINGLE, len(words))
    mixed = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        mixed = (mixed ^ own[k : len(words) - size + 1 + k]) * MULTIPLY[0]
        mixed = (mixed << ROTATE[0]) | (mixed >> ROTATE[1])
    mixed = (mixed ^ (mixed >> np.uint64(29))) * MULTIPLY[1]
    return np.unique(mixed ^ (mixed >> np.uint64(32)))


def least_overlap(n: int) -> int:
    """The smallest overlap that a set of n needs with any similar set."""
    return -(-PART * n // WHOLE)


def least_shared(n: int) -> int:
    """Shingles by which the prefix of a set of n is longer.

    The prefixes of two similar sets share as many as this is for the smaller of them, and
    the smallest set that is similar to one of n has least_overlap(n) shingles.
    """
    return max(1, math.ceil(LONGER * n))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return len(a) > 0 and WHOLE * shared >= PART * (len(a) + len(b) - shared)


def bitmap(tokens: np.ndarray) -> bytes:
    """Bits of the tokens modulo the size of the map, which holds two to four bits per token."""
    bits = np.zeros(1 << max(6, (2 * len(tokens) - 1).bit_length()), np.uint8)
    bits[(tokens & np.uint64(len(bits) - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """The map of the same tokens with fewer bits: its parts laid over each other."""
    return bits if len(bits) == size else np.bitwise_or.reduce(bits.reshape(-1, size), axis=0)


class Node:
    """Members [start, end) of a block by size: OR of the bitmaps, sizes, components, children."""

    def __init__(self, maps, sizes, groups, start: int, end: int):
        self.start, self.end = start, end
        self.low, self.high = int(sizes[start]), int(sizes[end - 1])
        own = groups[start:end]
        self.group = int(own[0]) if (own == own[0]).all() else None
        self.children = []
        if end - start > SMALLEST:
            middle = (start + end) // 2
            self.children = [Node(maps, sizes, groups, start, middle), Node(maps, sizes, groups, middle, end)]
            width = min(len(c.union) for c in self.children)
            self.union = np.bitwise_or(*(folded(c.union, width) for c in self.children))
            self.fewest = min(c.fewest if len(c.union) == width else 0 for c in self.children)
        else:
            width = min(len(maps[i]) for i in range(start, end))
            laid = np.array([folded(maps[i], width) for i in range(start, end)])
            self.union = np.bitwise_or.reduce(laid, axis=0)
            self.fewest = int(np.bitwise_count(laid).sum(axis=1).min())


def possible(a: Node, b: Node) -> bool:
    """Whether a member of a and one of b can be similar and lie in different components."""
    if WHOLE * min(a.high, b.high) < PART * max(a.low, b.low):
        return False
    if a.group is not None and a.group == b.group:
        return False
    width = min(len(a.union), len(b.union))
    shared = int(np.bitwise_count(folded(a.union, width) & folded(b.union, width)).sum())
    for node in (a, b):
        # Every bit of a member that is not shared stands for a token that is not either.
        if len(node.union) == width and node.high - max(0, node.fewest - shared) < least_overlap(node.low):
            return False
    return True


def traverse(token: int, first: list[dict], second: list[dict] | None) -> list[tuple[int, int]]:
    """Pairs of members that may be similar: within one leaf (second is None) or between two.

    A pair that shares several blocks is looked at in the first of them only, if both
    members list their blocks; else it may be found in each.
    """
    sides = []
    for members in (first, second) if second is not None else (first,):
        members = sorted(members, key=lambda m: (m["n"], m["component"], m["row"]))
        maps = [np.frombuffer(m["bits"], np.uint8) for m in members]
        sizes = np.array([m["n"] for m in members])
        groups = np.array([m["component"] for m in members])
        held = [frozenset(m["tokens"]) if m["tokens"] else None for m in members]
        sides.append((members, maps, sizes, groups, Node(maps, sizes, groups, 0, len(members)), held))
    a, b = sides[0], sides[-1]
    found, open_pairs = [], [(a[4], b[4])]
    while open_pairs:
        x, y = open_pairs.pop()
        within = second is None and x.start == y.start and x.end == y.end
        if not (within and x.group is None) and not possible(x, y):
            continue
        if within and x.group is not None:
            continue
        if not x.children and not y.children:
            for i in range(x.start, x.end):
                for j in range(max(y.start, i + 1) if second is None else y.start, y.end):
                    if a[3][i] == b[3][j]:
                        continue
                    if a[5][i] and b[5][j] and min(a[5][i] & b[5][j]) != token:
                        continue
                    if overlap_possible(a[1][i], b[1][j], int(a[2][i]), int(b[2][j])):
                        found.append((a[0][i]["row"], b[0][j]["row"]))
        elif within:
            left, right = x.children
            open_pairs += [(left, left), (left, right), (right, right)]
        elif x.children and (not y.children or x.end - x.start >= y.end - y.start):
            open_pairs += [(c, y) for c in x.children]
        else:
            open_pairs += [(x, c) for c in y.children]
    return found


def overlap_possible(a: np.ndarray, b: np.ndarray, n: int, m: int) -> bool:
    """Whether the bitmaps of two sets of n and m tokens allow the overlap that they need."""
    if WHOLE * min(n, m) < PART * max(n, m):
        return False
    need = -(-PART * (n + m) // (WHOLE + PART))
    width = min(len(a), len(b))
    p, q = folded(a, width), folded(b, width)
    if n - int(np.bitwise_count(p & ~q).sum()) < need:
        return False
    return m - int(np.bitwise_count(q & ~p).sum()) >= need


def frequent(docs: DataFrame) -> np.ndarray:
    """The most frequent shingles, from counts within the texts that are handled at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                sets = [shingles(t) for t in batch.column(0).slice(at, ROWS_AT_ONCE).to_pylist()]
                tokens, n = np.unique(np.concatenate(sets), return_counts=True)
                common = n >= COMMON
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens[common].view(np.int64)), pa.array(n[common])], names=["token", "n"]
                )

    top = (
        docs.select("text")
        .mapInArrow(run, "token long, n long")
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "token")
        .limit(FREQUENT)  # bounds what reaches the driver
        .toArrow()
    )
    return top["token"].to_numpy().view(np.uint64)[::-1].copy()


def prefix(tokens: np.ndarray, last: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first tokens in the order with the frequent ones last.

    If a set of n shares k tokens with another, its first n - k + s hold the first s of them.
    """
    size = len(tokens) - least_overlap(len(tokens)) + least_shared(len(tokens))
    if len(last):
        at = np.minimum(np.searchsorted(last, tokens), len(last) - 1)
        order = np.where(last[at] == tokens, rank[at] + 1, 0)
        tokens = tokens[np.argsort(order, kind="stable")]
    return tokens[:size]


def describe(docs: DataFrame) -> DataFrame:
    """One pass over the texts: size, digest, prefix and bitmap of every set."""
    ordered = frequent(docs)
    rank = np.argsort(ordered)  # position in the order, by token
    last = ordered[rank]
    kinds = T._parse_datatype_string(
        "row long, doc_id long, text_key long, n long, least long, high long, low long, prefix array<long>, bits binary"
    )
    kinds["doc_id"].dataType = docs.schema["doc_id"].dataType

    def run(rows: list[dict]) -> list[dict]:
        out = []
        for r in rows:
            tokens = shingles(r["text"])
            digest = hashlib.md5(tokens.tobytes()).digest()
            out.append(
                {
                    "row": r["row"], "doc_id": r["doc_id"], "text_key": r["text_key"],
                    "n": len(tokens), "least": least_shared(least_overlap(len(tokens))),
                    "high": int.from_bytes(digest[:8], "big", signed=True),
                    "low": int.from_bytes(digest[8:], "big", signed=True),
                    "prefix": prefix(tokens, last, rank).view(np.int64).tolist() if len(tokens) else [],
                    "bits": bitmap(tokens) if len(tokens) else b"",
                }
            )
        return out

    # Written down before it is used, so a row keeps its number.
    numbered = docs.withColumn("text_key", text_key(F.col("text"))).withColumn("row", F.monotonically_increasing_id())
    return map_rows(numbered.select("row", "doc_id", "text_key", "text"), run, kinds.simpleString())


def whole_sets(docs: DataFrame, described: DataFrame, rows: DataFrame) -> DataFrame:
    """The sets of some rows, made again from their texts."""
    wanted = described.join(rows, "row", "left_semi").select("row", "doc_id", "text_key")
    keyed = docs.withColumn("text_key", text_key(F.col("text")))
    met = keyed.join(wanted.dropDuplicates(["doc_id", "text_key"]).hint("shuffle_hash"), ["doc_id", "text_key"])
    return map_rows(
        met.select("row", "text"),
        lambda part: [{"row": r["row"], "tokens": shingles(r["text"]).tobytes()} for r in part],
        "row long, tokens binary",
    ).dropDuplicates(["row"])


def plausible(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs (u, v) whose sizes and bitmaps allow them to be similar."""
    side = lambda name: members.select(F.col("row").alias(name), F.struct("n", "bits").alias(f"{name}_set"))

    def keep(rows: list[dict]) -> list[dict]:
        out = []
        for r in rows:
            a, b = r["u_set"], r["v_set"]
            if overlap_possible(np.frombuffer(a["bits"], np.uint8), np.frombuffer(b["bits"], np.uint8), a["n"], b["n"]):
                out.append({"u": r["u"], "v": r["v"]})
        return out

    sized = pairs.join(side("u"), "u").join(side("v"), "v").filter(
        WHOLE * F.least("u_set.n", "v_set.n") >= PART * F.greatest("u_set.n", "v_set.n")
    )
    return map_rows(sized, keep, "u long, v long")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (u, v) whose whole sets are similar."""

    def keep(rows: list[dict]) -> list[dict]:
        return [
            {"u": r["u"], "v": r["v"]}
            for r in rows
            if similar(np.frombuffer(r["a"], np.uint64), np.frombuffer(r["b"], np.uint64))
        ]

    a = sets.select(F.col("row").alias("u"), F.col("tokens").alias("a"))
    b = sets.select(F.col("row").alias("v"), F.col("tokens").alias("b"))
    return map_rows(pairs.join(a, "u").join(b, "v"), keep, "u long, v long")


def labelled(blocks: DataFrame, found: DataFrame | None) -> DataFrame:
    """Add the component of every member: itself where it has no link yet."""
    if found is None:
        return blocks.withColumn("component", F.col("row"))
    known = found.select(F.col("node").alias("row"), "component")
    return blocks.join(known, "row", "left").withColumn("component", F.coalesce("component", "row"))


def sharing(blocks: DataFrame, members: DataFrame) -> DataFrame:
    """Members that share as many tokens as a similar set must, with the number they share (`held`).

    A block counts for `weight` tokens.
    """
    held = blocks.groupBy("row").agg(F.sum("weight").alias("held")).join(members.select("row", "least"), "row")
    return blocks.drop("held").join(held.filter("held >= least").select("row", "held"), "row")


def merged(blocks: DataFrame) -> DataFrame:
    """One of the blocks that have the same members, with the sum of their weights.

    Equal members are told by their number and two 64-bit digests of them.
    """
    digest = lambda seed: F.bit_xor(F.xxhash64("row", F.lit(seed)))
    sets = blocks.groupBy("token").agg(
        F.count("*").alias("size"), digest(1).alias("one"), digest(2).alias("two"), F.max("weight").alias("weight")
    )
    kept = (
        sets.filter("size > 1")
        .groupBy("size", "one", "two")
        .agg(F.min("token").alias("token"), F.sum("weight").alias("weight"))
    )
    return blocks.drop("weight").join(kept.select("token", "weight"), "token")


def labels_of(links: DataFrame) -> DataFrame:
    """A node of its own component for every linked node: the smallest within two links."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("v"))
    further = least.select(F.col("u").alias("v"), F.col("v").alias("w"))
    return least.join(further, "v", "left").select(
        F.col("u").alias("node"), F.coalesce("w", "v").alias("component")
    )


def unfinished(blocks: DataFrame) -> DataFrame:
    """Members of the blocks that hold more than one component."""
    several = blocks.groupBy("token").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter("a <> b")
    return blocks.join(several.select("token"), "token", "left_semi")


def centres(blocks: DataFrame, turn: int) -> DataFrame:
    """One comparison per member: with the centre that most of its blocks have in common.

    The first centre of a block is the member that shares most tokens with others, as the
    text does that others were copied from; later ones are drawn by a hash.
    """
    first = -F.col("held") if turn == 0 else F.lit(0).cast("long")
    place = F.struct(first, F.xxhash64("row", F.lit(turn)))
    chosen = blocks.groupBy("token").agg(F.min_by(F.struct("row", "component"), place).alias("centre"))
    met = blocks.join(chosen, "token").filter(F.col("component") != F.col("centre.component"))
    shared = met.groupBy("row", F.col("centre.row").alias("centre")).count()
    first = W.partitionBy("row").orderBy(F.desc("count"), "centre")
    return (
        shared.withColumn("n", F.row_number().over(first))
        .filter("n = 1")
        .select(F.greatest("row", "centre").alias("u"), F.least("row", "centre").alias("v"))
        .distinct()
    )


def tree_pairs(stage: Stage, blocks: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs of different components that the signature trees of the blocks leave.

    Blocks of more than LEAF members are split: by bands of size, of which only neighbours
    can be similar, and into upper nodes of one large component or of mixed members, each
    with leaves of about LEAF members.
    """
    sized = blocks.join(members.select("row", "n"), "row")
    per_token = sized.groupBy("token").agg(F.count("*").alias("block"))
    # A ratio of sizes of 100 to 80 spans one band, so similar sets are at most one apart.
    band = F.floor(F.log("n") / float(np.log(WHOLE / PART)) + 1e-9)
    sized = sized.join(per_token, "token").withColumn("band", F.when(F.col("block") > LEAF, band).otherwise(F.lit(-1)))
    per_group = sized.filter("band >= 0").groupBy("token", "band", "component").agg(F.count("*").alias("alike"))
    sized = stage.write(sized.join(per_group, ["token", "band", "component"], "left"))
    large = F.coalesce(F.col("alike") > LEAF, F.lit(False))
    mixed = sized.filter("band >= 0").filter(~large).groupBy("token", "band").agg(F.count("*").alias("mixed"))
    place = F.xxhash64("row")
    upper = F.when(large, F.struct(F.lit(1).alias("pure"), F.col("component").alias("part"))).otherwise(
        F.struct(
            F.lit(0).alias("pure"),
            F.pmod(place, F.ceil(F.coalesce("mixed", F.lit(1)) / (LEAF * FANOUT))).alias("part"),
        )
    )
    inside = F.when(large, F.col("alike")).otherwise(F.least(F.coalesce("mixed", F.lit(1)), F.lit(LEAF * FANOUT)))
    leaf = F.pmod(F.xxhash64("row", F.lit(1)), F.ceil(inside / LEAF))
    placed = (
        sized.join(mixed, ["token", "band"], "left")
        .withColumn("upper", upper)
        .withColumn("leaf", leaf)
        .join(members.select("row", "bits"), "row")
        .join(blocks.groupBy("row").agg(F.collect_list("token").alias("tokens")), "row")
        .withColumn("tokens", F.when(F.size("tokens") <= LISTED, F.col("tokens")))
    )
    leaves = stage.write(
        placed.groupBy("token", "band", "upper", "leaf").agg(
            F.collect_list(F.struct("row", "n", "component", "bits", "tokens")).alias("members")
        )
    )
    within = leaves.filter(F.size("members") > 1).select("token", F.col("members").alias("a"), F.lit(None).cast(leaves.schema["members"].dataType).alias("b"))
    # Between leaves: first pairs of upper nodes, then of their leaves.
    names = leaves.filter("band >= 0").select("token", "band", "upper", "leaf")
    tops = names.select("token", "band", "upper").distinct()
    left = tops.select("token", F.col("band").alias("band_a"), F.col("upper").alias("upper_a"))
    right = tops.select("token", F.col("band").alias("band_b"), F.col("upper").alias("upper_b"))
    key = lambda s: F.struct(f"band_{s}", f"upper_{s}")
    same_component = (F.col("upper_a.pure") == 1) & (F.col("upper_b.pure") == 1) & (F.col("upper_a.part") == F.col("upper_b.part"))
    apart = F.col("band_b") - F.col("band_a")
    upper_pairs = left.join(right, "token").filter((key("a") <= key("b")) & (apart <= 1) & ~same_component)
    side = lambda s: leaves.select(
        "token", F.col("band").alias(f"band_{s}"), F.col("upper").alias(f"upper_{s}"),
        F.col("leaf").alias(f"leaf_{s}"), F.col("members").alias(s),
    )
    between = (
        upper_pairs.join(side("a").drop("a"), ["token", "band_a", "upper_a"])
        .join(side("b").drop("b"), ["token", "band_b", "upper_b"])
        .filter((key("a") < key("b")) | (F.col("leaf_a") < F.col("leaf_b")))
        .join(side("a"), ["token", "band_a", "upper_a", "leaf_a"])
        .join(side("b"), ["token", "band_b", "upper_b", "leaf_b"])
        .select("token", "a", "b")
    )

    def search(rows: list[dict]) -> list[dict]:
        found = {(max(p), min(p)) for r in rows for p in traverse(r["token"], r["a"], r["b"])}
        return [{"u": u, "v": v} for u, v in sorted(found)]

    return map_rows(within.unionByName(between), search, "u long, v long").distinct()


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of similar texts: doc_id, n_shingles, component_id (smallest id of the group).

    Words are runs of non-blank characters (ASCII blanks; A-Z in lower case), shingles are
    five words in a row, a text of fewer words is one shingle, and a text without words has
    none and no links. Two texts are linked when their sets' overlap is at least 80 percent of
    their union; a component is what links reach. Rows without an id take part in nothing
    and have no component; rows that share an id each belong to their own text's component.
    Two texts get one component exactly if a chain of links joins them. Other columns are
    not looked at.
    """
    spark = docs.sparkSession
    stage = Stage(spark, "jaccard")
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    described = stage.write(describe(docs))
    real = described.filter("n > 0 AND doc_id IS NOT NULL")
    classes = stage.write(
        real.groupBy("high", "low").agg(F.min("row").alias("class"), F.min("doc_id").alias("label"))
    )
    # Prefix shingles that more than one class has, and the classes' memberships in them.
    tokens = real.select(F.explode("prefix").alias("token"), "row", F.expr("high ^ low").alias("digest"))
    shared = tokens.groupBy("token").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).filter("a <> b")
    first = classes.select(F.col("class").alias("row"))
    memberships = stage.write(
        tokens.select("token", "row", F.lit(1).cast("long").alias("weight"))
        .join(shared.select("token"), "token", "left_semi")
        .join(first, "row", "left_semi")
    )
    blocks = stage.write(merged(sharing(memberships, described)))
    within = blocks.select("row").distinct()
    members = stage.write(described.select("row", "n", "least", "bits").join(within, "row", "left_semi"))
    links = spark.createDataFrame([], "u long, v long")
    sets, found, complete = None, None, True
    for turn in range(ROUNDS + 1):
        open_blocks = stage.write(sharing(unfinished(labelled(blocks, found)), members))
        if open_blocks.isEmpty():
            break
        if turn < ROUNDS:
            pairs = stage.write(plausible(centres(open_blocks, turn), members))
        else:
            pairs = stage.write(tree_pairs(stage, open_blocks, members))
        rows = pairs.select(F.col("u").alias("row")).union(pairs.select("v")).distinct()
        if sets is not None:
            rows = rows.join(sets, "row", "left_anti")
        more = stage.write(whole_sets(docs, described, rows))
        sets = more if sets is None else sets.union(more)
        links = stage.write(links.union(verified(pairs, sets)))
        # The next round of centres does with labels; the trees and the result need components.
        complete = turn + 1 >= ROUNDS
        found = components(stage, links) if complete else stage.write(labels_of(links))
    if not complete:
        found = components(stage, links)
    members_of = classes if found is None else classes.join(
        found.withColumnRenamed("node", "class"), "class", "left"
    )
    if found is None:
        members_of = members_of.withColumn("component", F.col("class"))
    members_of = members_of.withColumn("component", F.coalesce("component", "class"))
    labels = members_of.groupBy("component").agg(F.min("label").alias("component_id"))
    by_class = members_of.join(labels, "component").select("high", "low", "component_id")
    linked = real.join(by_class, ["high", "low"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = described.filter("NOT (n > 0 AND doc_id IS NOT NULL)").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")
    )
    return linked.unionByName(alone)
