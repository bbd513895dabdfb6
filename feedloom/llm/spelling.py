"""Spelling variants: words one insertion, deletion or replacement apart, by a trie of letter counts.

The alphabet is split into groups, and a word is arranged by how many letters of each group
it has, group after group: a trie. One edit changes these counts by at most one surplus and
one deficit, so a depth-first search from the root that may spend one of each reaches every
word that is near; words at the leaves it reaches are verified.

The trie is spread over the cluster. Nodes with many words are split further by the counts
of the next group, and their list, the upper trie, has a bounded size and is known to all
tasks. What hangs below is a cell, which one task holds. Every word is sent to its own cell
and, with the budget that is left, to the cells that the search reaches in the upper trie.
Inside a cell the search goes on for many words at once: as words with equal counts take
the same way, it walks pairs of nodes, those of the visiting words and those of the cell.

Near is symmetric, so a pair is searched once: the word with the smaller count in the first
group where two words differ is the one that visits.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.staging import Stage

# The letter groups, in the order of the trie; all other letters make the last group.
GROUPS = ("e", "n", "i", "t", "a", "o", "r", "s", "h", "dð", "lł", "uü", "cç", "m", "bß", "é", "p", "v", "gk", "wyf")
# Counts above this are not told apart, which can only add words to verify.
MOST = 15
# A node is split if it has more words than this, and more than this part of all words.
LEAST_SPLIT, SPLIT_PART = 4096, 4000
# Node pairs that stand for so few word pairs are not searched further; sizes of steps.
FEW_PAIRS, NODES_AT_ONCE, PAIRS_AT_ONCE, VISITORS_AT_ONCE = 12, 100_000, 1_000_000, 200_000
# Words that a task counts before it passes its counts on.
COUNTED_AT_ONCE = 300_000

# What a pair of nodes has spent: nothing, the surplus, or the surplus and the deficit.
EVEN, SURPLUS, BOTH = 0, 1, 2


# --- words ---------------------------------------------------------------------


def misspelt(word: str, start: int, every: int) -> str:
    """The word without one letter if its hash says so; start is the crc32 of what stands before it."""
    h = zlib.crc32(word.encode(), start)
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def count_words(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 7, misspell: int | None = None
) -> DataFrame:
    """Words of letters (A to Z in either case, and U+00C0 to U+00FF) with their occurrences.

    Columns: word, n. Only A-Z are lower-cased. Words have at least min_length letters. With
    `misspell` the run of letters w of document d loses letter h mod length if h, the crc32 of
    `d:w`, is a multiple of it; a null id misspells nothing. Null and empty texts have no words;
    repeated rows count as often as they occur. Other columns are not looked at.
    """
    letters = re.compile(r"[a-zÀ-ÿ]{%d,}" % min_length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def taken() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"word": pa.array(counts.keys(), pa.string()), "n": pa.array(counts.values(), pa.int64())})

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                # For bytes, lower() changes A-Z only.
                words = Counter(letters.findall((text.as_py() or b"").lower().decode("utf-8", "replace")))
                if misspell is None or (own := doc_id.as_py()) is None:
                    counts.update(words)
                else:
                    start = zlib.crc32(f"{own}:".encode())
                    for word, n in words.items():
                        word = misspelt(word, start, misspell)
                        if len(word) >= min_length:
                            counts[word] += n
                if len(counts) > COUNTED_AT_ONCE:
                    yield taken()
                    counts.clear()
        yield taken()

    found = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return found.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# --- counts of letter groups ------------------------------------------------------


def group_numbers(groups: tuple[str, ...]) -> np.ndarray:
    """Group of every letter up to U+00FF."""
    table = np.full(256, len(groups), np.int64)
    for k, group in enumerate(groups):
        for letter in group:
            if ord(letter) < 256:
                table[ord(letter)] = k
    return table


def vectors_of(words: list[str], table: np.ndarray) -> np.ndarray:
    """Counts per letter group, one row per word, cut at MOST."""
    size = int(table.max()) + 1
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    owner = np.repeat(np.arange(len(words)), lengths)
    counts = np.bincount(owner * size + table[letters], minlength=len(words) * size)
    return np.minimum(counts, MOST).astype(np.uint8).reshape(len(words), size)


# --- upper trie ------------------------------------------------------------------


def split_nodes(shapes: DataFrame, size: int, depth: int) -> set[bytes]:
    """Nodes (the counts that lead to them) with more than `size` words; `shapes` counts words by all groups.

    A level has fewer than words / size of them, so the list is bounded by their ratio.
    """
    found: set[bytes] = set()
    for level in range(depth):
        node = F.substring("shape", 1, level) if level else F.lit(bytearray())
        rows = shapes.groupBy(node.alias("node")).agg(F.sum("words").alias("words")).filter(F.col("words") > size).collect()
        found.update(bytes(r["node"]) for r in rows)
        if not rows:
            break
    return found


def visited(vector: bytes, split: set[bytes]) -> list[tuple[bytes, int]]:
    """Cells that the search from a word reaches, and what it has spent: its own cell first."""
    cells, stack = [], [(b"", EVEN)]
    while stack:
        node, spent = stack.pop()
        if node not in split:
            cells.append((node, spent))
            continue
        count = vector[len(node)]
        if spent == SURPLUS and count > 0:
            stack.append((node + bytes([count - 1]), BOTH))
        if spent == EVEN and count < MOST:
            stack.append((node + bytes([count + 1]), SURPLUS))
        stack.append((node + bytes([count]), spent))
    return cells


# --- search inside a cell -----------------------------------------------------------


class Trie:
    """Words sorted by their counts; the nodes of a level are stretches of this order."""

    def __init__(self, words: list[str], ns: list[int], table: np.ndarray):
        vectors = vectors_of(words, table)
        order = np.lexsort(vectors.T[::-1])
        self.words = [words[i] for i in order]
        self.n = np.array(ns, np.int64)[order]
        vectors = vectors[order]
        self.lengths = np.fromiter(map(len, self.words), np.int64, len(words))
        new = np.zeros(len(words), bool)
        new[:1] = True
        self.starts = [np.flatnonzero(new)]
        self.keys, self.children = [], []
        for level in range(vectors.shape[1]):
            counts = vectors[:, level].astype(np.int64)
            parent = np.cumsum(new) - 1
            new = new.copy()
            new[1:] |= counts[1:] != counts[:-1]
            starts = np.flatnonzero(new)
            self.starts.append(starts)
            # A child's key is its parent and its count; keys are in order.
            self.keys.append(parent[starts] * 256 + counts[starts])
            self.children.append(np.searchsorted(parent[starts], np.arange(len(self.starts[level]) + 1)))
        self.ends = [np.append(s[1:], len(words)) for s in self.starts]
        self.hashes()

    def hashes(self) -> None:
        """Hashes of a word's first half and of the rest, for its own length and for one letter less."""
        table = np.empty((4, len(self.words)), np.int64)
        for i, w in enumerate(self.words):
            size = len(w)
            a, b = size // 2, (size - 1) // 2
            table[0, i], table[1, i] = hash(w[:a]), hash(w[a:])
            table[2, i], table[3, i] = hash(w[:b]), hash(w[size - (size - 1 - b) :])
        self.halves = table


def spread(first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For stretches that begin at `first`: which stretch every element is of, and the element."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def near(a: str, b: str) -> bool:
    """Whether one letter inserted, deleted or replaced makes one word of the other."""
    if len(a) < len(b):
        a, b = b, a
    if a == b or len(a) - len(b) > 1:
        return False
    size = len(b)
    at = 0
    while at < size and a[at] == b[at]:
        at += 1
    return a[at + 1 :] == b[at + (len(a) == size) :]


def verified(left: Trie, right: Trie, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word pairs that are near. One edit leaves the first half or the rest as it is."""
    a, b = left.lengths[i], right.lengths[j]
    close = np.abs(a - b) <= 1
    i, j, a, b = i[close], j[close], a[close], b[close]
    less_a, less_b = 2 * (a > b), 2 * (b > a)
    same = (left.halves[less_a, i] == right.halves[less_b, j]) | (left.halves[less_a + 1, i] == right.halves[less_b + 1, j])
    i, j = i[same], j[same]
    xs, ys = left.words, right.words
    hit = np.fromiter((near(xs[x], ys[y]) for x, y in zip(i.tolist(), j.tolist())), bool, len(i))
    return i[hit], j[hit]


def search(left: Trie, right: Trie, spent: int, level: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs of words, the first of `left`, the visitors, the second of `right`.

    The words of `right` agree in the groups above the level, and the visitors have spent
    what they differ there. With EVEN both must be the same trie, and its pairs are found once. Depth first, in
    blocks of node pairs of one level, so that memory is bounded.
    """
    depth = len(left.keys)
    found_i, found_j = [], []
    nodes = np.arange(len(left.starts[level]))
    stack = [(level, nodes, np.zeros_like(nodes), np.full(len(nodes), spent, np.int64))]
    while stack:
        level, x, y, state = stack.pop()
        sx, sy = left.starts[level][x], right.starts[level][y]
        nx, ny = left.ends[level][x] - sx, right.ends[level][y] - sy
        leaf = (nx * ny <= FEW_PAIRS) if level < depth else np.ones(len(x), bool)
        if leaf.any():
            px, py, qx, qy, even = sx[leaf], sy[leaf], nx[leaf], ny[leaf], state[leaf] == EVEN
            # Word pairs of all leaf pairs, in blocks; a very large leaf pair goes by its first words.
            which, i = spread(px, qx)
            sizes = qy[which]
            cuts = np.searchsorted(np.cumsum(sizes), np.arange(PAIRS_AT_ONCE, int(sizes.sum()) + PAIRS_AT_ONCE, PAIRS_AT_ONCE))
            begin = 0
            for end in np.unique(np.append(cuts + 1, len(which)).clip(max=len(which))).tolist():
                own, j = spread(py[which[begin:end]], sizes[begin:end])
                first = i[begin:end][own]
                once = ~even[which[begin:end][own]] | (first < j)
                a, b = verified(left, right, first[once], j[once])
                found_i.append(a)
                found_j.append(b)
                begin = end
        if leaf.all():
            continue
        x, y, state = x[~leaf], y[~leaf], state[~leaf]
        begins = left.children[level][x]
        which, child = spread(begins, left.children[level][x + 1] - begins)
        wanted = y[which] * 256 + left.keys[level][child] % 256
        state = state[which]
        keys = right.keys[level]
        for delta, before, after in ((0, None, None), (1, EVEN, SURPLUS), (-1, SURPLUS, BOTH)):
            use = slice(None) if before is None else np.flatnonzero(state == before)
            target = wanted[use] + delta
            if delta < 0:
                positive = wanted[use] % 256 > 0
                use, target = use[positive], target[positive]
            at = np.searchsorted(keys, target)
            met = np.flatnonzero(keys[np.minimum(at, len(keys) - 1)] == target)
            next_x, next_y = child[use][met], at[met]
            next_state = state[use][met] if after is None else np.full(len(met), after, np.int64)
            for k in range(0, len(met), NODES_AT_ONCE):
                part = slice(k, k + NODES_AT_ONCE)
                stack.append((level + 1, next_x[part], next_y[part], next_state[part]))
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *found_i]), np.concatenate([empty, *found_j])


def best_partners(words: Trie, others: Trie, own: np.ndarray, other: np.ndarray) -> dict[str, list]:
    """Per word: number of its partners, and the one of the largest n, ties by code points."""
    if not len(own):
        return {"word": [], "n_near": [], "form_n": [], "form": []}
    met = np.unique(other)
    by_word = sorted(range(len(met)), key=lambda k: others.words[met[k]])
    rank = np.empty(len(met), np.int64)
    rank[by_word] = np.arange(len(met))
    rank = rank[np.searchsorted(met, other)]
    order = np.lexsort((rank, -others.n[other], own))
    own, other = own[order], other[order]
    first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    return {
        "word": [words.words[i] for i in own[first].tolist()],
        "n_near": np.diff(np.append(first, len(own))).tolist(),
        "form_n": others.n[other[first]].tolist(),
        "form": [others.words[i] for i in other[first].tolist()],
    }


PARTNERS = "word string, n_near long, form_n long, form string"


def search_cells(rows: DataFrame, table: np.ndarray) -> DataFrame:
    """Partners within the cells. Rows (cell, spent, word, n) are sorted by cell and spent.

    A task holds the words of one cell and a bounded number of its visitors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])
        cell, spent, trie = None, EVEN, None
        words: list[str] = []
        ns: list[int] = []

        def found() -> Iterator[pa.RecordBatch]:
            nonlocal trie
            if not words:
                return
            if spent != EVEN and trie is None:
                return  # visitors of a cell without words
            here = Trie(words, ns, table)
            if spent == EVEN:
                trie = here
            i, j = search(here, trie, spent, len(cell))
            if spent == EVEN:
                i, j = np.concatenate((i, j)), np.concatenate((j, i))
            yield pa.RecordBatch.from_pydict(best_partners(here, trie, i, j), schema=out)
            if spent != EVEN:
                yield pa.RecordBatch.from_pydict(best_partners(trie, here, j, i), schema=out)

        for batch in batches:
            kinds = zip(batch.column("cell").to_pylist(), batch.column("spent").to_pylist())
            for key, word, n in zip(kinds, batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                if key != (cell, spent) or (spent != EVEN and len(words) >= VISITORS_AT_ONCE):
                    yield from found()
                    if key[0] != cell:
                        trie = None
                    cell, spent = key
                    words, ns = [], []
                words.append(word)
                ns.append(n)
        yield from found()

    return rows.mapInArrow(run, PARTNERS)


def near_words(vocabulary: DataFrame, groups: tuple[str, ...] = GROUPS, least_split: int = LEAST_SPLIT) -> DataFrame:
    """For every word that has near ones: their number, and the one with the largest n.

    `vocabulary` has distinct words (letters up to U+00FF) and n. Columns: word, n_near,
    form_n, form. The result does not depend on the groups or on least_split.
    """
    stage = Stage(vocabulary.sparkSession, "spelling")
    table = group_numbers(groups)

    def shape_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                counts = Counter(map(bytes, vectors_of(batch.column(0).to_pylist(), table)))
                yield pa.RecordBatch.from_pydict({"shape": pa.array(counts.keys(), pa.binary()), "words": pa.array(counts.values(), pa.int64())})

    shapes = stage.write(
        vocabulary.select("word").mapInArrow(shape_of, "shape binary, words long").groupBy("shape").agg(F.sum("words").alias("words"))
    )
    total = shapes.agg(F.sum("words")).first()[0] or 0
    split = split_nodes(shapes, max(least_split, total // SPLIT_PART), len(groups) + 1)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("cell", "spent", "word", "n")
        known: dict[bytes, list[tuple[bytes, int]]] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                words = batch.column(0).slice(at, 2000).to_pylist()
                columns: tuple[list, ...] = ([], [], [], [])
                for vector, word, n in zip(map(bytes, vectors_of(words, table)), words, batch.column(1).slice(at, 2000).to_pylist()):
                    if vector not in known:
                        if len(known) >= 50_000:
                            known.clear()
                        known[vector] = visited(vector, split)
                    for cell, spent in known[vector]:
                        for column, value in zip(columns, (cell, spent, word, n)):
                            column.append(value)
                kinds = (pa.binary(), pa.int32(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    spark = vocabulary.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    sent = vocabulary.select("word", "n").mapInArrow(send, "cell binary, spent int, word string, n long")
    found = search_cells(sent.repartition(tasks, "cell").sortWithinPartitions("cell", "spent"), table)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return (
        found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
        .select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form"))
    )


# --- forms -----------------------------------------------------------------------


def variants(vocabulary: DataFrame, min_count: int = 2, factor: int = 10, **options) -> DataFrame:
    """Every word with the more usual spelling it is a variant of, if any.

    `vocabulary` has distinct words and n, their occurrences. Words with n < min_count are
    left out altogether. Columns: word, form (of the words one edit away the one with the
    largest n, ties by code points, if that n is at least factor times the word's; else
    null), root (the last word when forms are followed; the word itself without a form), n,
    n_near (how many words are one edit away), form_n. Null words are left out.
    Jobs run when this is called.
    """
    stage = Stage(vocabulary.sparkSession, "variants")
    words = stage.write(vocabulary.filter((F.col("n") >= min_count) & F.col("word").isNotNull()).select("word", "n"))
    near = near_words(words, **options)
    usual = F.col("form_n") >= F.col("n") * factor
    known = stage.write(
        words.join(near.hint("shuffle_hash"), "word", "left").select(
            "word", F.when(usual, F.col("form")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(usual, F.col("form_n")).alias("form_n"),
        )
    )
    # Each step doubles the forms followed; every form is factor times as frequent as the one before.
    roots = known.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    steps = Stage(vocabulary.sparkSession, "roots")
    while True:
        roots = steps.write(roots)
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        met = roots.join(onward, "root")
        if met.isEmpty():
            break
        roots = roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
