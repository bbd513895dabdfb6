"""Mixing sources to target weights by hierarchical budgeting.

The tree is domain, language, source. A node's budget goes to its children in proportion
to their weights. A child cannot take more than its tokens times the allowed epochs; what
it falls short of goes to its siblings by their weights, and only what all of them cannot
take stays with the parent, whose own siblings then get it. Each leaf fills its budget
with whole seeded epochs and a prefix of the next one's order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.functions.staging import Stage

LEVELS = ("domain", "lang", "source")
# The root's key, and what a null stands for in a level.
NONE = "(none)"
# The token order of an epoch is cut into this many parts, so that no leaf is one task's work.
PARTS = 1 << 12
# Blanks are the ASCII ones; a token of the budget is a word.
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def named(value: Column, names: dict[str, tuple[str, ...]], other: str) -> Column:
    """The name whose list holds the value."""
    result = F.lit(other)
    for name, values in names.items():
        result = F.when(value.isin(*values), F.lit(name)).otherwise(result)
    return result


def weight_of(key: Column, weights: dict[str, int], default: int) -> Column:
    result = F.lit(default)
    for name, weight in weights.items():
        result = F.when(key == name, F.lit(weight)).otherwise(result)
    return result.cast("long")


def share(nodes: DataFrame, parent: list[str], key: str) -> DataFrame:
    """Give each parent's `budget` to its children: columns weight and cap in, budget out.

    In order of cap / weight, a child's level is what the budget left by the children before
    it gives it and the later ones per weight. Levels rise while children are exhausted and
    fall afterwards, so the largest is the one at which all others are served; exhausted
    children get their cap. All sums are of whole numbers, hence exact.
    """
    order = [(F.col("cap") / F.col("weight")).asc(), F.col(key).asc()]
    before = W.partitionBy(*parent).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    onward = W.partitionBy(*parent).orderBy(*order).rowsBetween(0, W.unboundedFollowing)
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(onward)
    own = F.col("cap") / F.col("weight")
    everyone = W.partitionBy(*parent)
    return (
        nodes.withColumn("level", level)
        .withColumn("served", F.max("level").over(everyone))
        .withColumn(
            "budget",
            F.when(own < F.col("served"), F.col("cap"))
            .otherwise(F.least(F.col("cap"), F.floor(F.col("served") * F.col("weight"))))
            .cast("long"),
        )
        .drop("level", "served", "weight", "cap")
    )


def leaf_budgets(leaves: DataFrame, weights: dict[str, dict[str, int]], default: int, total: Column, epochs: int) -> DataFrame:
    """Budgets of the leaves (domain, lang, source, tokens): what the tree grants each of them.

    Weights are whole numbers per level and key; keys without one have the default weight,
    and a key of weight 0 gets nothing. The budget is the whole `total`, or all there is.
    """
    usable = leaves
    for level in LEVELS:
        usable = usable.filter(weight_of(F.col(level), weights.get(level, {}), default) > 0)
    budgets = usable.agg(total.cast("long").alias("budget")).filter(F.col("budget").isNotNull())
    for depth in range(1, len(LEVELS) + 1):
        keys = list(LEVELS[:depth])
        nodes = usable.groupBy(*keys).agg((F.sum("tokens") * epochs).alias("cap")).withColumn(
            "weight", weight_of(F.col(keys[-1]), weights.get(keys[-1], {}), default)
        )
        if depth == 1:
            nodes = nodes.crossJoin(F.broadcast(budgets))  # one row: the root's budget
        else:
            nodes = nodes.join(budgets, keys[:-1])
        budgets = share(nodes, keys[:-1], keys[-1])
    return budgets


def mix(
    docs: DataFrame,
    weights: dict[str, dict[str, int]],
    domain: Column,
    portion: tuple[int, int] = (1, 2),
    epochs: int = 1,
    default: int = 1,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    key: Column | None = None,
) -> DataFrame:
    """Selected documents: doc_id, domain, lang, source, epoch (from 0), start, tokens.

    The budget is the portion (numerator, denominator) of all tokens. `start` counts the
    tokens of the leaf's epoch before the document; a document is taken if it starts inside
    the leaf's prefix, so a leaf exceeds its budget by less than one document. Documents
    without words take no budget: they are taken in each whole epoch and while the prefix
    lasts. Nulls in domain, language or source are keys of their own, "(none)". Equal ids
    order by their number of tokens. A `key` tells rows apart that share an id, or have none:
    it comes after the tokens in that order, gives null ids their places and is returned as a
    column. Rows of one key are interchangeable. Other columns are not looked at.
    """
    stage = Stage(docs.sparkSession, "mixing")
    known = lambda c: F.coalesce(c, F.lit(NONE))
    # The place of a document in an epoch is the head of a digest: 60 bits.
    keys = [] if key is None else ["key"]
    name = F.coalesce(F.col("doc_id").cast("string"), *[F.xxhash64(k).cast("string") for k in keys])
    place = lambda epoch: F.conv(
        F.substring(F.md5(F.concat_ws(":", F.lit(seed), epoch, name).cast("binary")), 1, 15), 16, 10
    ).cast("long")
    narrow = stage.write(
        docs.select(
            F.col(id_col).alias("doc_id"),
            known(domain).alias("domain"),
            known(F.col(lang_col)).alias("lang"),
            known(F.col(source_col)).alias("source"),
            n_words(F.col(text_col)).alias("tokens"),
            *([] if key is None else [key.alias("key")]),
        )
    )
    leaves = narrow.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    total = F.floor(F.sum("tokens") * portion[0] / portion[1])
    budgets = stage.write(
        leaf_budgets(leaves, weights, default, total, epochs)
        .join(leaves, list(LEVELS))
        .withColumn("whole", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(epochs))
        .withColumn("rest", F.when(F.col("tokens") > 0, F.col("budget") % F.col("tokens")).otherwise(0))
        .withColumnRenamed("tokens", "leaf_tokens")
    )
    # A document is read once per epoch that its leaf begins.
    begun = F.least(F.lit(epochs), F.col("whole") + (F.col("rest") > 0).cast("int")).cast("int")
    drawn = (
        narrow.join(budgets, list(LEVELS))
        .filter(begun > 0)
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), begun - 1)))
        .withColumn("place", place(F.col("epoch")))
        .withColumn("part", F.shiftright("place", 60 - PARTS.bit_length() + 1))
    )
    drawn = stage.write(drawn)
    parts = drawn.groupBy(*LEVELS, "epoch", "part").agg(F.sum("tokens").alias("n"))
    ahead = W.partitionBy(*LEVELS, "epoch").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0))).drop("n")
    within = (
        W.partitionBy(*LEVELS, "epoch", "part")
        .orderBy("place", "doc_id", "tokens", *keys)
        .rowsBetween(W.unboundedPreceding, -1)
    )
    started = drawn.withColumn("own", F.coalesce(F.sum("tokens").over(within), F.lit(0))).join(
        offsets, [*LEVELS, "epoch", "part"]
    )
    start = F.col("ahead") + F.col("own")
    return started.filter((F.col("epoch") < F.col("whole")) | (start < F.col("rest"))).select(
        "doc_id", *LEVELS, "epoch", start.alias("start"), "tokens", *keys
    )
