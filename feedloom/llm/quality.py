"""Quality classifier: naive Bayes support vectors.

Features are hashed n-grams of characters and of word shapes, as indicators. Each is scaled
by the log-count ratio of the two classes, and a linear hinge-loss model is fitted to the
scaled indicators by dual coordinate descent. Margins become scores by a logistic curve
that is fitted to rows kept from the descent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import ROWS_AT_ONCE, held_out, map_rows, thinned
from feedloom.llm.features import characters, grams, word_shapes

BITS = 17
# The model is fitted to at most this many labelled rows, those with the smallest digests.
SAMPLE = 20_000
SMOOTHING = 1.0
COST = 1.0
ROUNDS = 12
SEED = 7


def indicators(text: str) -> np.ndarray:
    """Sorted numbers of the n-grams that the text has."""
    letters, shapes = characters(text), word_shapes(text)
    parts = [grams(letters, n, 1, BITS) for n in (1, 2, 3)] + [grams(shapes, n, 2, BITS) for n in (1, 2, 3)]
    return np.unique(np.concatenate(parts)).astype(np.int32)


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Naive Bayes weights: log of the ratio of the normalised indicator counts of the classes."""
    counts = np.full((2, 1 << BITS), SMOOTHING)
    for row, label in zip(rows, labels, strict=True):
        counts[int(label), row] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def descend(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """Dual coordinate descent for the hinge loss; the last weight is the bias.

    Rows are scaled to length 1 and classes weigh the same.
    """
    weights, bias = np.zeros(len(ratios)), 0.0
    signs = np.where(labels > 0, 1.0, -1.0)
    limits = np.where(labels > 0, 0.5 / max((labels > 0).mean(), 1e-9), 0.5 / max((labels <= 0).mean(), 1e-9)) * COST
    alpha, rng = np.zeros(len(rows)), np.random.default_rng(SEED)
    for _ in range(ROUNDS):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            row, x = rows[i], scaled(rows[i], ratios)  # a second copy of all rows would be twice as large
            gradient = signs[i] * (weights[row] @ x + bias) - 1
            new = min(max(alpha[i] - gradient / (x @ x + 1.0), 0.0), limits[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * signs[i]
                weights[row] += step * x
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3:
            break
    return np.append(weights, bias)


def scaled(row: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    x = ratios[row]
    length = np.sqrt(x @ x)
    return x / length if length > 0 else x


def margin(row: np.ndarray, ratios: np.ndarray, weights: np.ndarray) -> float:
    return float(weights[row] @ scaled(row, ratios) + weights[-1])


def logistic_curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the curve that turns margins into probabilities (Newton steps)."""
    positive, negative = (labels > 0).sum(), (labels <= 0).sum()
    target = np.where(labels > 0, (positive + 1) / (positive + 2), 1 / (negative + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -35, 35)))
        w = p * (1 - p) + 1e-9
        gradient = np.array([((p - target) * margins).sum(), (p - target).sum()])
        curvature = np.array([[(w * margins**2).sum(), (w * margins).sum()], [(w * margins).sum(), w.sum()]])
        step = np.linalg.solve(curvature + 1e-6 * np.eye(2), gradient)
        a, b = max(a - step[0], 1e-3), b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return a, b


class Model:
    """Ratios, weights and curve; without rows of both classes it only knows their share."""

    def __init__(self, rows: list[np.ndarray], labels: np.ndarray):
        self.prior = float((labels > 0).mean()) if len(labels) else 0.5
        self.weights = None
        if len(labels) < 2 or self.prior in (0.0, 1.0):
            return
        # Every fifth row of either class fits the curve, if there are enough.
        turn = np.zeros(len(labels), int)
        for label in (0, 1):
            mine = labels == label
            turn[mine] = np.arange(mine.sum())
        kept = turn % 5 == 4
        if min((labels[kept] > 0).sum(), (labels[kept] <= 0).sum()) < 5:
            kept[:] = False
        fit = [row for row, k in zip(rows, kept, strict=True) if not k]
        self.ratios = log_count_ratios(fit, labels[~kept])
        self.weights = descend(fit, labels[~kept], self.ratios)
        chosen = kept if kept.any() else ~kept
        margins = np.array([margin(r, self.ratios, self.weights) for r, k in zip(rows, chosen, strict=True) if k])
        self.curve = logistic_curve(margins, labels[chosen])
        self.ratios, self.weights = self.ratios.astype(np.float32), self.weights.astype(np.float32)

    def score(self, text: str) -> float:
        if self.weights is None:
            return self.prior
        a, b = self.curve
        at = a * margin(indicators(text), self.ratios, self.weights) + b
        return float(1 / (1 + np.exp(-np.clip(at, -35, 35))))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    """Fit the model to labelled rows that are not held out: at most `sample` of them.

    The rows are those with the smallest digests of id and label, so they are a random
    choice that depends on nothing else; the bound also bounds what reaches the driver. Of
    rows that share an id the text with the smallest digest counts, and an id with both labels
    stands for both. Null ids teach nothing, null texts are empty.
    """
    usable = (
        labels.select("doc_id", F.col("quality").cast("int").alias("label"))
        .filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    )
    few = usable.filter(thinned(F.col("doc_id"), sample, F.lit(usable.count())))
    chosen = few.distinct().orderBy(F.xxhash64("doc_id", "label"), "doc_id", "label").limit(sample)
    # At most `sample` rows of two numbers, so the broadcast is bounded.
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    met = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label")
    one = met.agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))

    def features(rows: list[dict]) -> list[dict]:
        return [{"label": r["label"], "doc_id": r["doc_id"], "grams": indicators(r["text"]).tobytes()} for r in rows]

    found = map_rows(one, features, "label int, doc_id long, grams binary").toArrow()
    rows, class_of = in_order(found)
    del found
    pa.default_memory_pool().release_unused()
    return Model(rows, class_of)


def in_order(found: pa.Table) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows by id and label, as parts of one array, and their labels."""
    labels = found["label"].to_numpy()
    order = np.lexsort((labels, found["doc_id"].to_numpy()))
    grams = found["grams"]
    ends = np.cumsum([grams[i].as_buffer().size // 4 for i in order.tolist()], dtype=np.int64)
    numbers = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
    rows = np.split(numbers, ends[:-1]) if len(ends) else []
    for row, i in zip(rows, order.tolist()):
        row[:] = np.frombuffer(grams[i].as_buffer(), np.int32)
    return rows, labels[order]


def score_quality(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5
) -> DataFrame:
    """Score every row: doc_id, held_out, score (higher: quality 1 is likelier), predicted.

    A null text counts as empty; empty texts have no n-grams and get the score of the bias.
    Rows are scored one by one, so repeated ids and other columns do not matter.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # a fixed size: two weights per feature

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                scores = [shared.value.score(t or "") for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(scores, pa.float64())],
                    names=["doc_id", "held_out", "score"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    scored = narrow.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_quality(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows that the model does not reject, all columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def accepted(texts):
        return texts.map(lambda t: shared.value.score(t or "") >= threshold)

    return docs.filter(accepted(F.col(text_col)))
