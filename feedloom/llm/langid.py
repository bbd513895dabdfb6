"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over all training texts. The model is trained on a bounded
sample per language with follow-the-regularised-leader updates, whose elastic-net penalty
leaves most weights at zero; a temperature fitted to rows kept from training calibrates
its probabilities.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.llm.common import ROWS_AT_ONCE, held_out, map_rows, thinned
from feedloom.llm.features import characters, grams

BITS = 16
SIZES = (1, 2, 3)
# Rows that the model is fitted to: at most SAMPLE over all languages, shared equally.
SAMPLE = 12_000
ROUNDS = 3
# Step size and smoothing of the updates, and the two penalties.
ALPHA, BETA = 0.5, 1.0
L1, L2 = 0.05, 0.1
UNKNOWN = "und"
NO_LETTERS = re.compile(r"[\W\d_]+")


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the text's n-grams, in order, and how often it has each.

    Letters count in lower case; whatever stands between words is one blank.
    """
    letters = characters(NO_LETTERS.sub(" ", f" {text} ".lower()))
    found = np.bincount(np.concatenate([grams(letters, n, 3, BITS) for n in SIZES]), minlength=1)
    numbers = np.flatnonzero(found)
    return numbers.astype(np.int32), found[numbers]


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of the texts each n-gram occurs, and the number of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, n = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                totals[counted(text)[0]] += 1
                n += 1
        if n:
            at = np.flatnonzero(totals)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(at, -1)), pa.array(np.append(totals[at], n))], names=["gram", "n"]
            )

    found = texts.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    out, n = np.zeros(1 << BITS, np.int64), 0
    for gram, count in zip(found["gram"].to_pylist(), found["n"].to_pylist(), strict=True):
        if gram < 0:
            n = count
        else:
            out[gram] = count
    return out, n


class Model:
    """Weights of the languages over the n-grams, with a bias as the last feature."""

    def __init__(self, languages: list[str], idf: np.ndarray):
        self.languages, self.idf, self.temperature = languages, idf, 1.0
        shape = (len(idf) + 1, len(languages))
        self.z, self.squares = np.zeros(shape), np.zeros(shape)
        self.weights = np.zeros(shape)

    def vector(self, numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """TF-IDF with logarithmic frequencies, of length 1, and the bias."""
        values = (1 + np.log(counts)) * self.idf[numbers]
        length = np.sqrt(values @ values)
        values = values / length if length > 0 else values
        return np.append(numbers, len(self.idf)), np.append(values, 1.0)

    def lazy(self, at: np.ndarray) -> np.ndarray:
        """The regularised leader's weights of some features."""
        z, rate = self.z[at], (BETA + np.sqrt(self.squares[at])) / ALPHA + L2
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / rate)

    def learn(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> None:
        rng = np.random.default_rng(11)
        for _ in range(ROUNDS):
            for i in rng.permutation(len(rows)):
                at, x = rows[i]
                weights = self.lazy(at)
                error = softmax(x @ weights)
                error[labels[i]] -= 1
                gradient = np.outer(x, error)
                grown = self.squares[at] + gradient**2
                self.z[at] += gradient - (np.sqrt(grown) - np.sqrt(self.squares[at])) / ALPHA * weights
                self.squares[at] = grown
        self.weights = self.lazy(np.arange(len(self.z))).astype(np.float32)

    def calibrate(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> None:
        """The temperature with the smallest log loss on rows that were not learnt from."""
        logits = np.array([x @ self.weights[at] for at, x in rows])

        def loss(t: float) -> float:
            scaled = logits / t
            scaled = scaled - scaled.max(axis=1, keepdims=True)
            own = scaled[np.arange(len(labels)), labels]
            return float((np.log(np.exp(scaled).sum(axis=1)) - own).mean())

        self.temperature = min(np.geomspace(0.05, 20, 121), key=loss)

    def finish(self) -> Model:
        del self.z, self.squares
        return self

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not any(map(str.isalpha, text)) or not self.languages:
            return UNKNOWN, 0.0
        at, x = self.vector(*counted(text))
        p = softmax(x @ self.weights[at] / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(min(p[best], 1.0))


def softmax(logits: np.ndarray) -> np.ndarray:
    p = np.exp(logits - logits.max()) if len(logits) else logits
    return p / p.sum()


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE
) -> Model:
    """Train on rows with a text and a language that are not held out.

    At most `sample` rows are fitted to (per language the ones with the smallest digests of
    their ids; of rows that share an id and a language the text with the smallest digest);
    document frequencies come from all of them. Languages are few, so a language
    always has its share of the sample.
    """
    usable = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull())
    frequencies, n = document_frequencies(usable.select("text"))
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}  # few rows
    languages = sorted(sizes)
    model = Model(languages, np.log((1 + n) / (1 + frequencies)) + 1)
    if not languages:
        return model.finish()
    most = max(1, sample // len(languages))
    total = F.coalesce(*[F.when(F.col("lang") == lang, F.lit(n)) for lang, n in sizes.items()])
    each = W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        usable.select("doc_id", "lang")
        .filter(thinned(F.col("doc_id"), most, total))
        .distinct()
        .withColumn("n", F.row_number().over(each))
        .filter(F.col("n") <= most)
        .drop("n")
    )
    # At most `sample` rows of an id and a language, so the broadcast is bounded.
    met = usable.join(F.broadcast(chosen), ["doc_id", "lang"]).groupBy("doc_id", "lang")
    one = met.agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))

    def features(rows: list[dict]) -> list[dict]:
        out = []
        for r in rows:
            numbers, counts = counted(r["text"])
            out.append(
                {
                    "doc_id": r["doc_id"], "lang": r["lang"], "grams": numbers.tobytes(),
                    "counts": np.minimum(counts, 1 << 30).astype(np.int32).tobytes(),
                }
            )
        return out

    found = map_rows(one, features, "doc_id long, lang string, grams binary, counts binary").toArrow()
    found = found.sort_by([("doc_id", "ascending"), ("lang", "ascending"), ("grams", "ascending")])
    number = {lang: i for i, lang in enumerate(languages)}
    labels = np.array([number[lang] for lang in found["lang"].to_pylist()])
    rows = [
        model.vector(np.frombuffer(g, np.int32), np.frombuffer(c, np.int32))
        for g, c in zip(found["grams"].to_pylist(), found["counts"].to_pylist(), strict=True)
    ]
    kept = np.arange(len(rows)) % 5 == 4
    model.learn([r for r, k in zip(rows, kept, strict=True) if not k], labels[~kept])
    if kept.any():
        model.calibrate([r for r, k in zip(rows, kept, strict=True) if k], labels[kept])
    return model.finish()


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The language of every row: doc_id, held_out, lang_pred, score.

    Null texts and texts without any letter (`str.isalpha`) are "und" with score 0; so is every text if
    there was nothing to learn from. Rows are judged one by one, so repeated ids and other
    columns do not matter.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size per language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                told = [shared.value.predict(t) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1),
                        pa.array([t[0] for t in told], pa.string()), pa.array([t[1] for t in told], pa.float64()),
                    ],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
