"""Language filter from trigram profiles learned on labelled texts.

A profile lists a language's most frequent character trigrams with their log-probability
there. A text gets the language under which its trigrams are the most likely; trigrams
that a profile does not list count alike for all languages. Log-probabilities are whole
thousandths, so sums are exact and do not depend on any order. Profiles hold a fixed
number of trigrams per language: they travel to the tasks as one table with a cell per
trigram of their alphabet, and the filter neither shuffles nor copies the reviews.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROFILE_SIZE = 300
# Scores are thousandths of natural logarithms; a trigram that is listed nowhere is less likely
# by one than the least likely one that is listed.
SCALE = 1000
# Characters that are scored at once, some 50 bytes each.
CHARS_AT_ONCE = 1 << 20
# Cells of a table that is addressed by the three letters of a trigram.
DENSE = 1 << 24


def _letters(text: Column) -> Column:
    """Lower-cased words of letters, separated by single blanks."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "))


def _padded_grams(spaced: Column) -> Column:
    """Trigrams inside the words of ` word word `, with the blanks at their edges."""
    return F.regexp_extract_all(spaced, F.lit(r"(?=(.[^ ].))"), F.lit(1))


def trigrams(text: Column) -> Column:
    """Overlapping trigrams of every word of the text, each with a blank on both sides."""
    return _padded_grams(F.concat(F.lit(" "), _letters(text), F.lit(" ")))


def train_profiles(
    df: DataFrame, text: str = "review_text", lang: str = "lang", size: int = PROFILE_SIZE
) -> DataFrame:
    """The `size` most frequent trigrams of every language, ties by trigram.

    Columns: lang, gram, rank, and gain: by how many thousandths the logarithm of the trigram's
    share in its language exceeds that of a trigram that no profile lists. Rows without a language or text
    teach nothing. Trigrams do not cross words, so words are counted first and only the
    different words are taken apart: far fewer rows than one per trigram of every text.
    """
    order = Window.partitionBy("lang").orderBy(F.desc("n"), F.asc("gram"))
    vocabulary = (
        df.filter(F.col(lang).isNotNull())
        .select(
            F.col(lang).alias("lang"), F.explode(F.split(_letters(F.col(text)), " ")).alias("word")
        )
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("uses"))
    )
    grams = (
        vocabulary.select(
            "lang",
            "uses",
            F.explode(_padded_grams(F.concat(F.lit(" "), "word", F.lit(" ")))).alias("gram"),
        )
        .groupBy("lang", "gram")
        .agg(F.sum("uses").alias("n"))
    )
    listed = (
        grams.withColumn("rank", F.row_number().over(order))
        .withColumn("share", F.ln(F.col("n") / F.sum("n").over(Window.partitionBy("lang"))))
        .filter(F.col("rank") <= size)
    )
    # A profile has few rows, and there are as many profiles as languages.
    least = F.min("share").over(Window.partitionBy())
    gain = F.floor((F.col("share") - least) * SCALE + 0.5) + SCALE
    return listed.select("lang", "gram", "rank", gain.alias("gain"))


class Scorer:
    """Sums the gains of a text's trigrams for every language at once."""

    def __init__(self, rows: list[tuple[str, str, int]]):
        self.langs = sorted({lang for lang, _, _ in rows})
        letters = sorted({c for _, gram, _ in rows for c in gram} | {" "})
        self.blank = letters.index(" ") + 1
        # Characters outside the profiles are class 0; no listed trigram has one.
        self.classes = np.zeros(0x110000, np.int64)
        for k, c in enumerate(letters):
            self.classes[ord(c)] = k + 1
        self.base = len(letters) + 1
        cells = [self.cell(*(int(self.classes[ord(x)]) for x in gram)) for _, gram, _ in rows]
        # Alphabets of very many letters get a sorted list in place of a table; place 0 is no trigram.
        self.listed = None if self.base**3 <= DENSE else np.unique([-1, *cells])
        size = self.base**3 if self.listed is None else len(self.listed)
        self.gains = np.zeros((len(self.langs), size), np.int32)
        for (lang, _, gain), cell in zip(rows, cells):
            self.gains[self.langs.index(lang), self.place(np.array([cell]))[0]] = gain

    def cell(self, a, b, c):
        return (a * self.base + b) * self.base + c

    def place(self, cells: np.ndarray) -> np.ndarray:
        if self.listed is None:
            return cells
        at = np.minimum(np.searchsorted(self.listed, cells), len(self.listed) - 1)
        return np.where(self.listed[at] == cells, at, 0)

    def best(self, texts: list[str]) -> list[str | None]:
        """Language of each of some texts that begin and end with a blank."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = self.classes[codes]
        cell = self.cell(kind[:-2], kind[1:-1], kind[2:])
        # Trigrams are around a letter, so none reaches over the blanks between two texts.
        cell[kind[1:-1] == self.blank] = 0
        place = self.place(cell)
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        sums = np.stack([np.add.reduceat(np.append(g[place], [0, 0]).astype(np.int64), starts) for g in self.gains])
        top = sums.argmax(axis=0)  # the first by name of equal ones
        return [self.langs[k] if most > 0 else None for k, most in zip(top.tolist(), sums.max(axis=0).tolist())]

    def languages(self, texts: pa.Array) -> list[str | None]:
        """Of an Arrow column, of which only a part at a time is turned into Python texts."""
        out: list[str | None] = []
        part: list[str] = []
        held = 0
        for text in texts:
            part.append(f" {text.as_py() or ''} ")
            held += len(part[-1])
            if held >= CHARS_AT_ONCE:
                out += self.best(part)
                part, held = [], 0
        return out + (self.best(part) if part else [])


def detector(profiles: DataFrame) -> Callable[[Column], Column]:
    """A function from a text column to its language; reads the profiles when it is made."""
    rows = [(r["lang"], r["gram"], r["gain"]) for r in profiles.select("lang", "gram", "gain").collect()]
    if not rows:
        return lambda text: F.lit(None).cast("string")
    scorer = profiles.sparkSession.sparkContext.broadcast(Scorer(rows))

    @F.arrow_udf("string")
    def language_of(texts: pa.Array) -> pa.Array:
        return pa.array(scorer.value.languages(texts), pa.string())

    return lambda text: language_of(_letters(text))


def detect_language(
    df: DataFrame,
    profiles: DataFrame,
    text: str = "review_text",
    chars: int | None = None,
    name: str = "detected_lang",
) -> DataFrame:
    """Add the language of the text, null if no profile lists any of its trigrams.

    With `chars` only that many first characters are looked at, which is faster and
    misses what follows; 500 is a usual number. Among equally likely languages the first by name wins.
    The profiles are read when this is called.
    """
    body = F.col(text) if chars is None else F.substring(text, 1, chars)
    return df.withColumn(name, detector(profiles)(body))


def filter_language(
    df: DataFrame,
    profiles: DataFrame,
    lang: str = "en",
    chars: int | None = None,
    text: str = "review_text",
) -> DataFrame:
    """Keep reviews in the language and those whose language cannot be told."""
    return (
        detect_language(df, profiles, text, chars, "_lang")
        .filter(F.coalesce(F.col("_lang") == lang, F.lit(True)))
        .drop("_lang")
    )
