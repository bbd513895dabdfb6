"""Secret scans: fixed patterns, and a battery of randomness tests for other tokens.

A token that is neither of the base kinds is reported when it looks random and ordinary
text does not explain it:

* the encoding is inferred from its characters, which gives the alphabet of its symbols;
* chi-squared uniformity over that alphabet, a runs test and a serial-correlation test
  are combined by Fisher's rule; a token that fails them is no random string;
* its likelihood ratio of evenly spread symbols against ordinary names follows from the
  counts of letter pairs in the whole corpus, outside the tokens under test. In names the
  kind of character (digit, case, sign) changes now and then, and letters follow each other
  as in the text, whatever their case. What is drawn so reaches a ratio of t with a
  probability of at most 1/t, which makes 1/t a p-value. Benjamini-Hochberg control over
  all tokens, with weights in proportion to their lengths, bounds the share of false reports.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.staging import Stage
from feedloom.llm.common import ROWS_AT_ONCE, arrow_schema

# The base kinds in the order in which they are listed, and their patterns.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
ASSIGN_SIZE, ACCESS_SIZE = 6, 20

# Other tokens: runs of these characters, with a digit and a letter among them.
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
TOKEN_SIZE = 20
# Paths and names join words and keys by signs, of which an encoding may hold some itself.
CUTS = (re.compile("[^/+]+"), re.compile("[^_-]+"), re.compile("[^/+_-]+"), re.compile("[^/]+"))

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Encodings from the smallest alphabet to the largest; the first that holds all characters is taken.
ENCODINGS = (
    DIGITS + "abcdef", DIGITS + "ABCDEF", UPPER + "234567", DIGITS + LOWER, DIGITS + UPPER,
    DIGITS + UPPER + LOWER, UPPER + LOWER + DIGITS + "+/", UPPER + LOWER + DIGITS + "-_",
)

# Places of the letters, whatever their case, and of all other characters; by code point up to 128.
OTHER = len(LOWER)
PLACE = np.full(129, OTHER, np.int64)
PLACE[[ord(c) for c in LOWER + UPPER]] = [*range(OTHER)] * 2
SIGNS = "+/-_"
# How often the kind of character changes in ordinary names, and how much single shares and
# even ones weigh beside the pairs.
CHANGE, SINGLE, EVEN = 0.25, 0.2, 0.1

# A random string fails the battery with this probability.
BATTERY_LEVEL = 0.001
# Share of false reports among the tokens reported.
FALSE_SHARE = 0.01
# Steps in which -log10 of the weighted p-values is counted.
STEP = 0.05
STEPS = 6000

FOUND = (
    "doc_id long, n_assign long, n_access long, n_hex long, base array<struct<kind:int,start:int,end:int>>, "
    "tokens array<struct<start:int,end:int,encoding:int,body:string>>, pairs array<long>"
)
RESULT = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"
)


def upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def chi2_tail(x: float, df: int) -> float:
    """P(X >= x) of the chi-squared distribution, by the cube-root normal approximation."""
    if x <= 0:
        return 1.0
    spread = 2 / (9 * df)
    return upper_tail(((x / df) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))


def battery(symbols: np.ndarray, k: int) -> float:
    """Combined p-value of the symbols being random over 0..k-1."""
    n = len(symbols)
    counts = np.bincount(symbols, minlength=k).astype(float)
    chi2 = float(k / n * (counts**2).sum() - n)
    uniform = chi2_tail(chi2, k - 1)
    high = symbols * 2 >= k
    n1 = int(high.sum())
    n0 = n - n1
    runs = 1 + int((high[1:] != high[:-1]).sum())
    expected = 2 * n0 * n1 / n + 1
    variance = (expected - 1) * (expected - 2) / (n - 1)
    p_runs = math.erfc(abs(runs - expected) / math.sqrt(2 * variance)) if variance > 0 else 0.5**n
    centred = symbols - (k - 1) / 2
    r = float((centred[1:] * centred[:-1]).sum()) / ((n - 1) * (k * k - 1) / 12)
    p_serial = math.erfc(abs(r) * math.sqrt(n - 1) / math.sqrt(2))
    half = -sum(math.log(max(p, 1e-300)) for p in (uniform, p_runs, p_serial))
    return math.exp(-half) * (1 + half + half * half / 2)


def encoding_of(token: str) -> int | None:
    characters = set(token)
    return next((i for i, alphabet in enumerate(ENCODINGS) if characters <= set(alphabet)), None)


def pair_counts(text: str, left_out: list[tuple[int, int]]) -> np.ndarray:
    """Counts of the pairs of places in a text; what lies in the spans left out counts as other."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    places = PLACE[np.minimum(codes, 128)]
    for start, end in left_out:
        places[start:end] = OTHER
    return np.bincount(places[:-1] * (OTHER + 1) + places[1:], minlength=(OTHER + 1) ** 2)


def ordinary_chances(pairs: np.ndarray) -> np.ndarray:
    """P(letter | place before) in ordinary text, a row per place."""
    counts = pairs.reshape(OTHER + 1, OTHER + 1)[:, :OTHER].astype(float)
    single = counts.sum(axis=0) + 1
    single /= single.sum()
    after = counts + single
    return (1 - SINGLE - EVEN) * after / after.sum(axis=1, keepdims=True) + SINGLE * single + EVEN / OTHER


def ordinary_log10(body: str, encoding: int, chances: np.ndarray) -> float:
    """-log10 of the bound on the probability that an ordinary name looks as random as this."""
    alphabet = ENCODINGS[encoding]
    kinds = [k for k in (set(part) & set(alphabet) for part in (DIGITS, LOWER, UPPER, SIGNS)) if k]
    ratio, last, before = 0.0, None, OTHER
    for c in body:
        kind = next(k for k in kinds if c in k)
        if last is None:
            ordinary = 1 / len(kinds)
        else:
            ordinary = 1 - CHANGE if kind is last else CHANGE / (len(kinds) - 1)
        place = PLACE[ord(c)]
        if place == OTHER:
            ordinary /= len(kind)
        else:
            # A capital after a small letter may go on with the word or begin one.
            row = chances[before] if kind is last or last is None else (chances[before] + chances[OTHER]) / 2
            ordinary *= row[place] / row[PLACE[[ord(x) for x in kind]]].sum()
        ratio -= math.log10(ordinary * len(alphabet))
        last, before = kind, place
    return ratio


def pieces(run: str) -> set[tuple[int, int]]:
    """Spans of a run to test: the whole, and its parts between the signs of each set in CUTS."""
    spans = {(0, len(run))}
    for cut in CUTS:
        spans |= {m.span() for m in cut.finditer(run)}
    return {(a, b) for a, b in spans if len(run[a:b].rstrip("=")) >= TOKEN_SIZE}


def scan_text(text: str) -> tuple[list[tuple[int, int, int]], list[dict]]:
    """Base spans (kind, start, end) and the other tokens that pass the battery; some may overlap."""
    base = [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_SIZE]
    base += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_SIZE]
    base += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    tokens = []
    for m in TOKEN.finditer(text):
        for a, b in sorted(pieces(m.group())):
            body = m.group()[a:b].rstrip("=")
            a, b = a + m.start(), b + m.start()
            if not any(c in DIGITS for c in body) or body.isdigit():
                continue
            if any(start < b and a < end for _, start, end in base):
                continue
            encoding = encoding_of(body)
            if encoding is None:
                continue
            alphabet = ENCODINGS[encoding]
            if battery(np.array([alphabet.index(c) for c in body]), len(alphabet)) >= BATTERY_LEVEL:
                tokens.append({"start": a, "end": b, "encoding": encoding, "body": body})
    return sorted(base, key=lambda s: (s[1], s[0], s[2])), tokens


def apart(found: list[tuple[float, int, int]]) -> list[tuple[int, int]]:
    """Of spans (strength, start, end) that overlap, the strongest, and of equal ones the longest; in order."""
    kept: list[tuple[int, int]] = []
    for _, a, b in sorted(found, key=lambda s: (-s[0], s[1] - s[2], s[1])):
        at = bisect.bisect(kept, (a, b))
        if (at == 0 or kept[at - 1][1] <= a) and (at == len(kept) or b <= kept[at][0]):
            kept.insert(at, (a, b))
    return kept


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One pass over the texts; `pairs` are the counts of a task's rows, on one of them."""
    kinds = T._parse_datatype_string(FOUND)
    kinds["doc_id"].dataType = docs.schema[id_col].dataType

    def run(batches):
        out = arrow_schema(kinds)
        rows, counts = [], np.zeros((OTHER + 1) ** 2, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=out)
                rows = []
                for r in batch.slice(at, ROWS_AT_ONCE).to_pylist():
                    text = r["text"] or ""
                    base, tokens = scan_text(text)
                    counts += pair_counts(text, [s[1:] for s in base] + [(t["start"], t["end"]) for t in tokens])
                    n = [sum(k == kind for kind, _, _ in base) for k in range(3)]
                    rows.append(
                        {
                            "doc_id": r["doc_id"], "n_assign": n[0], "n_access": n[1], "n_hex": n[2],
                            "base": [{"kind": k, "start": a, "end": b} for k, a, b in base],
                            "tokens": tokens, "pairs": None,
                        }
                    )
        if rows:
            rows[0]["pairs"] = counts.tolist()
            yield pa.RecordBatch.from_pylist(rows, schema=out)

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, kinds)


def threshold(bins: dict[int, int], step: float, level: float) -> float:
    """Benjamini-Hochberg over counted p-values: the smallest -log10(p) that is reported.

    A bin counts as its largest p-value, so the control holds in spite of the binning.
    """
    total, seen, best = sum(bins.values()), 0, math.inf
    for at in sorted(bins, reverse=True):
        seen += bins[at]
        if 10 ** (-at * step) * total <= level * seen:
            best = at * step
    return best


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", false_share: float = FALSE_SHARE
) -> DataFrame:
    """Secrets of every row: counts per base kind, their digest, and all spans.

    Spans are kind:start:end in code points, the end exclusive, by start and then kind;
    base_sha256 is the digest of the base spans alone. A null text counts as empty and has
    none. Runs joined by signs are tested whole and in parts; of spans that overlap the one
    that stands out most is reported. Rows that share an id are scanned each for itself. The counts of pairs and the
    p-values that set the limit come from all rows; what reaches the driver is one array
    of 729 counts and at most 6,001 bins, whatever the size. Other columns are not looked at.
    """
    stage = Stage(docs.sparkSession, "secrets")
    found = stage.write(scan(docs, id_col, text_col))
    per_pair = found.select(F.posexplode("pairs").alias("pair", "n")).groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = np.zeros((OTHER + 1) ** 2, np.int64)
    for row in per_pair.collect():
        pairs[row["pair"]] = row["n"]
    chances = ordinary_chances(pairs)
    size = F.char_length("token.body")
    sizes = found.select(F.explode("tokens").alias("token")).agg(F.avg(size)).first()[0] or 1.0

    def strength(token: dict) -> float:
        own = ordinary_log10(token["body"], token["encoding"], chances)
        return max(0.0, own - math.log10(sizes / len(token["body"])))

    def bins(batches):
        for batch in batches:
            at = [min(STEPS, int(strength(t) / STEP)) for row in batch.column(0).to_pylist() for t in row]
            yield pa.RecordBatch.from_pydict({"bin": pa.array(at, pa.int32())})

    tokens = found.filter(F.size("tokens") > 0).select("tokens")
    counted = tokens.mapInArrow(bins, "bin int").groupBy("bin").count().collect()
    limit = threshold({r["bin"]: r["count"] for r in counted}, STEP, false_share)

    kinds = T._parse_datatype_string(RESULT)
    kinds["doc_id"].dataType = found.schema["doc_id"].dataType

    def report(batches):
        out = arrow_schema(kinds)
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                base = [(s["kind"], s["start"], s["end"]) for s in r["base"]]
                weighed = [(strength(t), t["start"], t["end"]) for t in r["tokens"]]
                random = [(3, a, b) for a, b in apart([w for w in weighed if w[0] >= limit])]
                rows.append(
                    {
                        **{c: r[c] for c in ("doc_id", "n_assign", "n_access", "n_hex")},
                        "base_sha256": hashlib.sha256(written(base).encode()).hexdigest(),
                        "spans": written(sorted(base + random, key=lambda s: (s[1], s[0], s[2]))),
                        "n_random": len(random),
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema=out)

    return found.drop("pairs").mapInArrow(report, kinds)
