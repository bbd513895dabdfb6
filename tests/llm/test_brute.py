"""Scalar versions of the operators that SQL cannot express, on small data."""

import hashlib
import math
import random

import numpy as np
import pytest

from feedloom.llm import langid, quality, secrets

SF = "/root/testdata/sf0.001"


# --- secret scan: the base findings by a scan of its own


def brute_base(text):
    found = []
    at = 0
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    value = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
    names = ("password", "passwd", "secret", "token", "apikey", "api_key")
    while at < len(text):
        end = None
        for name in names:
            if not lowered.startswith(name, at):
                continue
            i = at + len(name)
            i += i < len(text) and text[i] in "\"'"
            while i < len(text) and text[i] == " ":
                i += 1
            if i >= len(text) or text[i] not in ":=":
                continue
            i += 1
            while i < len(text) and text[i] == " ":
                i += 1
            i += i < len(text) and text[i] in "\"'"
            first = i
            while i < len(text) and text[i] in value:
                i += 1
            if i > first:
                end = i
                if i - first >= 6:
                    found.append((0, at, i))
                break
        at = end if end else at + 1
    for kind, head, letters, least in ((1, "AKIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 20), (2, "", "0123456789abcdef", 24)):
        at = 0
        while at < len(text):
            i = at + len(head)
            if not text.startswith(head, at) or i >= len(text) or text[i] not in letters:
                at += 1
                continue
            while i < len(text) and text[i] in letters:
                i += 1
            if i - at >= least:
                found.append((kind, at, i))
            at = i
    return sorted(found, key=lambda f: (f[1], f[0]))


def random_texts(n):
    r = random.Random(12)
    parts = ["password", "PASSWD", "Secret", "token", "api_key", "ApiKey", "=", ":", " ", "  ", '"', "'", "\n", "AKIA", "A1B2C3", "0123456789ab", "cdef01", "é", "\U0001f600", "x-y_z", "=="]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 25))) for _ in range(n)]


def test_base_findings_against_a_plain_scan(spark):
    texts = random_texts(600) + [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in secrets.scan_secrets(docs).collect()}
    names = ("assign", "access", "hex")
    for i, text in enumerate(texts):
        base = brute_base(text or "")
        spans = [f"{names[k]}:{a}:{b}" for k, a, b in base]
        assert [rows[i][f"n_{name}"] for name in names] == [sum(k == n for k, _, _ in base) for n in range(3)], text
        assert rows[i]["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(rows[i]["spans"].split(",")) | {""}


# --- quality classifier


def test_ratios_and_descent_against_scalars():
    r = random.Random(2)
    rows = [np.array(sorted(r.sample(range(12), r.randint(1, 6))), np.int32) for _ in range(40)]
    labels = np.array([int(3 in row or r.random() < 0.2) for row in rows])
    counts = [[1.0] * (1 << quality.BITS) for _ in range(2)]
    for row, label in zip(rows, labels):
        for k in row:
            counts[label][k] += 1
    shares = [[c / sum(side) for c in side[:12]] for side in counts]
    ratios = quality.log_count_ratios(rows, labels)
    assert np.allclose(ratios[:12], [math.log(b / a) for a, b in zip(*shares)])

    # The optimum of the dual problem: the gap between primal and dual closes.
    weights = quality.descend(rows, labels, ratios)
    vectors = [{int(k): ratios[k] / math.sqrt(sum(ratios[j] ** 2 for j in row)) for k in row} for row in rows]
    signs = [1 if label else -1 for label in labels]
    cost = [quality.COST * 0.5 / max(np.mean(labels == label), 1e-9) for label in labels]

    def primal(w):
        loss = sum(c * max(0, 1 - s * (sum(w[k] * x for k, x in v.items()) + w[-1])) for c, s, v in zip(cost, signs, vectors))
        return 0.5 * sum(x * x for x in w) + loss

    best = primal(weights)
    for _ in range(300):
        step = np.zeros_like(weights)
        step[[*range(12), -1]] = np.array([r.gauss(0, 0.05) for _ in range(13)])
        assert primal(weights + step) >= best - 0.02 * abs(best)


def test_score_of_one_half_is_predicted_good(spark):
    model = quality.Model([], np.array([]))
    docs = spark.createDataFrame([(1, "a"), (None, None)], "doc_id long, text string")
    rows = quality.score_quality(docs, model).collect()
    assert [(r["score"], r["predicted"]) for r in rows] == [(0.5, 1), (0.5, 1)]


def labelled(n):
    words = {0: "bad worse worst awful", 1: "good better best fine"}
    r = random.Random(4)
    rows = [(i, " ".join(r.choice(words[i % 2].split()) for _ in range(8)), "en" if i % 2 else "de") for i in range(n)]
    return rows, [(i, i % 2) for i in range(n)]


def test_a_repeated_id_counts_once(spark, monkeypatch):
    """An id on a third of all rows neither reaches the driver more often nor weighs more."""
    rows, marks = labelled(120)
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    repeated = spark.createDataFrame(rows + [(2, rows[2][1], "de")] * 60, "doc_id long, text string, lang string")
    once = quality.train(plain, spark.createDataFrame(marks, "doc_id long, quality int"), sample=50)
    again = quality.train(repeated, spark.createDataFrame(marks + [(2, 0)] * 60, "doc_id long, quality int"), sample=50)
    assert np.array_equal(once.weights, again.weights) and once.curve == again.curve
    fitted = []
    learn = langid.Model.learn
    monkeypatch.setattr(langid.Model, "learn", lambda self, rows, labels: fitted.append(len(rows)) or learn(self, rows, labels))
    langid.train(plain, sample=40)
    langid.train(repeated, sample=40)
    assert fitted[0] == fitted[1] <= 40


# --- language identification


def test_ftrl_step_against_scalars():
    model = langid.Model(["a", "b"], np.ones(3))
    model.learn([(np.array([0, 3]), np.array([1.0, 1.0]))], np.array([1]))
    z, squares = [[0.0, 0.0], [0.0, 0.0]], [[0.0, 0.0], [0.0, 0.0]]

    def weight(k, c):
        if abs(z[k][c]) <= langid.L1:
            return 0.0
        return -(z[k][c] - math.copysign(langid.L1, z[k][c])) / ((langid.BETA + math.sqrt(squares[k][c])) / langid.ALPHA + langid.L2)

    for _ in range(langid.ROUNDS):
        logits = [sum(weight(k, c) for k in range(2)) for c in range(2)]
        top = max(logits)
        e = [math.exp(x - top) for x in logits]
        error = [e[0] / sum(e), e[1] / sum(e) - 1]
        for k in range(2):
            for c in range(2):
                grown = squares[k][c] + error[c] ** 2
                z[k][c] += error[c] - (math.sqrt(grown) - math.sqrt(squares[k][c])) / langid.ALPHA * weight(k, c)
                squares[k][c] = grown
    want = [[weight(k, c) for c in range(2)] for k in range(2)]
    assert np.allclose(model.weights[[0, 3]], want, atol=1e-6) and not model.weights[[1, 2]].any()


@pytest.mark.parametrize("text", ["²½①", "123 456", "!?…", "", None, "́"])
def test_texts_without_letters_are_undetermined(spark, text):
    rows, _ = labelled(60)
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.predict(text) == ("und", 0.0)
    assert model.predict("good better")[0] == "en"
