"""Each operator against a brute-force version or an exact round trip."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedloom.functions.staging import Stage
from feedloom.llm import exact_dedup, graph, jaccard, langid, licenses, line_dedup, mixing, neighbours, packing, quality, secrets
from feedloom.llm.queries import tokenizer_path

rng = random.Random(3)
WORDS = ["".join(rng.choice("abcdeorstnl") for _ in range(rng.randint(2, 9))) for _ in range(400)]


def prose(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n))


def documents(spark, texts, **extra):
    rows = [(i, t, extra.get("lang", "en"), f"src{i % 7}") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


# --- exact dedup


def test_misra_gries_finds_heavy_digests(spark):
    texts = ["hot"] * 300 + [f"cold {i}" for i in range(700)]
    digests = documents(spark, texts).select("doc_id", F.sha2("text", 256).cast("binary").alias("digest"))
    top = exact_dedup.frequent_groups(digests, counters=8).collect()
    assert [r["group_size"] for r in top] == [300] and top[0]["keep_id"] == 299


def test_shrink_keeps_lower_bounds():
    counts = exact_dedup.shrink(Counter(a=9, b=4, c=3, d=1), 2)
    assert counts == Counter(a=6, b=1)


def test_result_does_not_depend_on_counters(spark):
    docs = documents(spark, [rng.choice("abcdefg") for _ in range(200)])
    results = [sorted(exact_dedup.exact_groups(docs, counters=k).collect()) for k in (1, 3, 1024)]
    assert results[0] == results[1] == results[2]


# --- secrets


def test_base_spans():
    text = 'Password = "abcdef" token: ab AKIA' + "A1" * 10 + " x" + "0a" * 12 + " secret:token:abcdefg"
    base, _ = secrets.scan_text(text)
    assert [(secrets.KINDS[k], text[a:b]) for k, a, b in base] == [
        ("assign", 'Password = "abcdef'), ("access", "AKIA" + "A1" * 10), ("hex", "0a" * 12),
    ]


def test_random_tokens_are_told_from_words(spark):
    r = np.random.default_rng(5)
    alphabet = np.array(list(secrets.ENCODINGS[6]))
    planted = ["".join(r.choice(alphabet, 44)) for _ in range(40)]
    planted = [p for p in planted if any(c.isdigit() for c in p) and "/" not in p and "+" not in p] or planted
    words = [f"{prose(random.Random(i), 60)} the{WORDS[i]}2and{WORDS[i + 1]}{WORDS[i + 2]}{WORDS[i + 3]}{WORDS[i + 4]}" for i in range(300)]
    texts = [f"{w} {planted[i]} end" if i < len(planted) else w for i, w in enumerate(words)]
    rows = secrets.scan_secrets(documents(spark, texts)).collect()
    hit = {r["doc_id"] for r in rows if r["n_random"]}
    secret = set(range(len(planted)))
    assert len(hit & secret) >= 0.9 * len(planted) and len(hit - secret) <= 3
    plain = next(r for r in rows if r["doc_id"] == 299)
    assert plain["base_sha256"] == hashlib.sha256(b"").hexdigest() and plain["spans"] == ""


def test_short_secrets_of_every_encoding_are_found(spark):
    r, g = random.Random(8), np.random.default_rng(8)
    names = lambda: r.choice([
        f"{r.choice(WORDS)}_{r.choice(WORDS)}_{r.choice(WORDS)}_{r.choice(WORDS)}_v{r.randint(1, 9)}_{r.choice(WORDS)}",
        "".join(r.choice(WORDS).capitalize() for _ in range(5)) + str(r.randint(1, 99)),
        "".join(r.choice(WORDS).upper() for _ in range(5)) + str(r.randint(1, 99)),
    ])
    # Base62, base36 and base32.
    planted = [
        (size, k, "".join(g.choice(list(secrets.ENCODINGS[k]), size))) for k in (5, 3, 2) for size in (20, 24, 32) for _ in range(40)
    ]
    planted = [p for p in planted if any(c.isdigit() for c in p[2])]
    texts = [f"{prose(r, 40)} {t} {prose(r, 20)}" for _, _, t in planted]
    texts += [f"{prose(r, 40)} {names()} {names()} {prose(r, 20)}" for _ in range(700)]
    rows = secrets.scan_secrets(documents(spark, texts)).collect()
    hit = {x["doc_id"] for x in rows if x["n_random"]}
    for kind in {p[:2] for p in planted}:
        of_kind = [i for i, p in enumerate(planted) if p[:2] == kind]
        assert sum(i in hit for i in of_kind) >= 0.85 * len(of_kind)
    assert sum(i >= len(planted) for i in hit) <= 0.02 * len(hit)


def test_secrets_in_paths_are_found(spark):
    r, g = random.Random(4), np.random.default_rng(4)
    key = lambda k, n: "".join(g.choice(list(secrets.ENCODINGS[k]), n))
    around = [
        ("hooks/services/T00-app/", "", 5), ("my-bucket/", "", 5), ("/var/lib/app_data/tok/", "", 5), ("my_files/of/a-user/", "/end", 7),
        ("services/hooks/", "", 5), ("a/path/of/some/words/and/more/of/these/", "/rest/of/it", 5), ("app-data_", "", 6),
    ]
    planted = [(a, key(k, 32) + "7Q", b) for a, b, k in around for _ in range(10)]
    texts = [f"{prose(r, 40)} {a}{t}{b} {prose(r, 20)}" for a, t, b in planted]
    texts += [f"{prose(r, 40)} /{r.choice(WORDS)}/{r.choice(WORDS)}_{r.choice(WORDS)}-{r.randint(1, 99)}/{prose(r, 3).replace(' ', '_')}_7" for _ in range(300)]
    rows = {x["doc_id"]: x for x in secrets.scan_secrets(documents(spark, texts)).collect()}
    covered = []
    for i, (_, t, _) in enumerate(planted):
        at = texts[i].index(t)
        spans = [tuple(map(int, s.split(":")[1:])) for s in rows[i]["spans"].split(",") if s]
        assert all(y <= a for (_, y), (a, _) in zip(spans, spans[1:], strict=False))
        covered.append(any(a < at + len(t) and at < b and min(b, at + len(t)) - max(a, at) >= 20 for a, b in spans))
    for k in range(len(around)):
        assert sum(covered[10 * k : 10 * k + 10]) >= 7
    assert sum(x["n_random"] > 0 for i, x in rows.items() if i >= len(planted)) <= 2


def test_the_strongest_of_overlapping_spans_is_reported():
    assert secrets.apart([(3.0, 0, 60), (9.0, 30, 60), (3.0, 60, 90), (9.0, 100, 130), (9.0, 100, 140)]) == [
        (30, 60), (60, 90), (100, 140),
    ]


def test_threshold_bounds_the_false_share():
    assert secrets.threshold({}, 0.05, 0.01) == float("inf")
    assert secrets.threshold({0: 99, 100: 1}, 0.05, 0.01) == 5.0
    assert secrets.threshold({0: 999_999, 100: 1}, 0.05, 0.01) == float("inf")


# --- licenses


@pytest.mark.parametrize(
    "line, labels, freedom",
    [
        ("mit", {"mit"}, 0.9),
        ("mit or gpl-3.0-only", {"mit", "gpl-3"}, 0.9),
        ("mit and gpl-3.0+", {"mit", "gpl-3"}, 0.4),
        ("(mit or gpl-2.0) and mpl-2.0", {"mit", "gpl-2", "mpl-2"}, 0.6),
        ("mit or gpl-2.0 and mpl-2.0", {"mit", "gpl-2", "mpl-2"}, 0.9),
        ("gpl-2.0 with classpath-exception-2.0", {"gpl-2"}, 0.6),
        ("mit or later versions", {"mit"}, 0.9),
        ("mit and foo-1.0", {"mit", "unknown"}, 0.0),
        ("(mit or gpl-2.0) and proprietary", {"mit", "gpl-2", "unknown"}, 0.0),
        ("mit or foo-1.0 and bar", {"mit"}, 0.9),
        ("(mit and foo) or isc", {"mit", "unknown", "isc"}, 0.9),
        ("foo with bar or isc", {"isc"}, 0.9),
        ("gpl-2.0 with mit", {"gpl-2", "mit", "unknown"}, 0.0),
        ("(mit and foo) with bar", {"mit", "unknown"}, 0.0),
        ("mit and", {"mit"}, 0.9),
    ],
)
def test_expressions(line, labels, freedom):
    _, found, value = licenses.expression_at(line)
    assert found == labels and abs(value - freedom) < 1e-9


@pytest.mark.parametrize("line", ["", "unheard-of", "and mit", "( mit", "mit )x("])
def test_no_expression(line):
    found = licenses.expression_at(line)
    assert found is None or found[1] == {"mit"}


def brute_value(line, identifiers):
    """The expression by recursive descent: (labels, freedom), None if unknown."""
    pieces = licenses.PIECE.findall(line)

    def operand():
        if pieces[0] == "(":
            pieces.pop(0)
            value = either()
            pieces.pop(0)
            return value
        label = identifiers.get(re.sub(r"(-only|-or-later|\+)$", "", pieces.pop(0)))
        return ({label}, licenses.FREEDOM[label]) if label else None

    def granted():
        value = operand()
        while pieces and pieces[0] == "with":
            pieces.pop(0)
            exception = operand()
            if exception:
                value = (exception[0] | (value[0] if value else set()) | {"unknown"}, 0.0)
            elif value and 0 < value[1] < 0.8:
                value = (value[0], min(1.0, value[1] + licenses.EXCEPTION_BONUS))
        return value

    def both():
        value = granted()
        while pieces and pieces[0] == "and":
            pieces.pop(0)
            other = granted()
            if value and other:
                value = (value[0] | other[0], min(value[1], other[1]))
            elif value or other:
                value = ((value or other)[0] | {"unknown"}, 0.0)
        return value

    def either():
        value = both()
        while pieces and pieces[0] == "or":
            pieces.pop(0)
            other = both()
            value = (value[0] | other[0], max(value[1], other[1])) if value and other else value or other
        return value

    return either()


def test_random_expressions_against_descent():
    r = random.Random(4)
    names = ["mit", "gpl-2.0-only", "cc-by-4.0", "apache-2.0+", "unheard-of", "x-1"]

    def line(depth):
        if depth == 0 or r.random() < 0.3:
            return r.choice(names)
        inner = f"{line(depth - 1)} {r.choice(['or', 'and', 'with'])} {line(depth - 1)}"
        return f"({inner})" if r.random() < 0.5 else inner

    for _ in range(400):
        text = line(3)
        want, got = brute_value(text, licenses.IDENTIFIERS), licenses.expression_at(text)
        assert (got is None) == (want is None), text
        if got:
            assert got[1] == want[0] and abs(got[2] - want[1]) < 1e-9, text


def test_identifiers_are_a_parameter():
    got = licenses.scan_text("License: foo-1.0", {"foo-1.0": "mit"})
    assert got["labels"] == "mit" and licenses.scan_text("License: mit", {})["labels"] == ""


def test_license_places_against_brute_force():
    r = random.Random(1)
    pieces = ["under the MIT License.", "Apache License, Version 2.0", "CC BY-NC", "mit", "under", "the", "é", "license"]
    for _ in range(200):
        text = " ".join(r.choice(pieces) for _ in range(r.randint(0, 12)))
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        places = [
            i for i in range(len(words)) for p in licenses.BASE_PHRASES if words[i : i + len(p.split())] == p.split()
        ]
        got = licenses.scan_text(text)
        assert (got["n_words"], got["n_base"]) == (len(words), len(places))
        assert (got["first_word"], got["last_word"]) == (min(places, default=None), max(places, default=None))


def test_tag_is_read():
    got = licenses.scan_text("// SPDX-License-Identifier: (MIT OR Apache-2.0) \ncode")
    assert got["labels"] == "apache-2,mit" and got["score"] > 0.8 and got["expressions"] == ["( mit or apache-2.0 )"]


# --- line dedup


def brute_lines(texts, min_words):
    """Kept line numbers per text: a line goes if a run around it of min_words occurs earlier."""
    lines = [[(i, line.strip()) for i, line in enumerate(t.split("\n")) if line.split()] for t in texts]
    seen, gone = set(), [set() for _ in texts]
    for d, own in enumerate(lines):
        for a in range(len(own)):
            for b in range(a, len(own)):
                run = tuple(x for _, x in own[a : b + 1])
                if sum(len(x.split()) for x in run) >= min_words:
                    if run in seen:
                        gone[d] |= set(range(own[a][0], own[b][0] + 1))
                    seen.add(run)
    return [[i for i in range(len(t.split("\n"))) if i not in gone[d]] for d, t in enumerate(texts)]


def test_lines_against_brute_force(spark):
    r = random.Random(11)
    common = [prose(r, r.randint(1, 6)) for _ in range(6)]
    texts = []
    for _ in range(120):
        texts.append("\n".join(r.choice([*common, "", prose(r, 3)]) for _ in range(r.randint(1, 9))))
    done = line_dedup.dedup_lines(documents(spark, texts), min_words=7).select("row.doc_id", "row.text").collect()
    expected = brute_lines(texts, 7)
    for row in done:
        lines = texts[row["doc_id"]].split("\n")
        assert row["text"] == "\n".join(lines[i] for i in expected[row["doc_id"]]), row["doc_id"]


# --- Jaccard join


def brute_components(texts):
    sets = []
    for t in texts:
        w = re.findall("[^\x20\x09-\x0d]+", t or "")
        sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1)))})
    top = list(range(len(texts)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


def near_copies(r, n, chains=True):
    base = prose(r, 70).split()
    out = [" ".join(base)]
    for _ in range(n - 1):
        if chains and r.random() < 0.5:
            base = out[-1].split()
        changed = list(base)
        for _ in range(r.randint(0, 3)):
            changed[r.randrange(len(changed))] = r.choice(WORDS)
        out.append(" ".join(changed))
    return out


@pytest.mark.parametrize("settings", [{}, {"ROUNDS": 0}, {"ROUNDS": 0, "LEAF": 4, "FANOUT": 2, "SMALLEST": 2}, {"COMMON": 2, "FREQUENT": 300}, {"ROUNDS": 0, "LISTED": 3}])
def test_components_against_brute_force(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(jaccard, name, value)
    r = random.Random(7)
    texts = [t for size in (1, 2, 30, 45) for t in near_copies(r, size)]
    passage = prose(r, 25)
    texts += [f"{prose(r, r.randint(4, 12))} {passage}" for _ in range(40)] + ["", "one", "one", "two words", "a b c d e"]
    r.shuffle(texts)
    expected, sizes = brute_components(texts)
    got = {x["doc_id"]: x for x in jaccard.jaccard_components(documents(spark, texts)).collect()}
    assert [got[i]["component_id"] for i in range(len(texts))] == expected
    assert [got[i]["n_shingles"] for i in range(len(texts))] == sizes


def test_components_of_links(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(50)] + [(r.randrange(100, 160), r.randrange(100, 160)) for _ in range(40)]
    found = graph.components(Stage(spark, "test"), spark.createDataFrame(edges, "u long, v long")).collect()
    top = {n: n for e in edges for n in e}
    for _ in range(200):
        for u, v in edges:
            top[u] = top[v] = min(top[u], top[v])
    linked = {n for e in edges if e[0] != e[1] for n in e}
    assert {r["node"]: r["component"] for r in found} == {n: top[n] for n in linked}


# --- packing


def test_plan_is_complete_and_tight():
    r = np.random.default_rng(1)
    for n in (0, 1, 7, 2000):
        lengths = np.minimum(r.lognormal(6, 1.2, n).astype(int) + 1, packing.CAPACITY)
        counts = np.bincount(lengths, minlength=packing.CAPACITY + 1)
        used = defaultdict(list)
        for length, table in packing.plan(counts).items():
            ends = [*table[1:, 0], counts[length]]
            assert table[0, 0] == 0
            for (rank, sequence, offset), end in zip(table, ends, strict=True):
                for k in range(end - rank):
                    used[sequence + k].append((offset, length))
        assert sum(map(len, used.values())) == n
        for items in used.values():
            at = 0
            for offset, length in sorted(items):
                assert offset == at
                at += length
            assert at <= packing.CAPACITY
        if n == 2000:
            assert len(used) <= 1.01 * -(-int(lengths.sum()) // packing.CAPACITY) + 1


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(tokenizer_path())
    r = random.Random(4)
    texts = [prose(r, r.randint(0, 900)) for _ in range(40)] + ["漢字 \x07 <|endoftext|> x", "naïve  \n\n\t tab", "", prose(r, 5000)]
    rows = packing.pack_documents(documents(spark, texts), tokenizer_path(), keep_ids=True).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for row in rows:
        by_doc[row["doc_id"]].append(row)
        by_sequence[row["sequence_id"]].append((row["offset"], row["length"]))
        assert row["ids_crc32"] == zlib.crc32(np.array(row["ids"], "<u4").tobytes())
    for i, text in enumerate(texts):
        own = sorted(by_doc[i], key=lambda x: x["piece"])
        assert [t for x in own for t in x["ids"]] == [*full.encode(text, add_special_tokens=False).ids, 0]
        assert [x["start"] for x in own] == list(np.cumsum([0] + [x["length"] for x in own])[:-1])
        assert all(x["length"] == packing.CAPACITY for x in own[1:])
    for items in by_sequence.values():
        ends = [0] + [a + n for a, n in sorted(items)]
        assert [a for a, _ in sorted(items)] == ends[:-1] and ends[-1] <= packing.CAPACITY


# --- nearest neighbours


def test_ties_beyond_the_rough_choice_go_to_the_smaller_ids():
    x = np.eye(50)[1:] + np.eye(50)[0]
    ids = np.random.default_rng(2).permutation(len(x))
    vectors = pa.table({"vec_id": pa.array(ids, pa.int64()), "vector": pa.array(x.tolist())})
    queries = pa.table({"query": pa.array([b"q"], pa.binary()), "wanted": pa.array([np.eye(50)[0].tolist()])})
    found = neighbours.search(queries, vectors, x[:4], 3)
    assert found["vec_id"].to_pylist() == [0, 1, 2]


def test_neighbours_against_brute_force(spark):
    r = np.random.default_rng(9)
    x = r.normal(size=(1200, 16)).astype(np.float32)
    x[100:160] = x[100]  # one vector many times
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    rows += [(5000, None), (5020, [0.0] * 16), (5040, [float("nan")] * 16), (None, [1.0] * 16), (5060, [1.0]), (5080, [None] + [1.0] * 15)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for row in neighbours.nearest(df, lambda i: i % 20 == 0).collect():
        got[row["query_id"]].append((row["rank"], row["vec_id"], row["score"]))
    wide = x.astype(np.float64)
    hits = 0
    assert set(got) == set(range(0, 1200, 20))
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        scores = (wide * wide[q]).sum(axis=1)
        scores[q] = -np.inf
        best = np.lexsort((np.arange(1200), -scores))[:20]
        assert all(abs(scores[v] - s) < 1e-12 for _, v, s in found)
        hits += len(set(best) & {f[1] for f in found})
    assert hits >= 0.9 * 20 * len(got)
    assert [v for _, v, _ in got[100]] == list(range(101, 121))


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.0, 1.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert neighbours.nearest(df, lambda i: i % 20 == 0).count() == 4
    assert neighbours.nearest(df.limit(0), lambda i: i % 20 == 0).count() == 0


def test_footrule():
    file = neighbours.inverted_file(np.array([[0, 1, 2], [2, 1, 0], [3, 4, 5]]), 6)
    assert neighbours.footrule(np.array([0, 1, 2]), file).tolist() == [0, 4, 12]


# --- mixing


def brute_share(budget, children):
    """Water-filling step by step: [(weight, cap)] to budgets."""
    got, open_, left = [0.0] * len(children), set(range(len(children))), float(budget)
    while open_ and left > 1e-9:
        total = sum(children[i][0] for i in open_)
        full = [i for i in open_ if got[i] + left * children[i][0] / total >= children[i][1] - 1e-9]
        if not full:
            for i in open_:
                got[i] += left * children[i][0] / total
            break
        full = sorted(full, key=lambda i: (children[i][1] - got[i]) / children[i][0])[:1]
        step = (children[full[0]][1] - got[full[0]]) / children[full[0]][0]
        for i in open_:
            got[i] += step * children[i][0]
        left = budget - sum(got)
        open_ -= set(full)
    return got


def test_shares_against_water_filling(spark):
    r = random.Random(6)
    for _ in range(5):
        children = [(r.randint(1, 9), r.randint(0, 500)) for _ in range(8)]
        budget = r.randint(0, 2500)
        df = spark.createDataFrame([("p", f"c{i}", w, c, budget) for i, (w, c) in enumerate(children)], "p string, k string, weight long, cap long, budget long")
        got = {x["k"]: x["budget"] for x in mixing.share(df, ["p"], "k").collect()}
        for i, expected in enumerate(brute_share(budget, children)):
            assert expected - 1 - 1e-6 <= got[f"c{i}"] <= expected + 1e-6


def test_mix_takes_prefixes_of_epochs(spark):
    r = random.Random(8)
    docs = documents(spark, [prose(r, r.randint(1, 40)) for _ in range(300)])
    chosen = mixing.mix(docs, {"source": {"src0": 20}}, F.lit("all"), portion=(1, 2), epochs=3).collect()
    leaves = defaultdict(list)
    for x in chosen:
        leaves[x["source"], x["epoch"]].append((x["start"], x["tokens"]))
    for items in leaves.values():
        items.sort()
        at = 0
        for start, tokens in items:
            assert start == at
            at += tokens
    assert max(e for _, e in leaves) >= 1  # src0 is short of text and read again
    total = docs.select(F.sum(mixing.n_words(F.col("text")))).first()[0]
    taken = sum(x["tokens"] for x in chosen)
    assert total // 2 - 7 <= taken <= total // 2 + 7 * 40


# --- classifiers


def test_quality_tells_junk(spark):
    r = random.Random(12)
    texts = [prose(r, 60) if i % 3 else " ".join(f"{r.choice(WORDS)}%%%" for _ in range(60)) for i in range(300)]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(300)], "doc_id long, quality int")
    scored = quality.score_quality(docs, quality.train(docs, labels)).collect()
    kept_out = [x for x in scored if x["held_out"]]
    assert kept_out and all(x["held_out"] == (zlib.crc32(str(x["doc_id"]).encode()) % 3 == 1) for x in scored)
    assert np.mean([x["predicted"] == int(x["doc_id"] % 3 > 0) for x in kept_out]) > 0.97


def test_languages_are_told(spark):
    r = random.Random(13)
    kinds = {"aa": "abcdei", "bb": "nopqru", "cc": "stuvwe"}
    rows = [
        (i, " ".join("".join(r.choice(kinds[lang]) for _ in range(5)) for _ in range(20)), lang)
        for i, lang in enumerate(r.choice(list(kinds)) for _ in range(300))
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    told = langid.identify(docs, model).filter("held_out").collect()
    assert np.mean([x["lang_pred"] == rows[x["doc_id"]][2] for x in told]) > 0.97
    assert (model.weights == 0).mean() > 0.9  # sparse
