"""Spelling variants, shards and periodic runs against brute force, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import periodic, queries, sharding, spelling

SF = "/root/testdata/sf0.001"
LONG = "\n".join(f"line number {i} with a few more words behind it" for i in range(8000))
EDGE = [
    (1, "One line of words that is here."), (2, None), (3, ""), (4, LONG), (5, "One line of words that is here."),
    (5, "One line of words that is here."), (5, "Another text under the same id, here."), (None, "One line of words that is here."),
    (None, None), (6, " \n\t\n "), (7, "éü \U0001f600 漢字 \x00 end"), (8, "la " * 5000), (9, "Àcaçia Àcaçia àcaçia" + "x" * 3000),
]


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t, "clash", 7, None, 1.5, None) for i, t in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, word string, n int, digest string, shard double, runs int")


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# --- periodic runs


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_runs(words, min_words=6, min_periods=4):
    found, n = [], len(words)
    for q in range(1, n // min_periods + 1):
        start = 0
        while start + q < n:
            if words[start] != words[start + q]:
                start += 1
                continue
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            stretch = words[start : end + q]
            if len(stretch) >= max(min_words, min_periods * q):
                if all(any(stretch[i] != stretch[i + d] for i in range(len(stretch) - d)) for d in range(1, q)):
                    found.append((start, len(stretch), q))
            start = end
    return sorted(found)


def brute_planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def brute_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_of_random_words():
    r = random.Random(2)
    for _ in range(1500):
        words = [r.choice([b"a", b"b", b"c"][: r.randint(1, 3)]) for _ in range(r.randint(0, 60))]
        if r.random() < 0.5 and words:
            p = r.randint(1, 9)
            words += [words[i % len(words)] for i in range(p)] * r.randint(2, 6) + words[:3]
        for least, periods in ((6, 4), (1, 2), (10, 3)):
            assert periodic.runs_of(words, least, periods) == brute_runs(words, least, periods)


def test_suffix_neighbours():
    r = random.Random(3)
    for _ in range(200):
        letters = [r.randint(0, 2) for _ in range(r.randint(1, 40))]
        codes = np.unique(letters, return_inverse=True)[1]
        order, lcp = periodic.suffix_neighbours(codes)
        suffixes = sorted(range(len(codes)), key=lambda i: codes[i:].tolist())
        assert order.tolist() == suffixes
        for k, (i, j) in enumerate(zip(suffixes, suffixes[1:])):
            same = 0
            while i + same < len(codes) and j + same < len(codes) and codes[i + same] == codes[j + same]:
                same += 1
            assert lcp[k] == same


def test_runs_query(spark):
    rows = {r["doc_id"]: r for r in queries.op13_periodic_runs(spark, SF).collect()}
    docs = rows_of(documents(spark))
    assert len(rows) == len(docs) and sum(r["n_runs"] > 0 for r in rows.values()) > 10
    for doc_id, text in docs:
        words = brute_planted(doc_id, words_of(text))
        r = rows[doc_id]
        if len(words) > 1500:  # too slow here; the runs of long texts are checked one by one below
            continue
        runs = brute_runs(words)
        assert r["n_runs"] == len(runs) and r["n_words"] == len(words)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(brute_collapsed(words, runs).encode()).hexdigest()
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None, None, None))
        assert (r["start"], r["length"], r["period"]) == best
        assert r["exponent_milli"] == (best[1] * 1000 // best[2] if runs else None)


def test_runs_of_edge_cases(edge):
    found = periodic.find_runs(edge).collect()
    assert len(found) == len(EDGE)
    assert {r["doc_id"]: r["collapsed"] for r in found}[8] == "la"
    by_text = {(r["doc_id"], r["n_words"]): r for r in found}
    assert by_text[(8, 5000)]["runs"][0].asDict() == {"start": 0, "length": 5000, "period": 1}
    assert by_text[(2, 0)]["runs"] == [] and by_text[(3, 0)]["collapsed"] == ""
    assert by_text[(4, 80000)]["runs"] == [] and by_text[(None, 7)]["collapsed"] == "One line of words that is here."
    assert periodic.find_runs(edge.limit(0)).count() == 0


def test_greatest_run(spark):
    runs = [([(0, 8, 2), (1, 9, 2), (3, 18, 4)],), ([],), ([(5, 9, 2)],)]
    df = spark.createDataFrame(runs, "runs array<struct<start:long,length:long,period:long>>")
    best = {r["s"] for r in df.select(periodic.greatest_run(F.col("runs"))["start"].alias("s")).collect()}
    assert best == {1, None, 5}


# --- shards


def test_place_is_the_greedy_choice():
    r = np.random.default_rng(5)
    vectors = r.integers(1, 100, (60, 3)).astype(float)
    vectors[:, 1] = vectors[:, 0] // 5
    capacity = vectors.sum(axis=0) / 7
    shares = [[x / c for x, c in zip(v, capacity)] for v in vectors]
    left = [list(sharding.WEIGHTS) for _ in range(7)]
    expected = {}
    for item in sorted(range(60), key=lambda i: (-max(shares[i]), i)):
        scaled = [s * w for s, w in zip(shares[item], sharding.WEIGHTS)]
        dots = [sum(a * b for a, b in zip(room, scaled)) for room in left]
        expected[item] = max(range(7), key=lambda k: (dots[k], -k))
        left[expected[item]] = [a - b for a, b in zip(left[expected[item]], scaled)]
    assert sharding.place(vectors, 7).tolist() == [expected[i] for i in range(60)]


def brute_sizes(rows):
    return Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)


def check_shards(rows, placed, shards):
    assert Counter((r["doc_id"], r["bytes"], r["crc"]) for r in placed) == brute_sizes(rows)
    slots = defaultdict(list)
    for r in placed:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) <= set(range(shards)) and all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("options", [{}, {"per_shard": 2}, {"bucket_rows": 1}])
def test_shards_of_documents(spark, options):
    docs = documents(spark)
    placed = sharding.assign(docs, shards=5, **options).collect()
    check_shards(rows_of(docs), placed, 5)
    of_text = defaultdict(set)
    for r in placed:
        of_text[r["digest"]].add(r["shard"])
    assert all(len(s) == 1 for s in of_text.values())
    sizes = Counter()
    for r in placed:
        sizes[r["shard"]] += r["bytes"]
    if "per_shard" not in options:
        assert max(sizes.values()) < 1.03 * min(sizes.values())


def test_shards_do_not_depend_on_partitions(spark):
    docs = documents(spark)
    one = sharding.assign(docs, shards=5, bucket_rows=7)
    other = sharding.assign(docs.repartition(7, "source"), shards=5, bucket_rows=7)
    assert sorted(one.collect()) == sorted(other.select(one.columns).collect())


def test_large_groups_are_cut(spark):
    rows = [(i, "the same text") for i in range(400)] + [(1000 + i, f"text number {i} " * (i % 13 + 1)) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    placed = sharding.assign(docs, shards=10).collect()
    check_shards(rows, placed, 10)
    counts = Counter(r["shard"] for r in placed)
    sizes = Counter()
    for r in placed:
        sizes[r["shard"]] += r["bytes"]
    assert max(counts.values()) <= 1.1 * 120 and max(sizes.values()) <= 1.02 * min(sizes.values())


def test_shards_of_edge_cases(edge):
    placed = sharding.assign(edge, shards=4).collect()
    check_shards(EDGE, placed, 4)
    assert len({r["shard"] for r in placed if r["doc_id"] in (2, 3)}) == 1
    assert sharding.assign(edge.limit(0), shards=4).count() == 0


def test_shards_query(spark):
    df = queries.op12_sharding(spark, SF)
    assert df.columns[:7] == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = df.collect()
    assert {r["law"] for r in rows} == {"bytes"} and {r["shard"] for r in rows} == set(range(40))


def test_shards_are_written(spark, tmp_path):
    docs = documents(spark)
    placed = sharding.assign(docs, shards=3)
    sharding.write_shards(spark, docs, placed, str(tmp_path / "out"))
    written = spark.read.parquet(str(tmp_path / "out"))
    assert written.count() == docs.count()
    assert sorted(written.groupBy("shard").count().collect()) == sorted(placed.groupBy("shard").count().collect())


# --- spelling variants


def brute_words(rows, misspell=31):
    counts = Counter()
    for i, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % misspell == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7}


def brute_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def deletions(word):
    return {word[:k] + "\0" + word[k + 1 :] for k in range(len(word))}, {word[:k] + word[k + 1 :] for k in range(len(word))}


def brute_variants(counts, factor=10):
    masks, shorter = defaultdict(set), defaultdict(set)
    for w in counts:
        for m in deletions(w)[0]:
            masks[m].add(w)
        for d in deletions(w)[1]:
            shorter[d].add(w)
    out = {}
    for w, n in counts.items():
        near = set().union(*(masks[m] for m in deletions(w)[0])) | shorter.get(w, set()) | {d for d in deletions(w)[1] if d in counts}
        near.discard(w)
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        out[w] = (best if best and counts[best] >= factor * n else None, len(near))
    return out


def check_variants(rows, counts):
    expected = brute_variants(counts)
    assert len(rows) == len(counts)
    for r in rows:
        form, n_near = expected[r["word"]]
        root = r["word"]
        while expected[root][0]:
            root = expected[root][0]
        assert (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) == (form, root, counts[r["word"]], n_near, counts.get(form))


def test_spelling_query(spark):
    rows = queries.op11_spelling_variants(spark, SF).collect()
    counts = {w: n for w, n in brute_words(rows_of(documents(spark))).items() if n >= 2}
    check_variants(rows, counts)


@pytest.fixture(scope="module")
def vocabulary():
    r = random.Random(6)
    counts = {}
    for _ in range(700):
        word = "".join(r.choice("aeintéß") for _ in range(r.randint(7, 11)))
        counts[word] = r.choice([2, 3, 30, 400, 5000])
        for _ in range(r.randint(0, 3)):
            k = r.randrange(len(word))
            counts[r.choice([word[:k] + word[k + 1 :], word[:k] + "a" + word[k:], word[:k] + "n" + word[k + 1 :]])] = r.choice([2, 40, 600])
    counts["a" * 300], counts["a" * 301], counts["a" * 150 + "b" + "a" * 150] = 3, 50, 700
    return counts


def test_near_by_brute_force(vocabulary):
    words = sorted(vocabulary)[:300]
    assert all(spelling.near(a, b) == brute_near(a, b) for a in words for b in words)


@pytest.mark.parametrize("least_split", [3, 50, 10_000])
def test_variants_do_not_depend_on_the_cells(spark, vocabulary, least_split):
    df = spark.createDataFrame(list(vocabulary.items()), "word string, n long")
    check_variants(spelling.variants(df, least_split=least_split).collect(), vocabulary)


def test_variants_with_other_groups_and_steps(spark, vocabulary, monkeypatch):
    df = spark.createDataFrame(list(vocabulary.items()), "word string, n long").coalesce(1)
    check_variants(spelling.variants(df, groups=("ae", "it"), least_split=20).collect(), vocabulary)


def test_small_blocks_find_the_same(vocabulary, monkeypatch):
    for name in ("NODES_AT_ONCE", "PAIRS_AT_ONCE"):
        monkeypatch.setattr(spelling, name, 5)
    monkeypatch.setattr(spelling, "FEW_PAIRS", 2)
    words = sorted(vocabulary)
    trie = spelling.Trie(words, [1] * len(words), spelling.group_numbers(spelling.GROUPS))
    i, j = spelling.search(trie, trie, spelling.EVEN)
    found = Counter(frozenset((trie.words[a], trie.words[b])) for a, b in zip(i, j))
    assert set(found.values()) == {1}
    near = brute_variants(vocabulary)
    assert sum(n for _, n in near.values()) == 2 * len(found)


def test_words_of_edge_cases(edge):
    rows = edge.select("doc_id", "text")
    counts = {r["word"]: r["n"] for r in spelling.count_words(edge, misspell=31).collect()}
    assert counts == brute_words(rows_of(rows))
    assert spelling.variants(spelling.count_words(edge)).count() == sum(n >= 2 for n in {r["word"]: r["n"] for r in spelling.count_words(edge).collect()}.values())
    assert spelling.variants(spelling.count_words(edge.limit(0))).count() == 0


def test_forms_are_followed_to_the_last(spark):
    counts = {"lettera": 2, "letters": 30, "lettersx": 400, "lettersxy": 5000, "alonealone": 4}
    df = spark.createDataFrame([*counts.items(), (None, 9), ("seldomer", 1)], "word string, n long")
    roots = {r["word"]: r["root"] for r in spelling.variants(df).collect()}
    assert roots == {w: "alonealone" if w == "alonealone" else "lettersxy" for w in counts}
