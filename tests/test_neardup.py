import random

import pytest
from feedloom.operators import neardup
from feedloom.operators.neardup import dedup_fuzzy
from pyspark.sql import functions as F

from conftest import ids


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            kept = row[j + 1]
            row[j + 1] = before + 1 if x == y else max(row[j + 1], row[j])
            before = kept
    return row[-1]


def brute(texts, percent=95, head=200):
    """Keep-first over all pairs; texts come in input order."""
    kept, out = [], []
    for key, text in texts:
        t = text.lower().strip()[:head]
        close = any(
            p == t
            or (abs(len(p) - len(t)) * 20 <= len(p) + len(t)
                and 200 * common(p, t) > percent * (len(p) + len(t)))
            for p in kept
        )
        if not close:
            kept.append(t)
            out.append(key)
    return sorted(out)


def edited(rng, text, n):
    chars = list(text)
    for _ in range(n):
        kind, at = rng.random(), rng.randrange(len(chars))
        if kind < 0.35:
            chars.insert(at, rng.choice("abcdefgh "))
        elif kind < 0.7 and len(chars) > 20:
            del chars[at]
        else:
            chars[at] = rng.choice("abcdefgh ")
    return "".join(chars)


def corpus(seed, families, size, lengths):
    rng = random.Random(seed)
    texts = []
    for _ in range(families):
        base = "".join(rng.choice("abcdefghijklmnop ") for _ in range(rng.choice(lengths)))
        texts += [edited(rng, base, rng.randrange(0, 14)) for _ in range(size)]
    rng.shuffle(texts)
    return [(f"r{i:03d}", "z" + t + "z") for i, t in enumerate(texts)]


@pytest.mark.parametrize("hot", [1000, 3])
def test_same_as_all_pairs(raw, hot):
    texts = corpus(7, 14, 9, [24, 40, 60, 110, 190, 205, 240])
    df = raw(*[{"review_id": k, "review_text": t} for k, t in texts])
    assert ids(dedup_fuzzy(df, order=("review_id",), hot=hot)) == brute(texts)


def test_chain_of_close_neighbours(raw):
    """b is close to a and c to b, but c is not close to a: b goes, c stays."""
    a = "".join(chr(97 + i % 25) for i in range(100))
    b = "12345" + a[:-2]
    c = "1234567890" + a[:-5]
    texts = [("r000", a), ("r001", b), ("r002", c), ("r003", c + "x")]
    df = raw(*[{"review_id": k, "review_text": t} for k, t in texts])
    want = brute(texts)
    assert want == ["r000", "r002"]
    assert ids(dedup_fuzzy(df, order=("review_id",))) == want
    assert ids(dedup_fuzzy(df, order=("review_id",), hot=1)) == want


def test_threshold_is_strict(raw):
    """Ten of 200 characters changed in total is exactly 95 percent: both stay."""
    a = "".join(chr(97 + (i * 7) % 26) for i in range(100))
    exactly = a[:-5] + "12345"
    above = a[:-4] + "1234"
    df = raw({"review_text": a}, {"review_text": exactly})
    assert len(ids(dedup_fuzzy(df, order=("review_id",)))) == 2
    df = raw({"review_text": a}, {"review_text": above})
    assert len(ids(dedup_fuzzy(df, order=("review_id",)))) == 1


def test_shared_opening_with_different_ends(raw):
    """Many heads share a long opening but are not close to each other."""
    rng = random.Random(3)
    opening = "we bought this for our new kitchen because everybody told us how good it would be "
    texts = [
        (f"r{i:03d}", opening + "".join(rng.choice("abcdefghij") for _ in range(90)))
        for i in range(40)
    ]
    texts += [(f"r{40 + i:03d}", t + "x") for i, (_, t) in enumerate(texts[:10])]
    df = raw(*[{"review_id": k, "review_text": t} for k, t in texts])
    want = brute(texts)
    assert len(want) == 40
    for hot in (1000, 5):
        assert ids(dedup_fuzzy(df, order=("review_id",), hot=hot)) == want


def test_partitioning_does_not_matter(raw, spark):
    texts = corpus(11, 6, 6, [50, 120, 200])
    df = raw(*[{"review_id": k, "review_text": t} for k, t in texts])
    want = brute(texts)
    for n in (1, 7):
        mixed = df.repartition(n, F.rand(n))
        assert ids(dedup_fuzzy(mixed, order=("review_id",))) == want


def test_enough_blocks_for_every_length(spark):
    """Every head has at least as many blocks as can be hit by edits, plus one."""
    df = spark.range(1, 1001).select(F.col("id").cast("int").alias("n"))
    for head in (200, 1000):
        rows = df.filter(F.col("n") <= head).select(
            "n",
            neardup.needed(F.col("n"), 95, head).alias("needed"),
            neardup.width(F.col("n"), 95, head).alias("w"),
        )
        for r in rows.collect():
            assert r["n"] // r["w"] >= r["needed"]
            most = max(
                (d for m in range(r["n"], head + 1)
                 for d in [(5 * (r["n"] + m) - 1) // 100] if m - r["n"] <= d),
                default=0,
            )
            assert r["needed"] > most


def brute_whole(texts):
    """Keep-first over all pairs whose heads and whole texts are both close."""
    kept, out = [], []
    for key, text in texts:
        t = text.lower().strip()
        alike = lambda a, b: 200 * common(a, b) > 95 * (len(a) + len(b))
        if not any(alike(p[:200], t[:200]) and alike(p, t) for p in kept):
            kept.append(t)
            out.append(key)
    return sorted(out)


@pytest.mark.parametrize("hot", [1, 1000])
def test_whole_texts_confirm_copies(raw, hot):
    rng = random.Random(17)
    draw = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    opening = draw(210)
    # One template before different texts, with copies of some of them, and unrelated ones.
    bodies = [opening + draw(rng.choice([0, 40, 150, 300])) for _ in range(10)]
    bodies += [edited(rng, rng.choice(bodies), rng.randrange(0, 9)) for _ in range(12)]
    bodies += [draw(rng.choice([30, 120, 260])) for _ in range(6)]
    bodies += [bodies[0], bodies[4].upper(), "  " + bodies[5]]
    rng.shuffle(bodies)
    texts = [(f"r{i:03d}", "z" + t + "z") for i, t in enumerate(bodies)]
    df = raw(*({"review_id": k, "review_text": t} for k, t in texts))
    want = brute_whole(texts)
    for crowd in (1, 50):
        assert ids(dedup_fuzzy(df, order=("review_id",), hot=hot, crowd=crowd, whole=True)) == want
    assert len(want) > len(ids(dedup_fuzzy(df, order=("review_id",), hot=hot)))


def test_alike_is_the_exact_ratio():
    rng = random.Random(5)
    for letters, lengths, rounds in (("abcde", (0, 90), 500), ("ab", (0, 60), 300), ("abcdefgh ", (500, 900), 12)):
        draw = lambda n: "".join(rng.choice(letters) for _ in range(n))
        for _ in range(rounds):
            a = draw(rng.randint(*lengths))
            b = edited(rng, a, rng.randrange(0, max(2, len(a) // 9))) if a and rng.random() < 0.9 else draw(rng.randint(*lengths))
            for percent in (95, 90, 70):
                assert neardup.alike(a, b, percent) == (200 * common(a, b) > percent * (len(a) + len(b)))


def test_whole_texts_of_one_opening_meet_by_rare_blocks(raw, spark):
    """Different long texts behind one opening: the pairs that are compared grow as the texts do."""
    rng = random.Random(29)
    draw = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvw ") for _ in range(n))
    opening = draw(205)
    bodies = [opening + draw(1200) for _ in range(200)]
    copies = [edited(rng, bodies[i], 20) for i in (3, 50, 199)]
    texts = [(f"r{i:03d}", "z" + t + "z") for i, t in enumerate(bodies + copies)]
    df = raw(*({"review_id": k, "review_text": t} for k, t in texts))
    assert ids(dedup_fuzzy(df, order=("review_id",), whole=True, crowd=20)) == [f"r{i:03d}" for i in range(200)]
    rows = [(i, 1, t) for i, (_, t) in enumerate(texts)]
    whole = spark.createDataFrame(rows, "nid long, crowd long, body string")
    index = neardup.whole_grams(whole, 95, 200, index=True)
    pairs = neardup._meet(neardup.whole_grams(whole, 95, 200, index=False), index, 95).count()
    assert 3 <= pairs <= 2 * len(texts)


def test_blocks_of_whole_texts_are_enough():
    for n in range(1, 3000, 7):
        w, need = neardup.width_of(n, 95, 200), neardup.needed_of(n, 95)
        assert n // w >= need and w in neardup.widths_of(n, 95, 200)
        for m in range(n, int(n * 1.12) + 2):
            if m - n <= neardup.most_edits(n, m, 95):
                assert need > neardup.most_edits(n, m, 95) and w in neardup.widths_of(m, 95, 200)


def test_fates_list_the_first_of_every_text(raw):
    df = raw({"review_text": "One text that is here."}, {"review_text": " ONE text that is here.\n"}, {"review_text": "One text that is here!"}, {"review_text": "x"})
    for whole in (False, True):
        rows = {r["id"]: r["near"] for r in neardup.fates(df, order=("review_id",), whole=whole).collect()}
        assert rows == {"r000": False, "r002": True, "r003": False}
    assert neardup.fates(df.limit(0), order=("review_id",)).count() == 0


def test_marks_differ_in_no_more_bits_than_edits(spark):
    rng = random.Random(31)
    rows = []
    for i in range(300):
        a = "".join(rng.choice("abcdefgh éß漢\U0001f600") for _ in range(rng.randrange(0, 200)))
        chars, edits = list(a), rng.randrange(0, 25)
        for _ in range(edits):
            if chars and rng.random() < 0.5:
                del chars[rng.randrange(len(chars))]
            else:
                chars.insert(rng.randrange(len(chars) + 1), rng.choice("abcé漢x"))
        rows.append((a, "".join(chars), edits))
    df = spark.createDataFrame(rows, "a string, b string, edits int").withColumns(
        {"x": neardup.marks(F.col("a")), "y": neardup.marks(F.col("b"))}
    )
    apart = sum(F.bit_count(F.col(f"x.{m}").bitwiseXOR(F.col(f"y.{m}"))) for m in neardup.MARKS)
    assert df.filter(apart > F.col("edits")).count() == 0
    assert df.filter(apart > 0).count() > 200


@pytest.mark.parametrize("hot", [1000, 20])
def test_unrelated_heads_of_one_opening_are_not_verified(raw, monkeypatch, hot):
    """What is verified follows the near pairs, not the square of the heads behind one opening."""
    rng = random.Random(37)
    draw = lambda n: "".join(rng.choice("abcdefghijklmnopqrs ") for _ in range(n))
    opening = draw(75)
    texts = [opening + draw(150) for _ in range(150)]
    texts += [edited(rng, texts[i], 3) for i in range(5)]
    seen, plain = [], neardup._verify

    def counted(pairs, *args):
        pairs = pairs.localCheckpoint()
        seen.append(pairs.count())
        return plain(pairs, *args)

    monkeypatch.setattr(neardup, "_verify", counted)
    df = raw(*({"review_id": f"r{i:03d}", "review_text": "z" + t + "z"} for i, t in enumerate(texts)))
    assert ids(dedup_fuzzy(df, order=("review_id",), hot=hot)) == [f"r{i:03d}" for i in range(150)]
    assert 5 <= sum(seen) <= 50


@pytest.mark.parametrize("hot,first_rows", [(1000, 1), (2, 10)])
def test_portions_decide_as_the_whole_table_does(raw, hot, first_rows):
    rng = random.Random(41)
    draw = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    opening = draw(205)
    bodies = [opening + draw(rng.choice([0, 60, 200])) for _ in range(8)] + [draw(rng.choice([30, 150, 300])) for _ in range(8)]
    bodies += [edited(rng, rng.choice(bodies), rng.randrange(0, 9)) for _ in range(40)]
    rng.shuffle(bodies)
    texts = [(f"r{i:03d}", "z" + t + "z") for i, t in enumerate(bodies)]
    df = raw(*({"review_id": k, "review_text": t} for k, t in texts))
    assert ids(dedup_fuzzy(df, order=("review_id",), hot=hot, first_rows=first_rows)) == brute(texts)
    got = ids(dedup_fuzzy(df, order=("review_id",), hot=hot, crowd=3, whole=True, first_rows=first_rows))
    assert got == brute_whole(texts)


def test_pairs_of_a_family_follow_its_copies(raw, monkeypatch):
    """Near-copies of one text are compared with what is kept of it, not all with each other."""
    rng = random.Random(43)
    base = "".join(rng.choice("abcdefghijklmnop ") for _ in range(320))
    texts = [("r000", "z" + base + "z")] + [(f"r{i:03d}", "z" + edited(rng, base, 3) + "z") for i in range(1, 160)]
    seen, plain = [], neardup._confirm

    def counted(pairs, *args):
        pairs = pairs.localCheckpoint()
        seen.append(pairs.count())
        return plain(pairs, *args)

    monkeypatch.setattr(neardup, "_confirm", counted)
    df = raw(*({"review_id": k, "review_text": t} for k, t in texts))
    assert ids(dedup_fuzzy(df, order=("review_id",), whole=True, first_rows=10)) == ["r000"]
    assert sum(seen) < 160 * 159 / 4


def test_sizes_that_can_be_close_share_a_step(spark):
    n = F.col("id").cast("int")
    for percent in (95, 80, 99):
        rows = spark.range(1, 3000).select(
            n.alias("n"),
            neardup.longest(n, percent, 1 << 30).alias("most"),
            neardup.span(n, percent).alias("own"),
            neardup.span(neardup.longest(n, percent, 1 << 30), percent).alias("high"),
            neardup.span(neardup.shortest(n, percent), percent).alias("low"),
        ).collect()
        own = {r["n"]: r["own"] for r in rows}
        assert all(r["high"] - r["low"] <= 1 for r in rows if r["n"] > 60)
        assert all(r["low"] <= own.get(m, r["low"]) <= r["high"] for r in rows for m in (r["n"], r["most"], (r["n"] + r["most"]) // 2))


def test_heads_are_looked_up_by_their_rarest_blocks(raw, monkeypatch):
    """Fewer than half of the substrings of a head are joined, and no close pair is missed."""
    rng = random.Random(47)
    bodies = ["".join(rng.choice("abcdefghijklmnop ") for _ in range(220)) for _ in range(40)]
    bodies += [edited(rng, t, rng.randrange(0, 14)) for t in bodies]
    texts = [(f"r{i:03d}", "z" + t + "z") for i, t in enumerate(bodies)]
    seen, plain = [], neardup._meet

    def counted(probe, *args, **options):
        seen.append(probe.count())
        return plain(probe, *args, **options)

    monkeypatch.setattr(neardup, "_meet", counted)
    df = raw(*({"review_id": k, "review_text": t} for k, t in texts))
    assert ids(dedup_fuzzy(df, order=("review_id",))) == brute(texts)
    assert 20 * len(texts) <= sum(seen) <= 97 * len(texts)


def test_plans_of_heads_are_those_of_columns(spark):
    n = F.col("id").cast("int")
    for percent, head in ((95, 200), (80, 200), (99, 1000)):
        rows = spark.range(1, head + 1).select(
            n.alias("n"), neardup.needed(n, percent, head).alias("need"), neardup.width(n, percent, head).alias("w"),
            neardup.shortest(n, percent).alias("low"), neardup.longest(n, percent, head).alias("high"),
        ).collect()
        width = {r["n"]: r["w"] for r in rows}
        for r in rows:
            widths = {width[m] for m in range(r["low"], r["high"] + 1) if width[m] <= r["n"]}
            assert neardup.head_plan(r["n"], percent, head) == (r["need"], tuple(sorted(widths)))
