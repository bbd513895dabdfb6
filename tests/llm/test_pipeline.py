"""The pipeline's stages, one after the other, against brute-force versions."""

import random

from test_methods import WORDS, brute_components, brute_lines, near_copies, prose

import corpus_pipeline
from feedloom.llm import line_dedup, packing, quality


def test_stages_against_brute_force(spark, tmp_path):
    r = random.Random(21)
    passage = "\n".join(prose(r, 20) for _ in range(4))
    texts = [prose(r, 60) + "\n" + prose(r, 30) for _ in range(90)]
    texts += [" ".join(f"{r.choice(WORDS)}%%%" for _ in range(60)) for _ in range(40)]
    texts += [f"{prose(r, 40)}\n{passage}\n{prose(r, 30)}" for _ in range(15)]
    texts += near_copies(r, 12, chains=False) + [texts[0], texts[3], "", None, prose(r, 4000)]
    rows = [(i, t, "en" if i % 3 else None, f"src{i % 6}", len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = [(i, int("%%%" not in (t or "")), 0) for i, t in enumerate(texts[:130])]
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")

    tables = [spark.read.parquet(f"{folder}/documents.parquet")]
    for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], folder).write.parquet(f"{folder}/{at}")
        tables.append(spark.read.parquet(f"{folder}/{at}"))
    read = [{x["doc_id"]: x["text"] for x in t.collect()} for t in tables[:-1]]

    model = quality.train(tables[0], spark.read.parquet(f"{folder}/labels.parquet"))
    assert read[1] == {i: t for i, t in read[0].items() if model.score(t or "") >= 0.5}
    assert not any("%%%" in (t or "") for t in read[1].values()) and len(read[1]) > 100

    ids = sorted(read[1])
    kept = brute_lines([read[1][i] or "" for i in ids], line_dedup.MIN_WORDS)
    expected = {}
    for i, lines in zip(ids, kept, strict=True):
        text = read[1][i]
        all_lines = (text or "").split("\n")
        if len(lines) == len(all_lines):
            expected[i] = text
        elif left := "\n".join(all_lines[k] for k in lines).strip():
            expected[i] = "\n".join(all_lines[k] for k in lines) if left else None
    assert read[2] == expected
    assert all(x["n_chars"] == len(x["text"] or "") for x in tables[2].collect())

    ids = sorted(read[2])
    top, _ = brute_components([(read[2][i] or "").lower() for i in ids])
    assert set(read[3]) == {i for k, i in enumerate(ids) if top[k] == k}
    assert set(read[4]) <= set(read[3]) and all(read[4][i] == read[3][i] for i in read[4])
    words = lambda t: sum(len((x or "").split()) for x in t.values())
    assert 0.5 * words(read[3]) < words(read[4]) <= words(read[3])

    pieces = tables[5].collect()
    assert {p["doc_id"] for p in pieces} == set(read[4])
    used = {}
    for p in pieces:
        used[p["sequence_id"]] = used.get(p["sequence_id"], 0) + p["length"]
    assert max(used.values()) <= packing.CAPACITY

    own = ("doc_id", "piece", "start", "length", "ids_crc32")
    whole = corpus_pipeline.run(spark, folder).collect()
    assert sorted(tuple(p[c] for c in own) for p in whole) == sorted(tuple(p[c] for c in own) for p in pieces)
