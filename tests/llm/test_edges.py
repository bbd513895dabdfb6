"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from feedloom.llm import exact_dedup, jaccard, langid, licenses, line_dedup, mixing, packing, quality, secrets
from feedloom.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, token string, digest int, n int"
LONG = "\n".join(f"line number {i} with a few more words behind it" for i in range(8000))
ROWS = [
    (1, "One line of words that is here.", "en", "src0"),
    (2, None, None, None),
    (3, "", "en", "src0"),
    (4, LONG, "en", None),
    (5, "One line of words that is here.", "en", "src1"),
    (5, "One line of words that is here.", "en", "src1"),
    (5, "Another text under the same id, here.", None, "src1"),
    (None, "One line of words that is here.", "en", "src0"),
    (None, None, None, None),
    (6, " \n\t\n ", "en", "src2"),
    (7, "éü \U0001f600 漢字 \x00 end", "de", "src2"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, None if r[1] is None else len(r[1]), "clash", None, 7, None) for r in ROWS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (5, 0, 0), (5, 1, None), (None, 1, 0), (4, None, 0)], "doc_id long, quality int, toxic int")


def test_exact(docs, none):
    rows = exact_dedup.exact_groups(docs).collect()
    assert len(rows) == len(ROWS)
    same = [r for r in rows if r["group_size"] == 4]
    assert {r["keep_id"] for r in same} == {5} and sorted(bool(r["kept"]) for r in same) == [False, False, True, True]
    empty = [r for r in rows if r["group_size"] == 3]
    assert {r["doc_id"] for r in empty} == {2, 3, None} and {r["keep_id"] for r in empty} == {3}
    assert exact_dedup.exact_groups(none).count() == 0


def test_only_null_ids_stay_with_each_other(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a")], "doc_id long, text string")
    assert all(r["kept"] and r["keep_id"] is None for r in exact_dedup.exact_groups(df).collect())


def test_secrets_and_licenses(docs, none):
    for scan in (secrets.scan_secrets, licenses.scan_licenses):
        assert scan(docs).count() == len(ROWS)
        assert scan(none).count() == 0


def test_quality(docs, none, labels):
    model = quality.train(docs, labels)
    scored = quality.score_quality(docs, model).collect()
    assert len(scored) == len(ROWS) and all(0 <= r["score"] <= 1 for r in scored)
    untaught = quality.train(docs, labels.limit(0))
    assert {r["score"] for r in quality.score_quality(docs, untaught).collect()} == {0.5}
    assert quality.score_quality(none, model).count() == 0
    assert quality.keep_quality(docs, untaught).columns == docs.columns


def test_language(docs, none):
    model = langid.train(docs)
    told = langid.identify(docs, model).collect()
    assert len(told) == len(ROWS)
    assert {r["lang_pred"] for r in told if r["doc_id"] in (2, 3, 6)} == {"und"}
    assert {r["lang_pred"] for r in langid.identify(docs, langid.train(none)).collect()} == {"und"}
    assert langid.identify(none, model).count() == 0


def test_lines(docs, none):
    done = line_dedup.dedup_lines(docs).select("row.*", "n_removed").collect()
    assert len(done) == len(ROWS) and {r["n_removed"] for r in done} == {0}
    assert sorted(r["row"] for r in done) == ["clash"] * len(ROWS)
    assert line_dedup.dedup_lines(none).count() == 0


def test_jaccard(docs, none):
    rows = jaccard.jaccard_components(docs).collect()
    assert len(rows) == len(ROWS)
    assert sorted((r["component_id"] or 0) for r in rows) == sorted([1, 2, 3, 4, 1, 1, 5, 0, 0, 6, 7])
    assert jaccard.jaccard_components(none).count() == 0


def test_mixing(docs, none):
    for portion, epochs in (((1, 1), 1), ((5, 1), 2), ((0, 1), 1)):
        chosen = mixing.mix(docs, {}, F.lit(None).cast("string"), portion, epochs)
        assert chosen.filter("tokens > 0").count() == {(1, 1): 7, (5, 1): 14, (0, 1): 0}[portion]
    assert mixing.mix(none, {}, F.lit("all")).count() == 0


def test_packing(docs, none):
    rows = packing.pack_documents(docs, tokenizer_path()).collect()
    assert {r["doc_id"] for r in rows} == {r[0] for r in ROWS}
    assert packing.pack_documents(none, tokenizer_path()).count() == 0


def test_pipeline_stages_keep_the_columns(spark, docs, tmp_path, labels):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_pipeline_decides_on_rows(spark, docs, tmp_path):
    own = lambda df: sorted(df.select("doc_id", "text", "source").collect(), key=str)
    rows = docs.select("doc_id", "text", "source").distinct().collect()
    same = "One line of words that is here."
    # All copies of one text but the first id's; the other text under id 5 stays.
    alone = [r for r in rows if r["text"] != same or r["doc_id"] == 1]
    assert own(corpus_pipeline.drop_near_duplicates(spark, docs, "")) == sorted(alone, key=str)
    # Copies without an id, or of one id alone, still leave one document.
    for doc_id in (None, 5):
        left = corpus_pipeline.drop_near_duplicates(spark, docs.filter(F.col("doc_id").eqNullSafe(F.lit(doc_id).cast("long"))), "")
        assert left.filter(F.col("text") == same).count() == 1


@pytest.mark.parametrize("portion", [(1, 1), (1, 2), (1, 3)])
def test_pipeline_keeps_the_rows_that_the_mix_chose(spark, monkeypatch, portion):
    monkeypatch.setattr(corpus_pipeline, "MIX_PORTION", portion)
    texts = [f"text {i} " + "word " * (i % 5 + 3) for i in range(30)]
    rows = [(None if i % 3 else i // 9, t, "en", "src0", len(t)) for i, t in enumerate(texts)] + [(7, "a b c d", "en", "src0", 7)] * 6
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.mix_sources(spark, docs, "").collect()
    words = lambda texts: sum(len(t.split()) for t in texts)
    budget = words(r[1] for r in rows) * portion[0] // portion[1]
    assert budget <= words(r["text"] for r in kept) < budget + 10
    assert any(r["doc_id"] is None for r in kept)
    assert portion != (1, 1) or sorted(map(tuple, kept), key=str) == sorted(rows, key=str)
