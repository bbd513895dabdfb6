"""Model runs: calls in flight, failures, the answer cache, spending in waves, a whole run."""

import os
import threading
import time

import pytest
from feedloom.config import Settings
from feedloom.operators import inference
from feedloom.plans import batch
from pyspark.sql import functions as F

from conftest import ids

ANSWER = '{"sentiment": "negative", "primary_theme": "noise", "severity": 4, "sentiment_confidence": 0.9}'


# --- calls


def test_calls_are_open_at_the_same_time_and_answers_keep_their_order():
    open_now, most, lock = [0], [0], threading.Lock()

    def scorer(texts):
        with lock:
            open_now[0] += 1
            most[0] = max(most[0], open_now[0])
        time.sleep(0.05)
        with lock:
            open_now[0] -= 1
        return [t.upper() for t in texts]

    texts = [f"t{i}" for i in range(40)]
    started = time.time()
    rows = inference.answer_in_order(scorer, texts, batch=1, in_flight=8)
    took = time.time() - started
    assert rows == [(t.upper(), None, 1) for t in texts]
    assert 1 < most[0] <= 8 and took < 40 * 0.05 / 3


def test_good_answers_of_a_failed_batch_are_not_asked_again():
    asked = []

    def scorer(texts):
        asked.extend(texts)
        return [RuntimeError("bad") if "bad" in t else t for t in texts]

    rows = inference.answer_all(scorer, ["a", "bad", "c"], retries=2)
    assert rows == [("a", None, 1), (None, "RuntimeError: bad", 3), ("c", None, 1)]
    assert sorted(asked) == ["a", "bad", "bad", "bad", "c"]


def test_a_batch_that_raises_is_halved():
    calls = []

    def scorer(texts):
        calls.append(len(texts))
        if "bad" in texts:
            raise ValueError("no")
        return texts

    texts = [f"t{i}" for i in range(7)] + ["bad"]
    rows = inference.answer_all(scorer, texts)
    assert [r[0] for r in rows] == [*texts[:7], None] and rows[7][1] == "ValueError: no"
    assert calls == [8, 4, 4, 2, 2, 1, 1]


def test_retries_end_with_the_first_answer():
    seen = []

    def scorer(texts):
        seen.append(texts)
        return [None if len(seen) < 3 else "ok" for _ in texts]

    assert inference.answer_all(scorer, ["x"], retries=5) == [("ok", None, 3)]
    assert inference.answer_all(lambda texts: [None], ["x"]) == [(None, "no answer", 1)]


def test_a_call_that_hangs_fails_its_rows_only():
    def scorer(texts):
        if "slow" in texts:
            time.sleep(2)
        return texts

    rows = inference.answer_in_order(scorer, ["a", "slow", "b"], batch=1, in_flight=3, timeout=0.2)
    assert [r[0] for r in rows] == ["a", None, "b"] and rows[1][1].startswith("TimeoutError")


def test_infer_deals_prompts_to_a_number_of_tasks(spark):
    def make():
        return lambda prompts: [f"{p}!" if p != "p3" else KeyError("p3") for p in prompts]

    df = spark.range(20).select("id", F.concat(F.lit("p"), "id").alias("prompt"))
    good, bad = inference.infer(df, make, batch=3, in_flight=4, tasks=2)
    assert {r["id"]: r["response"] for r in good.collect()} == {i: f"p{i}!" for i in range(20) if i != 3}
    assert [(r["id"], r["failed_reason"], r["attempts"]) for r in bad.collect()] == [(3, "KeyError: 'p3'", 1)]
    assert inference.infer(df.limit(0), make)[0].count() == 0


# --- cache


def test_cache_is_read_by_its_buckets(spark, tmp_path):
    cache = inference.AnswerCache(spark, str(tmp_path / "cache"), buckets=4)
    answers = spark.range(100).select(F.sha2(F.col("id").cast("string"), 256).alias("cache_key"), F.lit("x").alias("response"))
    cache.add("one", answers.limit(60))
    cache.add("two", answers)
    cache.add("two", answers.limit(10).withColumn("response", F.lit("y")))
    rows = cache.read()
    assert rows.filter("batch = 'two'").count() == 100 and rows.count() == 160
    assert rows.groupBy("cache_key", "batch").count().filter("count > 1").isEmpty()
    asked = spark.range(50, 150).select(F.sha2(F.col("id").cast("string"), 256).alias("cache_key"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hits, misses = inference.split_cached(asked, rows)
        plan = hits._jdf.queryExecution().executedPlan().toString()
        assert hits.count() == 50 and misses.count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    scan = plan.index("Bucketed: true")
    assert plan.count("Exchange") == 1 and plan.index("Exchange") < scan
    again = inference.AnswerCache(spark, str(tmp_path / "cache"), buckets=4)
    assert again.read().count() == 160
    with pytest.raises(ValueError):
        cache.add("a/b", answers)


# --- budget


def line(spark, n):
    rows = [(i, f"k{i}", "base", f"prompt {i}", 1000, 100) for i in range(n)]
    return spark.createDataFrame(rows, "place int, cache_key string, model string, prompt string, input_tokens long, output_tokens long")


@pytest.mark.parametrize("wave", [0.05, 0.3, 1.0])
def test_overspending_is_bounded_by_a_wave(spark, wave):
    """Answers are five times as long as estimated: 100 calls would cost 0.28, not 0.12."""

    def make():
        return lambda prompts: ["x" * 2000 for _ in prompts]

    calls = line(spark, 100)
    answered, failed, rest = inference.infer_within_budget(calls, make, 0.1, ["place"], wave)
    estimate, actual = (1000 * 0.8 + 100 * 4) / 1e6, (1000 * 0.8 + 500 * 4) / 1e6
    n = answered.count()
    spent = answered.agg(F.sum("cost_usd")).first()[0]
    assert abs(spent - n * actual) < 1e-9 and failed.count() == 0 and rest.count() == 100 - n
    assert spent >= 0.1 and sorted(r["place"] for r in answered.collect()) == list(range(n))
    # A wave is estimated at no more than its share, plus its last call.
    assert spent - 0.1 <= (0.1 * wave / estimate + 1) * actual


def test_short_answers_leave_money_for_more_calls(spark):
    def make():
        return lambda prompts: ["x" for _ in prompts]

    answered, _, rest = inference.infer_within_budget(line(spark, 120), make, 0.1, ["place"], 0.25)
    assert rest.count() + answered.count() == 120
    assert answered.count() > 0.1 / ((1000 * 0.8 + 100 * 4) / 1e6)  # more than the estimates allowed


def test_nothing_is_asked_without_a_budget(spark):
    def make():
        raise AssertionError("asked")

    answered, failed, rest = inference.infer_within_budget(line(spark, 3), make, 0.0, ["place"])
    assert (answered.count(), failed.count(), rest.count()) == (0, 0, 3)
    assert [x.count() for x in inference.infer_within_budget(line(spark, 3).limit(0), make, 1.0, ["place"])] == [0, 0, 0]


# --- runs


def scorer_of(counter):
    """Answers all prompts but those with "fail"; writes what it was asked to a folder."""

    def make():
        def score(prompts):
            for p in prompts:
                with open(f"{counter}/{abs(hash(p))}-{time.time_ns()}", "w") as f:
                    f.write(p)
            return [ConnectionError("gone") if "fail" in p else ANSWER for p in prompts]

        return score

    return make


@pytest.fixture
def reviews(raw):
    texts = ["The motor is far too loud for a kitchen.", "It does fail every single morning now.", "The motor is far too loud for a kitchen.", "Nothing to say about it but it works well."]
    return raw(*({"review_text": t, "rating": 2.0, "product_id": f"P{i % 2}"} for i, t in enumerate(texts)))


def test_a_repeated_run_asks_for_failed_rows_only(reviews, tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()
    cache = str(tmp_path / "cache")
    run = batch.classify_with_model(reviews, scorer_of(str(asked)), cache, 1.0, batch_id="run-1")
    assert ids(run.classified) == ["r000", "r002", "r003"]
    assert [(r["review_id"], r["failed_reason"]) for r in run.failed.collect()] == [("r001", "ConnectionError: gone")]
    # Equal prompts share a call: products differ, so the two equal texts are one prompt only if all else is equal.
    first = len(os.listdir(asked))
    assert first == 3 and run.calls.count() == 2
    again = batch.classify_with_model(reviews, scorer_of(str(asked)), cache, 1.0, batch_id="run-1")
    assert ids(again.classified) == ["r000", "r002", "r003"] and len(os.listdir(asked)) == first + 1
    stored = inference.AnswerCache(reviews.sparkSession, cache).read()
    assert stored.count() == 2 and again.calls.count() == 0


def test_a_batch_with_a_model_writes_every_row(reviews, spark, tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()
    out = str(tmp_path / "out")
    settings = Settings(own_brands=("Shark",), as_of="2024-07-01", briefs=(("vacuums", "Ours"),))
    scorer = scorer_of(str(asked))
    batch.run_batch(
        reviews, settings, out,
        classify=lambda d: batch.classify_with_model(d, scorer, str(tmp_path / "cache"), 1.0),
        recheck=lambda d: batch.model_consistency(d, scorer, 10),
    )
    cleaned = spark.read.parquet(f"{out}/cleaned")
    assert ids(cleaned) == ["r000", "r001", "r003"]
    assert spark.read.json(f"{out}/cleaning").first()["removed_exact_dup"] == 1
    assert ids(spark.read.parquet(f"{out}/classified")) == ["r000", "r003"]
    assert ids(spark.read.json(f"{out}/failed")) == ["r001"]
    costs = spark.read.json(f"{out}/model/costs").collect()
    assert sum(c["calls"] for c in costs) == 2 and all(c["cost_usd"] > 0 for c in costs)
    checks = {r["field"]: (r["sample_size"], r["status"]) for r in spark.read.json(f"{out}/quality/consistency").collect()}
    assert checks["sentiment"] == (2, "PASS")
    assert spark.read.json(f"{out}/evidence/brief_vacuums_Ours_issues").first()["brand"] == "Ours"
    assert os.path.isdir(f"{out}/evidence/brief_vacuums_Ours_context")


def test_texts_are_not_written_with_the_plan_of_the_calls(raw, tmp_path, monkeypatch):
    """Of all staged tables only the reviews and the result hold texts; equal prompts still share a call."""
    written, plain = [], inference.Stage.write

    def write(self, df):
        written.append(set(df.columns))
        return plain(self, df)

    monkeypatch.setattr(inference.Stage, "write", write)
    df = raw({"review_text": "one and the same"}, {"review_text": "one and the same"}, {"review_text": "another one"})
    df = df.unionByName(df.limit(1))  # an id and its review may come twice
    fine, failed, paid = batch.classify_with_model(df, lambda: lambda ps: [ANSWER for _ in ps], str(tmp_path / "c"), 1e9)
    assert ids(fine) == ["r000", "r000", "r001", "r002"] and failed.count() == 0 and paid.count() == 2
    assert not any("prompt" in columns for columns in written)
    assert sum("review_text" in columns for columns in written) == 2
