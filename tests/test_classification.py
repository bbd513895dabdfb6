import json

from feedloom.config import RuleSet
from feedloom.operators import classify, evidence, inference, quality
from pyspark.sql import functions as F

from conftest import ids


def test_prompt_text(raw):
    text = classify.with_prompt(raw({"rating": 4.0, "review_text": "Body"})).first()["prompt"]
    assert text == (
        "Product: Test Product\nBrand: Ours\nCategory: vacuums\nRating: 4.0/5\nTitle: Test\nReview:\nBody"
    )


def test_routing(raw):
    df = raw(
        {"rating": 3.0}, {"rating": 2.0, "review_text": "good but loud"},
        {"rating": 5.0, "review_text": "good but loud"}, {"rating": 5.0, "review_text": "x" * 1001},
        {"rating": 5.0, "review_text": "x" * 1000},
    )
    assert ids(classify.route(df).filter("model = 'strong'")) == ["r000", "r001", "r003"]


def coerced(spark, *answers):
    rows = [(f"r{i}", a if isinstance(a, str) else json.dumps(a)) for i, a in enumerate(answers)]
    df = spark.createDataFrame(rows, "review_id string, response string")
    return classify.coerce_classification(df).orderBy("review_id").collect()


def test_coercion(spark):
    got = coerced(
        spark,
        {},
        {"primary_theme": "weather", "sentiment": "angry", "severity": "9"},
        {"severity": None},
        {"severity": "high"},
        {"severity": 2.9, "secondary_themes": ["noise", "weather"]},
        'Sure! {"severity": -3, "sentiment": "mixed"} done',
        "no json",
        '{"severity": 3} and {"severity": 4}',
        "[1, 2]",
        {"sentiment_confidence": 1.5},
        {"sentiment_confidence": "0.25"},
        {"features_mentioned": "motor"},
        {"features_mentioned": ["motor", "hose"], "competitor_mentions": [{"brand": "A", "context": "neutral"}]},
        {"failure_mode": None, "has_actionable_signal": 1, "actionable_detail": "do it"},
        {"actionable_detail": None},
    )
    reasons = [r["failed_reason"] for r in sorted(got, key=lambda r: int(r["review_id"][1:]))]
    rows = {int(r["review_id"][1:]): r for r in got}
    assert reasons == [
        None, None, "severity", "severity", None, None, "unreadable response",
        "unreadable response", "unreadable response", "sentiment_confidence", None,
        "features_mentioned", None, None, "actionable_detail",
    ]
    assert (rows[0]["primary_theme"], rows[0]["sentiment"], rows[0]["severity"]) == ("usability", "neutral", 3)
    assert rows[0]["sentiment_confidence"] == 0.5
    assert (rows[1]["primary_theme"], rows[1]["sentiment"], rows[1]["severity"]) == ("usability", "neutral", 5)
    assert (rows[4]["severity"], rows[4]["secondary_themes"]) == (2, ["noise"])
    assert (rows[5]["severity"], rows[5]["sentiment"]) == (1, "mixed")
    assert rows[10]["sentiment_confidence"] == 0.25
    assert rows[12]["features_mentioned"] == ["motor", "hose"]
    assert rows[12]["competitor_mentions"][0]["brand"] == "A"
    assert rows[13]["has_actionable_signal"] and rows[13]["failure_mode"] is None


def test_rules(raw):
    df = raw(
        {"rating": 1.0, "review_text": "The handle cracked after 3  months, dyson was better for us"},
        {"rating": 5.0, "review_text": "So quiet and the battery lasts. Better than Dyson.", "brand": "Dyson"},
        {"rating": 4.0, "review_text": "This is dangerous"},
        {"rating": 3.0, "review_text": "fine overall, nothing more to say"},
        {"rating": 2.5, "review_text": "meh"},
    )
    rules = RuleSet(mention_brands=("Dyson",))
    rows = {r["review_id"]: r for r in classify.rule_classify(df, rules).collect()}
    a, b, c, d, e = (rows[f"r00{i}"] for i in range(5))
    assert (a["primary_theme"], a["sentiment"], a["severity"]) == ("durability", "negative", 5)
    assert a["failure_mode"] in RuleSet().failure_modes["durability"]
    assert (a["failure_timeline"], a["actionable_detail"]) == ("3 months", "Address reported failure mode")
    assert [tuple(m) for m in a["competitor_mentions"]] == [("Dyson", "unfavorable")]
    assert a["features_mentioned"] == ["handle"] and a["has_actionable_signal"]
    assert len(a["key_phrases"][0].split()) == 5 and a["key_phrases"][0] in df.first()["review_text"].replace("  ", " ")
    assert b["primary_theme"] == "noise" and b["competitor_mentions"] == [] and b["failure_mode"] is None
    assert c["severity"] == 5 and c["key_phrases"] == []
    assert d["sentiment"] == "mixed" and 0.60 <= d["sentiment_confidence"] <= 0.90
    assert (e["sentiment"], e["severity"], e["sentiment_confidence"]) == ("neutral", 4, 0.70)


def test_inference_isolates_failures(raw):
    def make():
        def score(prompts):
            if any("bad" in p for p in prompts):
                raise RuntimeError("bad prompt")
            return [p.upper() for p in prompts]

        return score

    df = raw({"title": "ok"}, {"title": "bad"}, {"title": "fine"}).select("review_id", F.col("title").alias("prompt"))
    ok, failed = inference.infer(df, make, batch=3)
    assert {r["response"] for r in ok.collect()} == {"OK", "FINE"}
    assert [(r["review_id"], r["failed_reason"]) for r in failed.collect()] == [("r001", "RuntimeError: bad prompt")]


def test_cache_split(raw):
    df = raw({"title": "a"}, {"title": "b"}, {"title": "a"}).select(
        "review_id", F.col("title").alias("prompt"), F.lit("base").alias("model")
    )
    keyed = inference.with_cache_key(df)
    cache = keyed.filter("prompt = 'a'").select("cache_key", F.lit("hit").alias("response")).distinct()
    hits, misses = inference.split_cached(keyed, cache)
    assert ids(hits) == ["r000", "r002"] and ids(misses) == ["r001"]
    assert inference.distinct_calls(keyed).count() == 2


def test_budget_is_a_running_total(spark):
    rows = [(i, float((i * 37) % 11) / 100) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, cost_usd double").repartition(5)
    spent, want = 0, []
    for k, cost in rows:
        if spent < 1200:
            want.append(k)
        spent += round(cost * 100)
    got = sorted(r["k"] for r in inference.within_budget(df, 12.0, ["k"]).collect())
    assert got == want


def test_costs(spark):
    calls = spark.createDataFrame(
        [("base", 1000, 100), ("strong", 1000, 100), ("other", 1000, 100)],
        "model string, input_tokens long, output_tokens long",
    )
    got = {r["model"]: r["cost_usd"] for r in inference.call_cost(calls).collect()}
    assert got == {"base": 0.0012, "strong": 0.0045, "other": 0.0045}


def test_consistency(spark):
    first = spark.createDataFrame(
        [("a", "noise", "mixed", 3), ("b", None, "mixed", None)],
        "review_id string, primary_theme string, sentiment string, severity int",
    )
    second = spark.createDataFrame(
        [("a", "size", "mixed", 4), ("b", None, "neutral", 3)], first.schema
    )
    got = {r["field"]: (r["agreements"], r["status"]) for r in inference.consistency(first, second).collect()}
    assert got == {
        "primary_theme": (1, "FAIL"), "sentiment": (1, "FAIL"),
        "severity_exact": (1, "FAIL"), "severity_within_1": (2, "PASS"),
    }


def test_grounding(labelled):
    text = {"review_text": "The motor died after three long months of use"}
    df = labelled(
        {**text, "key_phrases": ["MOTOR died", "", "the motor died very soon after months today x"]},
        {**text, "key_phrases": ["motor died after ten weeks"], "features_mentioned": ["motor unit", "", "hose"]},
        {"key_phrases": None, "features_mentioned": None},
    )
    row = quality.phrase_grounding(df).first()
    assert (row["total_phrases"], row["grounded"], row["status"]) == (4, 2, "FAIL")
    assert quality.ungrounded_examples(df).count() == 2
    features = quality.feature_grounding(df).first()
    assert (features["total"], features["grounded"]) == (4, 3)


def test_alignment(labelled):
    df = labelled(
        {"rating": 3.5, "sentiment": "mixed"}, {"rating": 4.0, "sentiment": "neutral"},
        {"rating": 2.0, "sentiment": "neutral"}, {"rating": 3.0, "sentiment": "negative"},
        {"rating": 1.0, "sentiment": "mixed"},
    )
    row = quality.rating_alignment(df).first()
    assert (row["aligned"], row["misaligned"], row["rate"], row["status"]) == (2, 3, 0.4, "WARN")


def test_empty_input(labelled):
    none = labelled({}).limit(0)
    assert quality.phrase_grounding(none).first()["grounding_rate"] == 0.0
    assert quality.severity_distribution(none).count() == 0
    assert quality.coverage(none).count() == 0


def test_one_pass_checks_agree_with_single_checks(labelled):
    df = labelled({"severity": 1}, {"severity": 1}, {"severity": 2, "key_phrases": []}, {"rating": 5.0})
    rates = {r["check"]: (r["rate"], r["status"]) for r in quality.quality_checks(df).collect()}
    single = quality.phrase_grounding(df).first()
    assert rates["phrase_grounding"] == (single["grounding_rate"], single["status"])
    aligned = quality.rating_alignment(df).first()
    assert rates["rating_alignment"] == (aligned["rate"], aligned["status"])
    severity = quality.severity_distribution(df).first()
    assert rates["severity_concentration"] == (severity["max_concentration"], severity["status"])


def test_generated_lists(spark):
    df = spark.createDataFrame(
        [("a", 'Here: [{"x": 1}, {"x": 2}] ok'), ("b", "nothing"), ("c", "[broken")], "id string, answer string"
    )
    got = evidence.recommendation_rows(df).orderBy("id", "position").collect()
    assert [(r["id"], r["parse_error"], r["raw_response"]) for r in got] == [
        ("a", False, None), ("a", False, None), ("b", True, "nothing"), ("c", True, "[broken"),
    ]
    card = spark.createDataFrame([('x {"a": 1} y',), ("none",)], "t string")
    flags = [r[0] for r in card.select(evidence.parse_object(F.col("t")).isNull()).collect()]
    assert flags == [False, True]


def test_brief_falls_back_to_all_brands(spark):
    df = spark.createDataFrame(
        [("c", "A", 1), ("c", "B", 2), ("d", "A", 1)], "category string, brand string, rank int"
    )
    assert [r["rank"] for r in evidence.brief_issues(df, "c", "B").collect()] == [2]
    assert sorted(r["rank"] for r in evidence.brief_issues(df, "c", "X").collect()) == [1, 2]


def test_repeated_cache_keys_answer_once(spark):
    calls = spark.createDataFrame([("r1", "k1"), ("r2", "k2")], "review_id string, cache_key string")
    cache = spark.createDataFrame([("k1", "b"), ("k1", "a"), ("k1", None)], "cache_key string, response string")
    hits, misses = inference.split_cached(calls, cache)
    assert [(r["review_id"], r["response"]) for r in hits.collect()] == [("r1", "a")]
    assert [r["review_id"] for r in misses.collect()] == ["r2"] and sorted(misses.columns) == sorted(calls.columns)


def test_too_few_answers_do_not_shift_rows(spark):
    def make():
        def scorer(prompts):
            if len(prompts) == 1:
                return [p.upper() for p in prompts]

            def some():
                yield "wrong"
                raise RuntimeError("gone")

            return some() if len(prompts) > 3 else ["too few"]

        return scorer

    df = spark.createDataFrame([(i, f"p{i}") for i in range(8)], "id int, prompt string").coalesce(1)
    for batch in (2, 5):
        answered, failed = inference.infer(df, make, batch=batch)
        assert {r["prompt"]: r["response"] for r in answered.collect()} == {f"p{i}": f"P{i}" for i in range(8)}
        assert failed.count() == 0
