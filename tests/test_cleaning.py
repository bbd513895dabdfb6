from feedloom.config import Settings
from feedloom.operators import cleaning, language
from feedloom.operators.neardup import dedup_fuzzy
from pyspark.sql import functions as F

from conftest import ids

LONG = "This is a perfectly valid review of the product."


def test_removes_empty(raw):
    df = raw({"review_text": LONG}, {"review_text": "Too short"}, {"review_text": ""})
    assert ids(cleaning.drop_short(df)) == ["r000"]


def test_length_is_measured_after_strip(raw):
    df = raw({"review_text": "  \n" + "x" * 19 + " \t"}, {"review_text": "\t" + "x" * 20 + " "})
    assert ids(cleaning.drop_short(df)) == ["r001"]


def test_exact_dedup_keeps_first(raw):
    df = raw(
        {"review_text": LONG},
        {"review_text": " " + LONG.upper() + "\n"},
        {"review_text": "Something completely different from the other."},
    )
    assert ids(cleaning.dedup_exact(df)) == ["r000", "r002"]
    assert ids(dedup_fuzzy(df)) == ["r000", "r002"]


def test_spam(raw):
    df = raw(
        {"review_text": LONG},
        {"review_text": "Buy now at the shop, discount code SAVE, click here today"},
        {"review_text": "Visit my website for free trial of it all"},
        {"review_text": "Use my coupon code for this great thing"},
    )
    assert ids(cleaning.remove_spam(df)) == ["r000"]


def test_shouting_bounds(spark):
    rows = [
        ("a", "Great!!!!", 5.0, True),
        ("b", "Great!!!", 5.0, False),
        ("c", "Great!!!!", 4.0, False),
        ("d", "x" * 25 + "!!!!", 5.0, True),
        ("e", "x" * 26 + "!!!!", 5.0, False),
    ]
    df = spark.createDataFrame(rows, "id string, t string, r double, want boolean")
    got = df.select(cleaning.is_shouting(F.col("t"), F.col("r")).alias("got"), "want").collect()
    assert all(r["got"] == r["want"] for r in got)


def test_repetitive_bounds(spark):
    rows = [
        (" ".join(["buy"] * 10), False),
        (" ".join(["Buy"] * 6 + ["buy"] * 5), True),
        (" ".join(["a", "b", "c"] * 3 + ["a"]), False),
        (" ".join(["a", "b", "c", "d", "e", "f"] + ["a"] * 14), False),
        (" ".join(["a", "b", "c", "d", "e"] + ["a"] * 15), True),
        ("", False),
    ]
    df = spark.createDataFrame(rows, "t string, want boolean")
    got = df.select(cleaning.is_repetitive(F.col("t")).alias("got"), "want").collect()
    assert all(r["got"] == r["want"] for r in got)


def test_shipping_only(raw):
    df = raw(
        {"review_text": "Arrived two weeks late"},
        {"review_text": "Arrived late but the battery is fine"},
        {"review_text": "It came with FedEx in the end"},
        {"review_text": "Boxed nicely and it is a good thing"},
    )
    flagged = cleaning.flag_shipping(df).filter("is_shipping_only")
    assert ids(flagged) == ["r000", "r002"]


def test_normalize(raw):
    df = raw(
        {"review_text": "  lots   of \n\n spaces ", "title": " a \t b "},
        {"review_text": "no break café"},
        {"review_text": "smile \U0001f600 end"},
    )
    rows = {r["review_id"]: r for r in cleaning.normalize_text(df).collect()}
    assert rows["r000"]["review_text"] == "lots of spaces"
    assert rows["r000"]["title"] == "a b"
    assert rows["r001"]["review_text"] == "no break caf"
    assert rows["r002"]["review_text"] == "smile  end"


def test_stats_add_up(raw):
    other = "Another sentence about the same thing, but not equal."
    df = raw(
        {"review_text": LONG},
        {"review_text": LONG},
        {"review_text": "short"},
        {"review_text": "short"},
        {"review_text": other},
        {"review_text": "Please click here to see much more of it"},
        {"review_text": "Delivered by someone on a rainy morning"},
    )
    row = cleaning.cleaning_stats(df, Settings(own_brands=(), as_of="2024-07-01")).first()
    assert row["input"] == 7
    assert row["removed_empty"] == 2
    assert row["removed_exact_dup"] == 1
    assert row["removed_spam"] == 1
    assert row["flagged_shipping"] == 1
    assert row["output"] == 3
    assert row["retention_rate"] == 42.9


def test_stats_keep_what_cleaning_keeps_of_undated_copies(raw):
    text = "A text that comes twice, once without a date."
    df = raw({"review_text": text, "date": None}, {"review_text": text}, {"review_text": text + "!", "date": None})
    settings = Settings(own_brands=("Ours",), as_of="2024-07-01")
    kept = cleaning.clean(df, settings).collect()
    stats = cleaning.cleaning_stats(df, settings).first()
    assert [r["review_id"] for r in kept] == ["r001"]
    assert (stats["output"], stats["removed_exact_dup"], stats["removed_fuzzy_dup"]) == (1, 1, 1)


def test_counters_come_with_the_pass_that_writes(raw, spark, tmp_path, monkeypatch):
    """One search for near-copies, and the observed counters are those of a pass of its own."""
    searches = []
    search = cleaning.fates
    monkeypatch.setattr(cleaning, "fates", lambda *args, **options: searches.append(1) or search(*args, **options))
    df = raw(
        {"review_text": LONG}, {"review_text": LONG}, {"review_text": LONG + "!"}, {"review_text": "short"},
        {"review_text": "Please click here to see much more of it"}, {"review_text": "Delivered by someone on a rainy morning"},
        {"review_text": None},
    )
    settings = Settings(own_brands=(), as_of="2024-07-01")
    cleaned, seen = cleaning.clean_counted(df, settings)
    cleaned.write.parquet(str(tmp_path / "cleaned"))
    assert len(searches) == 1
    row = cleaning.observed_stats(spark, seen).first()
    assert row == cleaning.cleaning_stats(df, settings).first()
    assert row["output"] == spark.read.parquet(str(tmp_path / "cleaned")).count() == 2
    assert (row["removed_empty"], row["removed_exact_dup"], row["removed_fuzzy_dup"], row["removed_spam"]) == (2, 1, 1, 1)


def test_every_row_has_the_first_reason(raw, spark):
    profiles = language.train_profiles(spark.createDataFrame([("the thing that is here", "en"), ("der und die das ist", "de")], "review_text string, lang string"))
    df = raw(
        {"review_text": "the thing that is good here"}, {"review_text": "das ist der Hund und die Katze"}, {"review_text": "1234567890 1234567890 12"},
        {"review_text": "das ist der Hund, und die Katze"}, {"review_text": "the thing is: click here, click here"},
    )
    settings = Settings(own_brands=(), as_of="2024-07-01")
    judged = cleaning.judge(df, settings, profiles)
    assert {r["review_id"]: r["drop_reason"] for r in judged.collect()} == {
        "r000": None, "r001": "non_english", "r002": None, "r003": "fuzzy_dup", "r004": "spam",
    }
    assert cleaning.cleaning_stats(df.limit(0), settings, profiles).first()["input"] == 0


def test_cleaning_keeps_different_texts_after_one_opening(raw):
    words = [f"word{i}" for i in range(60)]
    opening, other = " ".join(words[:40]), " ".join(words[40:])
    df = raw({"review_text": opening}, {"review_text": f"{opening} {other}"}, {"review_text": f"{opening} {other}!"})
    kept = [
        [r["review_id"] for r in cleaning.clean(df, Settings(own_brands=(), as_of="2024-07-01", near_dup_whole=whole)).orderBy("review_id").collect()]
        for whole in (False, True)
    ]
    assert kept == [["r000"], ["r000", "r001"]]


def test_ends_are_stripped_of_the_same_characters(spark):
    from feedloom.functions.text import strip, strip_ends

    codes = [c for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF] + [0x1F600]
    rows = [(chr(c) + "aé b" + chr(c) * 2,) for c in codes] + [("",), ("  　",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    assert df.filter(~strip(F.col("t")).eqNullSafe(strip_ends(F.col("t")))).count() == 0
