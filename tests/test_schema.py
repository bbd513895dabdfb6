from feedloom.config import THEME_LABELS, THEMES
from feedloom.sources.validation import validate


def one(pair):
    ok, bad = pair
    return ok.count(), bad.collect()


def test_valid_raw_review(raw):
    n, bad = one(validate(raw({}), "raw"))
    assert (n, bad) == (1, [])


def test_rating_out_of_range_is_rejected(raw):
    n, bad = one(validate(raw({"rating": 6.0}, {"rating": 0.5}, {"rating": 1.0}, {"rating": 5.0})))
    assert n == 2
    assert [r["reasons"] for r in bad] == [["rating is not within 1 and 5"]] * 2


def test_defaults_and_missing_fields(raw):
    df = raw({"title": None, "helpful_votes": None, "date": None}, {"brand": None, "source": "blog"})
    ok, bad = validate(df)
    row = ok.first()
    assert (row["title"], row["helpful_votes"], row["date"]) == ("", 0, None)
    assert bad.first()["reasons"] == ["brand is missing", "source is unknown"]


def test_valid_classified_review(labelled):
    n, bad = one(validate(labelled({}), "classified"))
    assert (n, bad) == (1, [])


def test_severity_out_of_range_is_rejected(labelled):
    n, bad = one(validate(labelled({"severity": 6}, {"severity": 5}), "classified"))
    assert n == 1
    assert bad[0]["reasons"] == ["severity is not within 1 and 5"]


def test_labels_are_checked(labelled):
    df = labelled(
        {"primary_theme": "weather"},
        {"sentiment": "angry"},
        {"sentiment_confidence": 1.2},
        {"secondary_themes": ["noise", "weather"]},
        {"key_phrases": None},
    )
    ok, bad = validate(df, "classified")
    assert bad.count() == 4
    assert ok.first()["key_phrases"] == []


def test_every_theme_has_a_label():
    assert list(THEME_LABELS) == THEMES
    assert len(THEMES) == 15
