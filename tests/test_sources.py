import datetime as dt

from feedloom.sources import files, landing, sinks
from pyspark.sql import functions as F

KEYWORDS = (("Acme", ("acme one", "acme")), ("Bolt", ("bolt",)))


def test_dates(spark):
    rows = [
        ("March 5, 2024", "2024-03-05"), ("2024-03-05", "2024-03-05"), ("03/05/2024", "2024-03-05"),
        ("5 March 2024", "2024-03-05"), ("  2024-03-05\n", "2024-03-05"), ("soon", None), ("", None),
        (None, None),
    ]
    df = spark.createDataFrame(rows, "t string, want string")
    got = df.select(landing.parse_date_multi(F.col("t")).cast("string").alias("got"), "want").collect()
    assert all(r["got"] == r["want"] for r in got)


def test_brand_order_and_case(spark):
    df = spark.createDataFrame([("BOLT and Acme",), ("a bolt",), ("none",)], "t string")
    got = [r[0] for r in df.select(landing.detect_brand(F.col("t"), KEYWORDS)).collect()]
    assert got == ["Acme", "Bolt", None]


def test_estimated_rating(spark):
    rows = [("love love it", 4.0), ("worst waste", 2.0), ("great but terrible", 3.0), ("", 3.0)]
    df = spark.createDataFrame(rows, "t string, want double")
    assert all(
        r[0] == r[1] for r in df.select(landing.estimate_rating(F.col("t")), "want").collect()
    )


def test_forum_threads(spark):
    comment = "id string, body string, created_utc long, score long, author string, permalink string"
    schema = (
        "id string, category string, title string, selftext string, created_utc long, score long, "
        f"author string, permalink string, comments array<struct<{comment.replace(' ', ':').replace(',:', ',')}>>"
    )
    long = "x" * 51
    comments = [(f"c{i}", long + (" bolt" if i == 1 else ""), 1704067200, i, None, f"/c{i}") for i in range(25)]
    comments[2] = ("c2", "x" * 50, 1704067200, 2, None, "/c2")
    posts = spark.createDataFrame(
        [
            ("p1", "vacuums", "My Acme One", long + " great", 1704153599, 7, None, "/p1", comments),
            ("p2", "vacuums", "no brand", long, 1704067200, 1, "me", "/p2", comments),
            ("p3", "vacuums", "bolt", None, 1704067200, 1, "me", "/p3", []),
        ],
        schema,
    )
    (post,) = landing.map_posts(posts, KEYWORDS).collect()
    assert (post["review_id"], post["brand"], post["rating"]) == ("reddit_p1", "Acme", 4.0)
    assert post["date"] == dt.date(2024, 1, 1) and post["product_id"] == "reddit_acme_vacuums"
    rows = landing.map_comments(posts, landing.explode_comments(posts), KEYWORDS).collect()
    assert len(rows) == 19
    assert sorted({r["brand"] for r in rows}) == ["Acme", "Bolt"]
    assert all(r["review_id"].startswith("reddit_c_") and len(r["review_id"]) == 41 for r in rows)


def test_catalogue_flattens(spark):
    nested = {"a": {"X": [{"asin": "1", "name": "n1"}, {"asin": "2", "name": "n2"}]}, "b": {"Y": []}}
    rows = landing.catalog_df(spark, nested).collect()
    assert [tuple(r) for r in rows] == [("a", "X", "1", "n1"), ("a", "X", "2", "n2")]


def test_readers(spark, raw, tmp_path):
    path = str(tmp_path / "in")
    sinks.write_reviews(raw({}, {"review_text": "two\nlines é"}), path, "json")
    (tmp_path / "in" / "more.jsonl").write_text('\n{"review_id": "x", "rating": 2}\nnot json\n')
    df = files.read_reviews(spark, path, keep_corrupt=True).cache()
    assert df.count() == 4
    assert df.filter("_corrupt_record is not null").count() == 1
    assert df.filter("review_id = 'r001'").first()["review_text"] == "two\nlines é"
    assert files.read_classified(spark, str(tmp_path / "nowhere")).count() == 0


def test_bad_dates_become_null(spark, tmp_path):
    path = tmp_path / "any.json"
    path.write_text('{"a": 1, "date": "2024-02-03"}\n{"a": 2, "date": "never"}\n')
    got = {r["a"]: r["date"] for r in files.read_any(spark, str(path)).collect()}
    assert got == {1: dt.date(2024, 2, 3), 2: None}


def test_csv_keeps_quotes_and_breaks(spark, raw, tmp_path):
    df = raw({"review_text": 'said "no",\nthen left'}).select("review_id", "review_text", "date")
    sinks.write_csv(df, str(tmp_path / "csv"))
    assert sinks.read_csv(spark, str(tmp_path / "csv"), df.schema).collect() == df.collect()


def test_reports_keep_their_columns(spark, tmp_path):
    from feedloom.sources import files, sinks

    df = spark.createDataFrame([(1, None)], "a int, b date")
    sinks.write_report({"none": df.limit(0), "null": df}, str(tmp_path / "report"))
    assert files.read_report(spark, str(tmp_path / "report"), "none").schema == df.schema
    assert files.read_report(spark, str(tmp_path / "report"), "null").collect() == df.collect()
