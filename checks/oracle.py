"""DuckDB SQL with the same results as the queries, written independently of Spark."""

from __future__ import annotations

from feedloom.config import (
    FAILURE_MODES,
    RISK_SIGNALS,
    SENTIMENTS,
    THEME_LABELS,
    THEMES,
)

from . import bindings as b

SQL: dict[str, str] = {}

WS = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
AS_OF = f"DATE '{b.AS_OF}'"
CATEGORIES = ["economy", "large", "medium", "promo", "small", "standard"]


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def values(items) -> str:
    return "(" + ", ".join(quoted(i) for i in items) + ")"


def array(items) -> str:
    return "[" + ", ".join(quoted(i) for i in items) + "]"


OWN = values(b.OWN_BRANDS)


def rnd(value: str, places: int) -> str:
    """Half-even rounding of the scaled double."""
    scale = f"{10 ** places}.0::DOUBLE"
    return f"(round_even(({value})::DOUBLE * {scale}, 0) / {scale})"


def exact(value: str, places: int) -> str:
    """Rounding of the exact value, as Python's round: a decimal of many digits decides ties."""
    scale, v = f"{10 ** places}.0::DOUBLE", f"({value})::DOUBLE"
    high = f"({v} * 134217729.0::DOUBLE - ({v} * 134217729.0::DOUBLE - {v}))"
    product = f"({v} * {scale})"
    error = f"({high} * {scale} - {product} + ({v} - {high}) * {scale})"
    return (
        f"((CASE WHEN {product} - floor({product}) = 0.5::DOUBLE AND {error} > 0 THEN floor({product}) + 1"
        f" WHEN {product} - floor({product}) = 0.5::DOUBLE AND {error} < 0 THEN floor({product})"
        f" ELSE round_even({product}, 0) END) / {scale})"
    )


def away(value: str, places: int) -> str:
    """Half away from zero on the scaled double."""
    scale = f"{10 ** places}.0::DOUBLE"
    return f"(sign({value}) * floor(abs(({value})::DOUBLE * {scale}) + 0.5::DOUBLE) / {scale})"


def strip(text: str) -> str:
    return rf"regexp_replace({text}, '\A{WS}+|{WS}+\z', '', 'g')"


def collapse(text: str) -> str:
    inner = f"regexp_replace({text}, '{WS}+', ' ', 'g')"
    return strip(inner)


def tokens(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{WS}+'), lambda w: w <> '')"


def has_any(text: str, needles) -> str:
    return "(" + " OR ".join(f"contains({text}, {quoted(n)})" for n in needles) + ")"


def count_present(text: str, needles) -> str:
    return "(" + " + ".join(f"contains({text}, {quoted(n)})::INT" for n in needles) + ")"


def matched(text: str, needles) -> str:
    return f"list_filter({array(needles)}, lambda n: contains({text}, n))"


def label_case(column: str) -> str:
    whens = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in THEME_LABELS.items())
    return f"(CASE {column} {whens} ELSE {column} END)"


def first_label(text: str, labelled) -> str:
    whens = " ".join(f"WHEN {has_any(text, ns)} THEN {quoted(label)}" for label, ns in labelled)
    return f"(CASE {whens} END)"


def draw(key: str, salt: str) -> str:
    return f"('0x' || substr(md5({key} || '|{salt}'), 1, 8))::BIGINT"


def pattern(patterns) -> str:
    """The patterns with Unicode word edges and blanks, which RE2 has to spell out."""
    letter = r"[^\p{L}\p{N}_]"
    parts = []
    for p in patterns:
        p = p.replace(r"\s", WS)
        if p.startswith(r"\b"):
            p = rf"(?:\A|{letter})" + p[2:]
        if p.endswith(r"\b"):
            p = p[:-2] + rf"(?:\z|{letter})"
        parts.append(f"(?:{p})")
    return quoted("(?i)" + "|".join(parts))


def add(name: str, sql: str) -> None:
    SQL[name] = sql


# --- Review tables ------------------------------------------------------------

_FAILURE_BY_PART = " ".join(
    f"WHEN primary_theme = {quoted(theme)} THEN ({array(modes)})[(part_no % {len(modes)}) + 1]"
    for theme, modes in FAILURE_MODES.items()
)

FACT = f"""
WITH fact_base AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS review_id,
         l_partkey::VARCHAR AS product_id,
         p_name || ' ' || (p_partkey % 20)::VARCHAR AS product_name,
         p_brand AS brand, lower(p_type) AS category,
         (1 + l_quantity::INT % 5)::DOUBLE AS stars,
         CASE WHEN l_orderkey % 53 <> 7 THEN stars END AS rating,
         'Order ' || l_orderkey::VARCHAR AS title,
         p_name || ' ' || (p_partkey % 20)::VARCHAR || ' order ' || l_orderkey::VARCHAR
           || ' flag ' || l_returnflag AS review_text,
         CASE WHEN l_orderkey % 61 <> 13 THEN l_shipdate::DATE END AS date,
         CASE WHEN l_orderkey % 67 <> 5 THEN l_linestatus = 'F' END AS verified_purchase,
         l_orderkey % 59 <> 11 AS graded, (l_suppkey % 50)::INT AS helpful_votes,
         l_returnflag AS flag, l_partkey AS part_no,
         ({array(THEMES)})[(l_linenumber * 2 + l_suppkey) % 15 + 1] AS base_theme
  FROM lineitem JOIN part ON l_partkey = p_partkey
), fact_mood AS (
  SELECT *, CASE WHEN graded THEN (6 - stars)::INT END AS severity,
         CASE WHEN stars >= 4 THEN 'positive' WHEN stars <= 2 THEN 'negative'
              WHEN flag = 'R' THEN 'neutral' ELSE 'mixed' END AS sentiment,
         CASE WHEN date >= {AS_OF} - 90 AND part_no % 3 = 0 THEN 'battery'
              ELSE base_theme END AS shifted
  FROM fact_base
), fact_theme AS (
  SELECT *, CASE WHEN sentiment = 'positive' AND brand IN {OWN} AND shifted = 'smell'
                 THEN 'noise' ELSE shifted END AS primary_theme
  FROM fact_mood
), fact AS (
  SELECT *, CASE WHEN sentiment <> 'negative' THEN NULL {_FAILURE_BY_PART} END AS failure_mode
  FROM fact_theme
)"""

TEXT = """
WITH docs AS (
  SELECT d.doc_id::VARCHAR AS review_id, d.doc_id, p_partkey::VARCHAR AS product_id,
         p_name || ' ' || (p_partkey % 20)::VARCHAR AS product_name,
         p_brand AS brand, lower(p_type) AS category,
         (1 + (d.doc_id * 7 + coalesce(quality, 0)) % 5)::DOUBLE AS rating,
         substring(d.text, 1, 40) AS title, d.text AS review_text,
         DATE '2024-01-01' + (d.doc_id % 365)::INT AS date,
         d.doc_id % 4 <> 0 AS verified_purchase, (d.doc_id % 50)::INT AS helpful_votes,
         CASE WHEN d.doc_id % 2 = 0 THEN 'amazon' ELSE 'reddit' END AS source,
         d.lang, lower(d.text) AS low
  FROM documents d LEFT JOIN labels USING (doc_id) JOIN part ON p_partkey = d.doc_id % 200
)"""

_R = b.RULES
_THEME_CASE = " ".join(
    f"WHEN contains(low, {quoted(word)}) THEN {quoted(theme)}"
    for word, theme in _R.theme_keywords.items()
)
_FAILURE_DRAWN = " ".join(
    f"WHEN primary_theme = {quoted(theme)} THEN "
    f"({array(modes)})[{draw('review_id', 'failure' + _R.seed)} % {len(modes)} + 1]"
    for theme, modes in _R.failure_modes.items()
)
_SHARE = f"({draw('review_id', 'confidence' + _R.seed)}::DOUBLE / 4294967296.0::DOUBLE)"

CLASSIFIED = (
    TEXT
    + f""", labelled AS (
  SELECT *, CASE {_THEME_CASE} ELSE {quoted(_R.default_theme)} END AS primary_theme,
         CASE WHEN rating >= 4 THEN 'positive' WHEN rating <= 2 THEN 'negative'
              WHEN rating = 3 THEN 'mixed' ELSE 'neutral' END AS sentiment,
         CASE WHEN {has_any('low', _R.hazard_words)} THEN 5
              ELSE greatest(1, least(5, 6 - floor(rating)::INT)) END AS severity,
         {matched('low', _R.feature_words)} AS features,
         list_transform(list_filter({array(_R.mention_brands)},
             lambda n: contains(low, lower(n)) AND n <> brand),
             lambda n: {{'brand': n, 'context':
                        CASE WHEN rating >= 4 THEN 'favorable' ELSE 'unfavorable' END}}) AS mentions,
         {tokens('review_text')} AS toks
  FROM docs
), classified AS (
  SELECT *, CASE WHEN sentiment <> 'negative' THEN NULL {_FAILURE_DRAWN} END AS failure_mode,
         {rnd(f'''CASE sentiment WHEN 'positive' THEN {_SHARE} * 0.15::DOUBLE + 0.85::DOUBLE
                    WHEN 'negative' THEN {_SHARE} * 0.20::DOUBLE + 0.80::DOUBLE
                    WHEN 'mixed' THEN {_SHARE} * 0.30::DOUBLE + 0.60::DOUBLE
                    ELSE 0.70::DOUBLE END''', 3)} AS sentiment_confidence,
         sentiment = 'negative' AND severity >= 3 AS has_actionable_signal,
         CASE WHEN len(toks) > 5 THEN
           [array_to_string(list_slice(toks,
              {draw('review_id', 'phrase' + _R.seed)} % (least(len(toks) - 5, 10) + 1) + 1,
              {draw('review_id', 'phrase' + _R.seed)} % (least(len(toks) - 5, 10) + 1) + 5), ' ')]
           ELSE []::VARCHAR[] END AS phrases
  FROM labelled
)"""
)

_TIMELINE = (
    r"CASE WHEN failure_mode IS NOT NULL AND regexp_extract(low, '(\d+)\s*months?', 1) <> '' "
    r"THEN regexp_extract(low, '(\d+)\s*months?', 1) || ' months' END"
)
_DETAIL = "CASE WHEN failure_mode IS NOT NULL THEN 'Address reported failure mode' ELSE '' END"

# --- Sources ------------------------------------------------------------------

_RAW = (
    "review_id, product_id, product_name, brand, category, rating, title, review_text, date, "
    "verified_purchase, helpful_votes, source"
)
add("s01_w01_json_round_trip", f"{TEXT} SELECT {_RAW} FROM docs")
add(
    "s02_classified_round_trip",
    f"""{CLASSIFIED} SELECT review_id, primary_theme, sentiment, severity, failure_mode,
    array_to_string(features, '|') AS features_mentioned,
    array_to_string(phrases, '|') AS key_phrases FROM classified""",
)
add("s03_inferred_scan", f"{TEXT} SELECT review_id, rating, date FROM docs")

ITEMS = """
items AS (
  SELECT (doc_id % 200)::VARCHAR AS asin, doc_id AS id,
    CASE WHEN doc_id % 9 <> 0 THEN (doc_id % 5 + 1)::DOUBLE END AS rating,
    CASE WHEN doc_id % 10 <> 0 THEN substring(text, 1, 40) END AS title,
    CASE WHEN doc_id % 4 <> 0 THEN text END AS text,
    CASE WHEN doc_id % 8 <> 0 THEN 'R:' || text END AS review,
    CASE WHEN doc_id % 6 <> 5 THEN DATE '2024-01-01' + (doc_id % 365)::INT END AS date,
    CASE WHEN doc_id % 3 <> 0 THEN doc_id % 2 = 0 END AS verified,
    CASE WHEN doc_id % 7 <> 0 THEN doc_id % 50 END AS votes,
    CASE WHEN doc_id % 2 = 0 THEN source END AS user_name,
    CASE WHEN doc_id % 5 = 0 THEN 'https://shop.example/' || doc_id::VARCHAR END AS url
  FROM documents
), marketplace AS (
  SELECT 'amz_' || asin || '_' || id::VARCHAR AS review_id, asin AS product_id,
    p_name || ' ' || (p_partkey % 20)::VARCHAR AS product_name, p_brand AS brand,
    lower(p_type) AS category, coalesce(rating, 0.0::DOUBLE) AS rating,
    coalesce(title, '') AS title, coalesce(text, review, '') AS review_text, date,
    coalesce(verified, false) AS verified_purchase, coalesce(votes, 0)::INT AS helpful_votes,
    'amazon' AS source, coalesce(user_name, '') AS reviewer_name,
    coalesce(url, 'https://amazon.com/dp/' || asin) AS source_url
  FROM items JOIN part ON asin = p_partkey::VARCHAR
)"""


def forum_review(key: str, brand: str, body: str, title: str) -> str:
    pos, neg = count_present(f"lower({body})", b.POSITIVE), count_present(f"lower({body})", b.NEGATIVE)
    return f"""{key} AS review_id, 'reddit_' || lower({brand}) || '_' || category AS product_id,
    {brand} || ' (Reddit mention)' AS product_name, {brand} AS brand, category,
    (CASE WHEN {pos} > {neg} THEN 4.0 WHEN {pos} < {neg} THEN 2.0 ELSE 3.0 END)::DOUBLE AS rating,
    {title} AS title, substring({body}, 1, 3000) AS review_text,
    epoch_ms(created_utc * 1000)::DATE AS date, false AS verified_purchase,
    score::INT AS helpful_votes, 'reddit' AS source, author AS reviewer_name,
    'https://reddit.com' || permalink AS source_url"""


FORUM = f"""
posts AS (
  SELECT conv_id::VARCHAR AS id, 'f' || (conv_id % 5)::VARCHAR AS forum,
    CASE WHEN conv_id % 2 = 0 THEN 'economy' ELSE 'small' END AS category,
    substring(text, 1, 120) AS title, CASE WHEN conv_id % 10 <> 0 THEN text END AS selftext,
    1704067200 + conv_id * 7200 AS created_utc, conv_id % 100 AS score, role AS author,
    '/r/f/' || conv_id::VARCHAR AS permalink
  FROM conversations WHERE turn = 0
), branded AS (
  SELECT * FROM (SELECT *, {first_label("lower(title || ' ' || coalesce(selftext, ''))", b.BRAND_WORDS)} AS post_brand FROM posts)
  WHERE post_brand IS NOT NULL
), comments AS (
  SELECT conv_id::VARCHAR AS post_id, turn - 1 AS position,
    conv_id::VARCHAR || '_' || turn::VARCHAR AS id, text AS body,
    1704067200 + conv_id * 7200 + turn * 60 AS created_utc, turn * 3 AS score, role AS author,
    '/r/f/' || conv_id::VARCHAR || '_' || turn::VARCHAR AS permalink
  FROM conversations WHERE turn > 0
), post_reviews AS (
  SELECT {forum_review("'reddit_' || id", "post_brand", "selftext", "title")}
  FROM branded WHERE length(selftext) > 50
), owned AS (
  SELECT c.*, b.title AS post_title, b.category,
    coalesce({first_label("lower(c.body)", b.BRAND_WORDS)}, b.post_brand) AS own_brand
  FROM comments c JOIN branded b ON c.post_id = b.id
  WHERE c.position < 3 AND length(c.body) > 50
), comment_reviews AS (
  SELECT {forum_review("'reddit_c_' || md5(id)", "own_brand", "body", "substring(post_title, 1, 100)")}
  FROM owned
)"""
add("s05_marketplace_items", f"WITH {ITEMS} SELECT * FROM marketplace")
add(
    "s06_latest_per_product",
    f"""{FACT} SELECT product_id, review_id, date FROM fact
    QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY date DESC NULLS LAST, review_id) <= 10""",
)
add("s07_parse_dates", f"WITH {ITEMS} SELECT id, date FROM items")
add("s08_forum_posts", f"WITH {FORUM} SELECT * FROM post_reviews")
add("s09_forum_comments", f"WITH {FORUM} SELECT * FROM comment_reviews")
add(
    "s10_first_label",
    f"{TEXT} SELECT review_id, {first_label('low', b.BRAND_WORDS)} AS label FROM docs",
)
_POS, _NEG = count_present("low", b.POSITIVE), count_present("low", b.NEGATIVE)
add(
    "s11_estimate_rating",
    f"""{TEXT} SELECT review_id, {_POS} AS positive, {_NEG} AS negative,
    (CASE WHEN {_POS} > {_NEG} THEN 4 WHEN {_POS} < {_NEG} THEN 2 ELSE 3 END)::DOUBLE AS estimate
    FROM docs""",
)
_FORUM_ROWS = ", ".join(
    f"({quoted(c)}, {quoted(f)}, {quoted(c + ' review')})"
    for c, forums in b.FORUMS.items()
    for f in forums
)
add(
    "s12_forum_sources",
    f"""WITH chosen(category, forum, query) AS (VALUES {_FORUM_ROWS})
    SELECT conv_id::VARCHAR AS id, forum, category, query
    FROM conversations JOIN chosen ON forum = 'f' || (conv_id % 5)::VARCHAR WHERE turn = 0""",
)
add(
    "s13_catalog",
    """SELECT lower(p_type) AS category, p_brand AS brand, p_partkey::VARCHAR AS product_id,
    p_name || ' ' || (p_partkey % 20)::VARCHAR AS product_name FROM part""",
)
add(
    "s14_union_sources",
    f"""WITH {ITEMS}, {FORUM} SELECT * FROM marketplace
    UNION ALL SELECT * FROM post_reviews UNION ALL SELECT * FROM comment_reviews""",
)
add(
    "s15_validate_raw",
    f"""{TEXT}, broken AS (
      SELECT review_id,
        CASE WHEN doc_id % 6 = 0 THEN rating + 1 WHEN doc_id % 13 <> 0 THEN rating END AS rating,
        CASE WHEN doc_id % 8 = 0 THEN 'blog' ELSE source END AS source,
        CASE WHEN doc_id % 9 <> 0 THEN brand END AS brand,
        CASE WHEN doc_id % 10 <> 0 THEN title ELSE '' END AS title,
        CASE WHEN doc_id % 3 <> 0 THEN helpful_votes ELSE 0 END AS helpful_votes
      FROM docs)
    SELECT review_id, title, helpful_votes, concat_ws('|',
      CASE WHEN brand IS NULL THEN 'brand is missing' END,
      CASE WHEN rating IS NULL THEN 'rating is missing' END,
      CASE WHEN source = 'blog' THEN 'source is unknown' END,
      CASE WHEN rating > 5 THEN 'rating is not within 1 and 5' END) AS reasons
    FROM broken""",
)
add(
    "s15_validate_classified",
    f"""{CLASSIFIED} SELECT review_id, concat_ws('|',
      CASE WHEN doc_id % 11 = 0 THEN 'sentiment is missing' END,
      CASE WHEN doc_id % 7 = 0 THEN 'primary_theme is unknown' END,
      CASE WHEN doc_id % 5 = 0 THEN 'severity is not within 1 and 5' END) AS reasons
    FROM classified""",
)
add("w03_csv_round_trip", f"{TEXT} SELECT review_id, brand, rating, date, review_text FROM docs")

# --- Cleaning -----------------------------------------------------------------

_LONG = f"length({strip('review_text')}) >= 20"
_HASH = f"md5({strip('low')})"
add("c01_drop_short", f"{TEXT} SELECT review_id FROM docs WHERE {_LONG}")
add(
    "c02_dedup_exact",
    f"""{TEXT} SELECT review_id, length(review_text)::INT AS chars FROM docs WHERE {_LONG}
    QUALIFY row_number() OVER (PARTITION BY {_HASH} ORDER BY doc_id) = 1""",
)


def padded(text: str) -> str:
    return rf"' ' || trim(regexp_replace(lower({text}), '[^\p{{L}}]+', ' ', 'g')) || ' '"


def grams(text: str) -> str:
    """Trigrams of a text that is split into `{text}_c`: around every letter."""
    c = f"{text}_c"
    return (
        f"list_transform(list_filter(range(2, greatest(len({c}), 2)), lambda i: {c}[i] <> ' '), "
        f"lambda i: {c}[i - 1] || {c}[i] || {c}[i + 1])"
    )


def profiles_of(rows: str) -> str:
    return f"""
padded AS (SELECT review_id, lang, string_split({padded('review_text')}, '') AS p_c
           FROM docs),
counted AS (SELECT lang, gram, count(*) AS n FROM (
              SELECT lang, unnest({grams('p')}) AS gram FROM padded WHERE lang IS NOT NULL AND {rows}) GROUP BY ALL),
listed AS (SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram)::INT AS rank,
      ln(n / sum(n) OVER (PARTITION BY lang)) AS share FROM counted) WHERE rank <= 300),
profiles AS (SELECT lang, gram, rank, (floor((share - min(share) OVER ()) * 1000 + 0.5) + 1000)::BIGINT AS gain
  FROM listed)"""


PROFILES = profiles_of("true")

def detected(text: str) -> str:
    return f"""
seen AS (SELECT review_id, gram, count(*) AS uses FROM (
           SELECT review_id, unnest({grams(text)}) AS gram FROM padded) GROUP BY ALL),
scores AS (SELECT review_id, profiles.lang AS guess, sum(uses * gain) AS score
           FROM seen JOIN profiles USING (gram) GROUP BY ALL),
best AS (SELECT review_id, guess FROM scores
         QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY score DESC, guess) = 1)"""


add("c04_language_profiles", f"{TEXT}, {PROFILES} SELECT lang, gram, rank, gain FROM profiles")
add(
    "c04_filter_language",
    f"""{TEXT}, {PROFILES}, {detected('p')}
    SELECT review_id, lang FROM docs LEFT JOIN best USING (review_id)
    WHERE coalesce(guess, 'en') = 'en'""",
)
add(
    "c04_detect_whole_text",
    f"""{TEXT}, {PROFILES}, {detected('p')}
    SELECT review_id, lang, guess AS detected_lang FROM docs LEFT JOIN best USING (review_id)""",
)
add(
    "c04_judged_on_other_rows",
    f"""{TEXT}, {profiles_of('review_id::BIGINT % 3 <> 1')}, {detected('p')}
    SELECT lang, guess AS detected_lang, count(*) AS reviews FROM docs LEFT JOIN best USING (review_id)
    WHERE review_id::BIGINT % 3 = 1 GROUP BY ALL""",
)
_SPAM = f"regexp_matches(review_text, {pattern(b.SPAM)})"
_TOKS = tokens("low")
_REPETITIVE = (
    f"(len({_TOKS}) > 10 AND len(list_distinct({_TOKS}))::DOUBLE / len({_TOKS})::DOUBLE < 0.3)"
)


def shouting(text: str) -> str:
    return (
        f"(length({text}) < 30 AND rating = 5 "
        f"AND length({text}) - length(replace({text}, '!', '')) > 3)"
    )


_SHIPPING = (
    f"(regexp_matches(review_text, {pattern(b.SHIPPING)}) "
    f"AND NOT regexp_matches(review_text, {pattern(b.PRODUCT)}))"
)
_UNWANTED = f"({_SPAM} OR {shouting('review_text')} OR {_REPETITIVE})"
add("c05_spam_regex", f"{TEXT} SELECT review_id, {_SPAM} AS is_spam FROM docs")
add(
    "c06_c07_bot_rules",
    f"""{TEXT} SELECT review_id, {shouting('review_text')} AS is_shouting,
    {_REPETITIVE} AS is_repetitive FROM docs""",
)
_RECURSIVE = TEXT.replace("WITH docs", "WITH RECURSIVE docs", 1)
# How many characters two texts share from places x and y on, by falling powers of two.
_SHARED = """list_reduce([65536, 32768, 16384, 8192, 4096, 2048, 1024, 512, 256, 128, 64, 32, 16, 8, 4, 2, 1],
    lambda got, s: CASE WHEN x + got + s <= na AND y + got + s <= nb
      AND substring(a, x + got + 1, s) = substring(b, y + got + 1, s) THEN got + s ELSE got END, 0)"""


def near(whole: bool) -> str:
    """Near-duplicates. A pair within the bound shares a block of six characters; the exact
    ratio of those that pass the bounded edit distance is computed row by row.

    Of whole texts the edit distance tells most pairs apart, as it is between half the number of
    insertions and deletions and that number; the rest are walked along furthest-reaching diagonals.
    """
    body = strip("low")
    key = "body" if whole else "head"
    confirmed = f"""
bodies AS (SELECT later, earlier, a.body AS a, b.body AS b, a.size::INT AS na, b.size::INT AS nb,
    ((a.size + b.size) * 5 - 1) // 100 AS most FROM close
  JOIN heads a ON a.doc_id = later JOIN heads b ON b.doc_id = earlier),
measured AS MATERIALIZED (SELECT *, CASE WHEN abs(na - nb) > most THEN most + 1 ELSE levenshtein(a, b) END AS least
  FROM bodies WHERE greatest(na, nb) > 200),
open AS MATERIALIZED (SELECT * FROM measured WHERE least <= most AND 2 * least > most),
diagonals AS (
  SELECT later, earlier, 0 AS d, [{_SHARED}] AS reach FROM (SELECT *, 0 AS x, 0 AS y FROM open)
  UNION ALL
  SELECT later, earlier, d + 1, list_transform(range(0, d + 2), lambda i: list_transform([greatest(
        CASE WHEN i > 0 THEN reach[i] + 1 ELSE 0 END, CASE WHEN i <= d THEN reach[i + 1] ELSE 0 END)::INT],
      lambda x: list_transform([(x - (2 * i - d - 1))::INT],
        lambda y: CASE WHEN x > na OR y > nb THEN x ELSE x + {_SHARED} END)[1])[1])
  FROM diagonals JOIN open USING (later, earlier)
  WHERE d < most AND len(list_filter(range(0, d + 1), lambda i: reach[i + 1] >= na AND reach[i + 1] - (2 * i - d) >= nb)) = 0),
ended AS (SELECT DISTINCT later, earlier FROM diagonals JOIN open USING (later, earlier)
  WHERE len(list_filter(range(0, d + 1), lambda i: reach[i + 1] >= na AND reach[i + 1] - (2 * i - d) >= nb)) > 0),
pairs AS MATERIALIZED (SELECT later, earlier FROM bodies WHERE greatest(na, nb) <= 200
  UNION ALL SELECT later, earlier FROM measured WHERE 2 * least <= most
  UNION ALL SELECT later, earlier FROM ended),"""
    plain = "pairs AS MATERIALIZED (SELECT later, earlier FROM close),"
    return f"""
firsts AS (SELECT * FROM (SELECT *, {body} AS body, substring({body}, 1, 200) AS head FROM docs WHERE {_LONG})
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY doc_id) = 1),
heads AS (SELECT doc_id, head, length(head) AS n, body, length({key}) AS size FROM firsts),
cut AS (SELECT doc_id, n, size, substring(head, k * 6 + 1, 6) AS block
  FROM (SELECT *, unnest(range(0, n // 6)) AS k FROM heads)),
slid AS (SELECT DISTINCT doc_id, n, size, substring(head, p, 6) AS block
  FROM (SELECT *, unnest(range(1, n - 4)) AS p FROM heads)),
met AS (SELECT DISTINCT greatest(c.doc_id, s.doc_id) AS later, least(c.doc_id, s.doc_id) AS earlier
  FROM cut c JOIN slid s USING (block) WHERE c.doc_id <> s.doc_id
    AND abs(c.n - s.n) <= ((c.n + s.n) * 5 - 1) // 100 AND abs(c.size - s.size) <= ((c.size + s.size) * 5 - 1) // 100),
bounded AS MATERIALIZED (SELECT later, earlier, a.head AS ha, b.head AS hb, a.n AS na, b.n AS nb
  FROM met JOIN heads a ON a.doc_id = later JOIN heads b ON b.doc_id = earlier
  WHERE levenshtein(a.head, b.head) <= ((a.n + b.n) * 5 - 1) // 100),
common AS (SELECT *, list_reduce(
    list_transform(string_split(ha, ''), lambda c: list_transform(string_split(hb, ''), lambda d: (c = d)::INT)),
    lambda prev, eq: list_transform(range(1, nb + 1), lambda j: list_max(list_transform(range(1, j + 1),
      lambda k: greatest(prev[k], coalesce(prev[k - 1], 0) + eq[k])))::INT),
    list_transform(range(0, nb), lambda j: 0)) AS row FROM bounded WHERE ha <> hb),
close AS MATERIALIZED (SELECT later, earlier FROM common WHERE list_last(row) * 200 > (na + nb) * 95
  UNION ALL SELECT later, earlier FROM bounded WHERE ha = hb),
{confirmed if whole else plain}
laters AS (SELECT later, list(earlier) AS es, row_number() OVER (ORDER BY later) AS i FROM pairs GROUP BY later),
walk AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS dropped
  UNION ALL
  SELECT l.i, CASE WHEN len(list_filter(l.es, lambda e: NOT list_contains(w.dropped, e))) > 0
    THEN list_append(w.dropped, l.later) ELSE w.dropped END
  FROM walk w JOIN laters l ON l.i = w.i + 1),
near AS (SELECT unnest(dropped) AS doc_id FROM (SELECT dropped FROM walk ORDER BY i DESC LIMIT 1)),
unique_docs AS (SELECT * FROM firsts WHERE doc_id NOT IN (SELECT doc_id FROM near))"""


NEAR, NEAR_WHOLE = near(False), near(True)
add("c03_dedup_fuzzy", f"{_RECURSIVE}, {NEAR} SELECT review_id FROM unique_docs")
add("c03_dedup_whole", f"{_RECURSIVE}, {NEAR_WHOLE} SELECT review_id FROM unique_docs")
add(
    "c12_clean",
    rf"""{_RECURSIVE}, {NEAR_WHOLE}, {PROFILES}, {detected('p')}
    SELECT review_id, {collapse('title')} AS title,
      regexp_replace({collapse('review_text')}, '[^\x20-\x7E\n]', '', 'g') AS review_text,
      {_SHIPPING} AS is_shipping_only
    FROM unique_docs LEFT JOIN best USING (review_id)
    WHERE coalesce(guess, 'en') = 'en' AND NOT {_UNWANTED}""",
)
add("c08_remove_spam", f"{TEXT} SELECT review_id FROM docs WHERE NOT {_UNWANTED}")
add("c09_flag_shipping", f"{TEXT} SELECT review_id, {_SHIPPING} AS is_shipping_only FROM docs")
add(
    "c10_normalize_text",
    rf"""{TEXT} SELECT review_id, {collapse('title')} AS title,
    regexp_replace({collapse('review_text')}, '[^\x20-\x7E\n]', '', 'g') AS review_text FROM docs""",
)
add(
    "c11_cleaning_stats",
    f"""{_RECURSIVE}, {NEAR_WHOLE}, {PROFILES}, {detected('p')},
    kept AS (
      SELECT * FROM docs WHERE {_LONG}
      QUALIFY row_number() OVER (PARTITION BY {_HASH} ORDER BY doc_id) = 1),
    apart AS (SELECT * FROM kept WHERE doc_id IN (SELECT doc_id FROM unique_docs)),
    local AS (SELECT apart.* FROM apart LEFT JOIN best USING (review_id) WHERE coalesce(guess, 'en') = 'en'),
    n AS (SELECT (SELECT count(*) FROM docs) AS input,
      (SELECT count(*) FROM docs WHERE {_LONG}) AS valid,
      (SELECT count(*) FROM kept) AS kept, (SELECT count(*) FROM apart) AS apart,
      (SELECT count(*) FROM local) AS local,
      (SELECT count(*) FROM local WHERE {_UNWANTED}) AS spam,
      (SELECT count(*) FROM local WHERE NOT {_UNWANTED} AND {_SHIPPING}) AS shipping)
    SELECT input, input - valid AS removed_empty, valid - kept AS removed_exact_dup,
      kept - apart AS removed_fuzzy_dup, apart - local AS removed_non_english, spam AS removed_spam,
      shipping AS flagged_shipping, local - spam AS output,
      {rnd('(local - spam)::DOUBLE / input::DOUBLE * 100', 1)} AS retention_rate FROM n""",
)

# --- Classification -----------------------------------------------------------

_PROMPT = (
    "'Product: ' || product_name || chr(10) || 'Brand: ' || brand || chr(10) || 'Category: ' || "
    "category || chr(10) || 'Rating: ' || rating::VARCHAR || '/5' || chr(10) || 'Title: ' || title "
    "|| chr(10) || 'Review:' || chr(10) || review_text"
)
_STRONG = (
    f"(rating = 3 OR length(review_text) > 1000 "
    f"OR ({has_any('low', b.HEDGE_WORDS)} AND rating IN (2, 4)))"
)
_MODEL = f"CASE WHEN {_STRONG} THEN 'strong' ELSE 'base' END"
add(
    "k01_prompt",
    f"{TEXT} SELECT review_id, md5({_PROMPT}) AS prompt_md5, length({_PROMPT})::INT AS chars FROM docs",
)
add("k02_route", f"{TEXT} SELECT review_id, {_MODEL} AS model FROM docs")
add(
    "k05_infer",
    f"""{TEXT} SELECT review_id,
    CASE WHEN rating > 3 THEN '{{"sentiment": "positive"}}'
         WHEN rating < 3 THEN '{{"sentiment": "negative"}}' END AS response,
    CASE WHEN rating = 3 THEN 'ValueError: undecided' END AS failed_reason FROM docs""",
)

# What each answer holds follows from how `bindings.responses` writes it.
RESPONSES = f"""
WITH answers AS (
  SELECT doc_id, coalesce(text, '') AS text, doc_id::VARCHAR AS review_id, doc_id % 8 NOT IN (1, 2) AS readable,
    ({array(THEMES + ['weather'])})[doc_id % 16 + 1] AS theme,
    (['positive','negative','mixed','neutral','angry'])[doc_id % 5 + 1] AS mood,
    CASE WHEN doc_id % 11 = 0 THEN 3 WHEN doc_id % 7 = 0 THEN 9 WHEN doc_id % 7 = 1 THEN NULL
         WHEN doc_id % 7 = 2 THEN 3 WHEN doc_id % 7 = 3 THEN NULL
         ELSE doc_id % 9 - 1 END AS raw_severity,
    CASE WHEN doc_id % 10 = 0 THEN 1.5 ELSE (doc_id % 90 + 10) / 100.0::DOUBLE END AS confidence
  FROM documents)"""
add(
    "k03_parse_response",
    f"""{RESPONSES} SELECT review_id, NOT readable AS parse_error,
    CASE WHEN readable THEN theme END AS theme FROM answers""",
)
add(
    "k04_coerce",
    f"""{RESPONSES} SELECT review_id,
    CASE WHEN NOT readable THEN 'unreadable response'
         WHEN confidence > 1 THEN 'sentiment_confidence'
         WHEN raw_severity IS NULL THEN 'severity' END AS failed_reason,
    CASE WHEN NOT readable OR theme = 'weather' THEN 'usability' ELSE theme END AS primary_theme,
    CASE WHEN readable AND doc_id % 3 = 0 THEN 'noise' ELSE '' END AS secondary_themes,
    CASE WHEN NOT readable OR mood = 'angry' THEN 'neutral' ELSE mood END AS sentiment,
    CASE WHEN readable THEN confidence ELSE 0.5 END::DOUBLE AS sentiment_confidence,
    CASE WHEN readable THEN CASE WHEN raw_severity IS NOT NULL
         THEN greatest(1, least(5, raw_severity)) END ELSE 3 END::INT AS severity,
    readable AND doc_id % 2 = 0 AS has_actionable_signal,
    CASE WHEN readable AND doc_id % 2 = 0 THEN text ELSE '' END AS actionable_detail,
    CASE WHEN readable AND doc_id % 2 = 0 THEN 'n ' || review_id || '|m' ELSE '' END AS key_phrases
    FROM answers""",
)
add(
    "k06_split_cached",
    f"""{TEXT}, keyed AS (
      SELECT *, sha256({_MODEL} || chr(31) || {_PROMPT} || chr(31) || '') AS cache_key FROM docs)
    SELECT review_id, cache_key,
      CASE WHEN cache_key IN (SELECT cache_key FROM keyed WHERE doc_id % 3 = 0)
           THEN substr(cache_key, 1, 8) END AS response FROM keyed""",
)
_IN = "CASE model WHEN 'base' THEN 0.80::DOUBLE ELSE 3.00::DOUBLE END"
_OUT = "CASE model WHEN 'base' THEN 4.00::DOUBLE ELSE 15.00::DOUBLE END"
CALLS = f"""
WITH calls AS (
  SELECT event_id AS call_id, (['base','strong','other'])[event_id % 3 + 1] AS model,
    200 + user_id % 1000 AS input_tokens, 50 + event_id % 250 AS output_tokens FROM events
), priced AS (
  SELECT *, ((input_tokens * ({_IN}) + output_tokens * ({_OUT})) / 1000000) AS cost FROM calls
)"""
add(
    "k07_call_cost",
    f"{CALLS} SELECT call_id, model, cost::DECIMAL(18,6)::DOUBLE AS cost_usd FROM priced",
)
add(
    "k07_cost_breakdown",
    f"""{CALLS} SELECT model, count(*) AS calls, sum(input_tokens)::BIGINT AS input_tokens,
    sum(output_tokens)::BIGINT AS output_tokens,
    (sum(input_tokens)::DOUBLE * ({_IN}) + sum(output_tokens)::DOUBLE * ({_OUT})) / 1000000 AS cost_usd
    FROM calls GROUP BY model""",
)
add(
    "k08_within_budget",
    f"""{CALLS}, spent AS (
      SELECT call_id, coalesce(sum(cost::DECIMAL(38,9)) OVER (ORDER BY call_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM priced)
    SELECT call_id, before::DECIMAL(18,6)::DOUBLE AS spent_before FROM spent WHERE before < 3""",
)
add(
    "k09_sample",
    f"{FACT} SELECT review_id, brand FROM fact ORDER BY md5(review_id || '|42'), review_id LIMIT 100",
)
_AGREE = {
    "primary_theme": "t1 IS NOT DISTINCT FROM t2",
    "sentiment": "s1 IS NOT DISTINCT FROM s2",
    "severity_exact": "coalesce(v1, 3) = coalesce(v2, 3)",
    "severity_within_1": "abs(coalesce(v1, 3) - coalesce(v2, 3)) <= 1",
}
add(
    "k09_consistency",
    f"""{FACT}, first AS (
      SELECT review_id, primary_theme AS t1, CASE WHEN helpful_votes <> 7 THEN sentiment END AS s1,
        CASE WHEN helpful_votes <> 8 THEN severity END AS v1, helpful_votes AS h FROM fact),
    second AS (
      SELECT review_id, CASE WHEN h % 10 = 0 THEN 'safety' ELSE t1 END AS t2,
        CASE WHEN h % 4 = 0 THEN 'neutral' ELSE s1 END AS s2,
        CASE WHEN h % 3 = 0 THEN v1 + 1 WHEN h % 3 = 1 THEN v1 + 2 ELSE v1 END AS v2 FROM first),
    both_passes AS (SELECT * FROM first JOIN second USING (review_id)),
    long AS ("""
    + " UNION ALL ".join(
        f"SELECT {quoted(n)} AS field, count(*) AS sample_size, "
        f"count(*) FILTER ({c}) AS agreements FROM both_passes"
        for n, c in _AGREE.items()
    )
    + """) SELECT *, agreements::DOUBLE / sample_size::DOUBLE AS rate,
    CASE WHEN agreements::DOUBLE / sample_size >= 0.8 THEN 'PASS'
         WHEN agreements::DOUBLE / sample_size >= 0.7 THEN 'WARN' ELSE 'FAIL' END AS status FROM long""",
)
add(
    "k10_rule_labels",
    f"""{CLASSIFIED} SELECT review_id, primary_theme, sentiment, sentiment_confidence, severity,
    failure_mode, {_TIMELINE} AS failure_timeline, has_actionable_signal,
    {_DETAIL} AS actionable_detail FROM classified""",
)
add(
    "k10_rule_lists",
    f"""{CLASSIFIED} SELECT review_id,
    array_to_string(list_transform(mentions, lambda m: m.brand || ':' || m.context), '|')
      AS competitor_mentions,
    array_to_string(phrases, '|') AS key_phrases,
    array_to_string(features, '|') AS features_mentioned FROM classified""",
)

# --- Quality ------------------------------------------------------------------

CHECKED = (
    CLASSIFIED
    + """, checked AS (
  SELECT * REPLACE (
    CASE WHEN doc_id % 4 = 0 THEN [title || ' zzz qqq', brand || ' xx yy'] ELSE phrases END AS phrases,
    CASE WHEN doc_id % 4 = 0 THEN [brand, 'of zzz'] ELSE features END AS features,
    CASE WHEN doc_id % 4 = 0 THEN 'positive' ELSE sentiment END AS sentiment)
  FROM classified)"""
)
_PW = tokens("lower(phrase)")
PHRASES = f""", phrase_rows AS (
  SELECT *, contains(low, lower(phrase)) OR
    len(list_filter({_PW}, lambda w: contains(low, w)))::DOUBLE / greatest(len({_PW}), 1) >= 0.7
      AS grounded
  FROM (SELECT review_id, low, review_text, unnest(phrases) AS phrase,
        generate_subscripts(phrases, 1) AS position FROM checked))"""
_FW = tokens("lower(feature)")
FEATURES = f""", feature_rows AS (
  SELECT *, contains(low, lower(feature)) OR
    len(list_filter({_FW}, lambda w: contains(low, w))) > 0 AS grounded
  FROM (SELECT low, unnest(features) AS feature FROM checked))"""
_ALIGNED = (
    "((rating >= 4 AND sentiment IN ('positive','mixed','neutral')) OR "
    "(rating <= 2 AND sentiment IN ('negative','mixed')) OR "
    "(rating = 3 AND sentiment IN ('mixed','neutral')))"
)
_PR = "(count(*) FILTER (grounded))::DOUBLE / greatest(count(*), 1)"
add(
    "e01_phrase_grounding",
    f"""{CHECKED}{PHRASES} SELECT count(*) AS total_phrases, count(*) FILTER (grounded) AS grounded,
    count(*) FILTER (NOT grounded) AS hallucinated,
    CASE WHEN {_PR} >= 0.9 THEN 'PASS' WHEN {_PR} >= 0.8 THEN 'WARN' ELSE 'FAIL' END AS status,
    {rnd(_PR, 4)} AS grounding_rate FROM phrase_rows""",
)
add(
    "e01_ungrounded_examples",
    f"""{CHECKED}{PHRASES} SELECT review_id, phrase, substring(review_text, 1, 200) AS text_snippet
    FROM phrase_rows WHERE NOT grounded ORDER BY review_id, position LIMIT 10""",
)
add(
    "e02_feature_grounding",
    f"""{CHECKED}{FEATURES} SELECT count(*) AS total, count(*) FILTER (grounded) AS grounded,
    CASE WHEN {_PR} >= 0.85 THEN 'PASS' ELSE 'WARN' END AS status, {rnd(_PR, 4)} AS rate
    FROM feature_rows""",
)
_AR = f"(count(*) FILTER ({_ALIGNED}))::DOUBLE / greatest(count(*), 1)"
add(
    "e03_rating_alignment",
    f"""{CHECKED} SELECT count(*) FILTER ({_ALIGNED}) AS aligned,
    count(*) FILTER (NOT {_ALIGNED}) AS misaligned,
    CASE WHEN {_AR} >= 0.75 THEN 'PASS' ELSE 'WARN' END AS status, {rnd(_AR, 4)} AS rate
    FROM checked""",
)
add(
    "e03_misaligned_examples",
    f"""{CHECKED} SELECT review_id, rating, sentiment, substring(review_text, 1, 100) AS snippet
    FROM checked WHERE NOT {_ALIGNED} ORDER BY review_id LIMIT 5""",
)
SEVERITIES = f"""severities AS (
  SELECT severity, count(*) AS reviews,
    {rnd('count(*)::DOUBLE / (sum(count(*)) OVER ())::DOUBLE', 3)} AS share
  FROM {{source}} GROUP BY severity)"""
add(
    "e04_severity_distribution",
    f"""{FACT}, {SEVERITIES.format(source='fact')}
    SELECT *, max(share) OVER () AS max_concentration,
    CASE WHEN max(share) OVER () < 0.6 THEN 'PASS' ELSE 'WARN' END AS status FROM severities""",
)


def share_of(condition: str) -> str:
    return rnd(f"(count(*) FILTER ({condition}))::DOUBLE / count(*)", 4)


add(
    "e05_coverage",
    f"""{CHECKED} SELECT {share_of("primary_theme <> ''")} AS has_primary_theme,
    {share_of('len(features) > 0')} AS has_features,
    {share_of("failure_mode <> ''")} AS has_failure_mode,
    {share_of('len(phrases) > 0')} AS has_key_phrases,
    {share_of('has_actionable_signal')} AS has_actionable,
    {share_of('len(mentions) > 0')} AS has_competitor_mention,
    {share_of('false')} AS shipping_complaints FROM checked""",
)
add(
    "e06_quality_issues",
    f"""{CHECKED}{PHRASES}{FEATURES}, {SEVERITIES.format(source='checked')}, checks AS (
      SELECT 'phrase_grounding' AS "check", {_PR} AS raw, 0.9 AS good, 0.8 AS fair FROM phrase_rows
      UNION ALL SELECT 'feature_grounding', {_PR}, 0.85, NULL FROM feature_rows
      UNION ALL SELECT 'rating_alignment', {_AR}, 0.75, NULL FROM checked)
    SELECT "check", {rnd('raw', 4)} AS rate,
      CASE WHEN fair IS NULL OR raw >= fair THEN 'WARN' ELSE 'FAIL' END AS status
    FROM checks WHERE raw < good
    UNION ALL SELECT 'severity_concentration', max(share), 'WARN' FROM severities
    HAVING max(share) >= 0.6""",
)

# --- Analysis -----------------------------------------------------------------

_MEAN = "sum({0})::DOUBLE / count({0})::DOUBLE"
_RATING, _SEVERITY = _MEAN.format("rating"), _MEAN.format("severity")
_NEG_SHARE = "(count(*) FILTER (sentiment = 'negative'))::DOUBLE / count(*)::DOUBLE"
_POS_SHARE = "(count(*) FILTER (sentiment = 'positive'))::DOUBLE / count(*)::DOUBLE"
_VER_SHARE = "(count(*) FILTER (verified_purchase))::DOUBLE / count(verified_purchase)::DOUBLE"
_ISSUES = "sentiment IN ('negative', 'mixed')"

add(
    "a01_summary_stats",
    f"""{FACT} SELECT count(*) AS total_reviews, count(DISTINCT category) AS categories,
    count(DISTINCT brand) AS brands, min(date) AS min_date, max(date) AS max_date,
    {_VER_SHARE} AS verified_purchase_rate FROM fact""",
)
add("a02_avg_rating_by_brand", f"{FACT} SELECT brand, {rnd(_RATING, 2)} AS avg_rating FROM fact GROUP BY 1")
for _c in ("category", "brand", "sentiment"):
    add(f"a03_counts_by_{_c}", f"{FACT} SELECT {_c}, count(*) AS reviews FROM fact GROUP BY 1")

SCORES = f"""
issue_rows AS (SELECT * FROM fact WHERE {_ISSUES}),
modes AS (SELECT category, brand, primary_theme, failure_mode AS top_failure_mode FROM (
    SELECT category, brand, primary_theme, failure_mode, count(*) AS n FROM issue_rows
    WHERE failure_mode IS NOT NULL GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY category, brand, primary_theme
                             ORDER BY n DESC, failure_mode) = 1),
sums AS (SELECT category, brand, primary_theme, count(*) AS frequency, {_SEVERITY} AS sev,
    coalesce(exp(-(sum({AS_OF} - date)::DOUBLE / count(date)::DOUBLE) / 180.0::DOUBLE), 0.5) AS rec,
    list_sort(list(DISTINCT product_name)) AS products
  FROM issue_rows GROUP BY ALL),
scores AS (SELECT category, brand, primary_theme, frequency, {rnd('sev', 2)} AS avg_severity,
    {exact('rec', 3)} AS recency_weight,
    {rnd('frequency::DOUBLE * sev * rec', 2)} AS impact_score, top_failure_mode, products
  FROM sums LEFT JOIN modes USING (category, brand, primary_theme)),
quotes AS (SELECT category, brand, primary_theme, list(review_text ORDER BY date, review_id) AS q
  FROM (SELECT *, row_number() OVER (PARTITION BY category, brand, primary_theme
                                     ORDER BY date, review_id) AS n FROM issue_rows)
  WHERE n <= 3 GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY category
      ORDER BY impact_score DESC, brand, primary_theme)::INT AS rank FROM scores),
issues AS (SELECT * FROM ranked JOIN quotes USING (category, brand, primary_theme) WHERE rank <= 10)"""
_ISSUE_VALUES = (
    "category, brand, primary_theme, rank, frequency, avg_severity, recency_weight, "
    "impact_score, top_failure_mode"
)
_PRODUCTS = "array_to_string(products, '|') AS affected_products"
_QUOTES = "array_to_string(q, '|') AS sample_quotes"
add("a04_top_issues", f"{FACT}, {SCORES} SELECT {_ISSUE_VALUES}, {_PRODUCTS}, {_QUOTES} FROM issues")
add(
    "a04_all_issue_scores",
    f"""{FACT}, {SCORES} SELECT category, brand, primary_theme, frequency, avg_severity,
    recency_weight, impact_score, top_failure_mode FROM scores""",
)
_SCORE = (
    "(((count(*) FILTER (sentiment = 'positive')) - (count(*) FILTER (sentiment = 'negative')))"
    "::DOUBLE / count(*)::DOUBLE + sum(rating)::DOUBLE / count(rating)::DOUBLE / 5) / 2"
)
THEME_SCORES = f"""
theme_scores AS (SELECT category, brand, primary_theme, count(*) AS sample_size, {_SCORE} AS score
  FROM fact GROUP BY ALL)"""
add(
    "a05_theme_score",
    f"""{FACT}, {THEME_SCORES} SELECT category, brand, primary_theme, sample_size,
    {rnd('score', 6)} AS score FROM theme_scores""",
)
COMPARISON = f"""{THEME_SCORES}, comparison AS (
  SELECT category, o.brand AS our_brand, c.brand AS competitor, primary_theme AS theme,
    {rnd('o.score', 2)} AS our_score, {rnd('c.score', 2)} AS competitor_score,
    {rnd('o.score - c.score', 2)} AS delta, o.sample_size AS our_sample_size,
    c.sample_size AS competitor_sample_size,
    o.brand || CASE WHEN o.score - c.score > 0.2 THEN ' significantly outperforms '
      WHEN o.score - c.score > 0 THEN ' slightly ahead of '
      WHEN o.score - c.score > -0.2 THEN ' slightly behind '
      ELSE ' significantly underperforms ' END || c.brand || ' on ' || primary_theme AS insight,
    CASE WHEN o.score - c.score < -0.1
           THEN 'Improve ' || primary_theme || ' to close gap with ' || c.brand
         WHEN o.score - c.score > 0.2
           THEN 'Leverage ' || primary_theme || ' advantage in marketing vs ' || c.brand
         ELSE '' END AS opportunity
  FROM theme_scores o JOIN theme_scores c USING (category, primary_theme)
  WHERE o.brand IN {OWN} AND c.brand NOT IN {OWN} AND o.sample_size >= 3 AND c.sample_size >= 3)"""
add("a06_competitor_comparison", f"{FACT}, {COMPARISON} SELECT * FROM comparison")
EMERGING = f"""
windows AS (SELECT category, primary_theme AS theme,
    count(*) FILTER (date >= {AS_OF} - 90) AS rc, count(*) FILTER (date < {AS_OF} - 90) AS oc,
    sum(severity) FILTER (date >= {AS_OF} - 90) AS sev,
    count(severity) FILTER (date >= {AS_OF} - 90) AS graded_n FROM fact GROUP BY ALL),
rates AS (SELECT *, rc::DOUBLE / greatest(sum(rc) OVER (PARTITION BY category), 1)::DOUBLE AS rr,
    oc::DOUBLE / greatest(sum(oc) OVER (PARTITION BY category), 1)::DOUBLE AS orate,
    sum(oc) OVER () AS all_older FROM windows),
emerging AS (SELECT category, theme, rc AS recent_count, oc AS older_count,
    {exact('(rr / greatest(orate, 0.001::DOUBLE))', 2)} AS growth_factor,
    {rnd('sev::DOUBLE / nullif(graded_n, 0)::DOUBLE', 2)} AS recent_severity_avg
  FROM rates WHERE rr > orate * 1.5 AND rc >= 5 AND all_older > 0)"""
add("a07_emerging_issues", f"{FACT}, {EMERGING} SELECT * FROM emerging")
add("s04_w02_report_round_trip", f"{FACT}, {EMERGING} SELECT * FROM emerging")
add("a13_emerging_from_cube", f"{FACT}, {EMERGING} SELECT * FROM emerging")
add("a13_comparison_from_cube", f"{FACT}, {COMPARISON} SELECT * FROM comparison")
add("x07_star_emerging", f"{FACT}, {EMERGING} SELECT * FROM emerging")
add("x07_star_comparison", f"{FACT}, {COMPARISON} SELECT * FROM comparison")
add(
    "a13_issue_scores_from_cube",
    f"""{FACT}, {SCORES} SELECT category, brand, primary_theme, frequency, avg_severity,
    recency_weight, impact_score, top_failure_mode FROM scores""",
)
add("a13_issue_scores_from_days", SQL["a13_issue_scores_from_cube"])
GAPS = f"""
praised AS (SELECT category, brand, primary_theme AS theme, count(*) AS n FROM fact
  WHERE sentiment = 'positive' GROUP BY ALL),
gaps AS (SELECT category, brand AS competitor, theme, n AS competitor_positive_count,
    brand || ' praised for ' || theme || ' — {'/'.join(b.OWN_BRANDS)} has no positive mentions'
      AS gap_description
  FROM praised p WHERE brand NOT IN {OWN} AND n >= 3 AND NOT EXISTS (
    SELECT 1 FROM praised o WHERE o.category = p.category AND o.theme = p.theme AND o.brand IN {OWN}))"""
add("a08_feature_gaps", f"{FACT}, {GAPS} SELECT * FROM gaps")
add(
    "a09_phrase_counts",
    f"""{CLASSIFIED}, uses AS (SELECT sentiment, unnest(phrases) AS phrase FROM classified),
    lists AS (SELECT 'all' AS list, {strip('lower(phrase)')} AS phrase FROM uses
      UNION ALL SELECT sentiment, lower(phrase) FROM uses WHERE sentiment IN ('positive','negative'))
    SELECT list, phrase, uses, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY list ORDER BY uses DESC, phrase)::INT AS rank
      FROM (SELECT list, phrase, count(*) AS uses FROM lists GROUP BY ALL)) WHERE rank <= 20""",
)
RISK = f""", risk AS (
  SELECT review_id, brand, product_name AS product, category, rating,
    {matched('low', b.SIGNALS)} AS signals, severity, primary_theme AS theme,
    substring(review_text, 1, 200) AS snippet
  FROM classified WHERE rating <= 2 AND {has_any('low', b.SIGNALS)}),
risky AS (SELECT product, count(*) AS return_risk_count,
    {exact('(sum(severity)::DOUBLE / count(severity)::DOUBLE)', 2)} AS avg_severity,
    array_to_string(list_sort(list(DISTINCT theme)), '|') AS top_themes,
    array_to_string(list_slice(list(review_id ORDER BY review_id), 1, 3), '|') AS samples
  FROM risk GROUP BY product)"""
add(
    "a10_return_risk_rows",
    f"""{CLASSIFIED}{RISK} SELECT review_id, brand, product, category, rating,
    array_to_string(signals, '|') AS risk_signals, severity, theme, snippet FROM risk""",
)
add(
    "a10_default_signals",
    f"""{CLASSIFIED} SELECT review_id,
    array_to_string({matched('low', [*RISK_SIGNALS, "worthless"])}, '|') AS risk_signals
    FROM classified WHERE rating <= 2 AND {has_any('low', [*RISK_SIGNALS, "worthless"])}""",
)
add("a11_return_risk", f"{CLASSIFIED}{RISK} SELECT * FROM risky")

_SIZES = {
    "summary_stats": "SELECT 1",
    "avg_rating_by_brand": "SELECT DISTINCT brand FROM fact",
    "review_count_by_category": "SELECT DISTINCT category FROM fact",
    "review_count_by_brand": "SELECT DISTINCT brand FROM fact",
    "sentiment_distribution": "SELECT DISTINCT sentiment FROM fact",
    "top_issues": "SELECT * FROM issues",
    "competitor_comparison": "SELECT * FROM comparison",
    "emerging_issues": "SELECT * FROM emerging",
    "feature_gaps": "SELECT * FROM gaps",
    # The only phrase of a review is its brand there.
    "language_patterns": """SELECT list, brand FROM (
        SELECT list, brand, row_number() OVER (PARTITION BY list) AS n FROM (
          SELECT DISTINCT 'all' AS list, brand FROM fact UNION ALL
          SELECT DISTINCT sentiment, brand FROM fact WHERE sentiment IN ('positive', 'negative')))
      WHERE n <= 20""",
    "return_risk": f"""SELECT DISTINCT product_name FROM fact
      WHERE rating <= 2 AND {has_any('lower(review_text)', b.SIGNALS)}""",
    "verified_vs_unverified": "SELECT 1",
}
add(
    "a13_run_all_from_cube",
    f"{FACT}, {SCORES}, {COMPARISON}, {EMERGING}, {GAPS} "
    + " UNION ALL ".join(
        f"SELECT {quoted(name)} AS analysis, count(*) AS rows FROM ({sql})"
        for name, sql in _SIZES.items()
    ),
)


def segment(name: str, condition: str) -> str:
    columns = [
        f"count(*) FILTER ({condition}) AS {name}_count",
        rnd(
            f"(sum(rating) FILTER ({condition}))::DOUBLE / nullif(count(rating) FILTER ({condition}), 0)", 2
        )
        + f" AS {name}_avg_rating",
        rnd(
            f"(sum(severity) FILTER ({condition}))::DOUBLE / nullif(count(severity) FILTER ({condition}), 0)",
            2,
        )
        + f" AS {name}_severity_avg",
    ]
    columns += [
        f"count(*) FILTER ({condition} AND sentiment = {quoted(s)}) AS {name}_{s}" for s in SENTIMENTS
    ]
    return ", ".join(columns)


add(
    "a12_verified_split",
    f"""{FACT} SELECT {segment('verified', 'verified_purchase')},
    {segment('unverified', 'NOT verified_purchase')} FROM fact""",
)

add("a13_verified_split_from_cube", SQL["a12_verified_split"])

# --- BI tables ----------------------------------------------------------------

_FLAT = f"""review_id, product_id, product_name, brand, category, rating, title, review_text,
  verified_purchase, helpful_votes, source, primary_theme, sentiment, severity,
  sentiment_confidence, failure_mode, {_TIMELINE} AS failure_timeline, has_actionable_signal,
  {_DETAIL} AS actionable_detail, false AS is_shipping_complaint, false AS is_spam,
  len(mentions)::INT AS competitor_mention_count, len(features)::INT AS feature_count,
  brand IN {OWN} AS is_own_brand"""
add(
    "x01_fact_reviews",
    f"""{CLASSIFIED} SELECT {_FLAT}, '' AS secondary_themes,
    array_to_string(features, ', ') AS features_mentioned,
    array_to_string(phrases, ', ') AS key_phrases,
    array_to_string(list_sort(list_distinct(list_transform(mentions, lambda m: m.brand))), ', ')
      AS competitor_brands_mentioned,
    len(list_filter(mentions, lambda m: m.context = 'favorable'))::INT
      AS favorable_competitor_mentions,
    sentiment = 'negative' AS is_negative, sentiment = 'positive' AS is_positive,
    date AS review_date FROM classified""",
)
add("x08_flat_reviews", f"{CLASSIFIED} SELECT {_FLAT}, date FROM classified")
add(
    "x02_dim_brand",
    f"""{FACT} SELECT DISTINCT brand, brand IN {OWN} AS is_own_brand,
    CASE WHEN brand IN {OWN} THEN 'Own' ELSE 'Competitor' END AS brand_type FROM fact""",
)
_LABEL = (
    "array_to_string(list_transform(string_split(replace(category, '_', ' '), ' '), "
    "lambda w: upper(w[1]) || lower(w[2:])), ' ')"
)
add("x03_dim_category", f"{FACT} SELECT DISTINCT category, {_LABEL} AS category_label FROM fact")


def calendar(source: str) -> str:
    return f"""calendar AS (SELECT unnest(generate_series(min(date), max(date), INTERVAL 1 DAY))::DATE AS date
    FROM {source})"""


add(
    "x04_dim_date",
    f"""{FACT}, {calendar('fact')} SELECT date, year(date)::INT AS year,
    'Q' || quarter(date)::VARCHAR AS quarter, month(date)::INT AS month_num,
    strftime(date, '%b') AS month_name, strftime(date, '%b %Y') AS month_year,
    (year(date) * 100 + month(date))::INT AS year_month_sort, day(date)::INT AS day FROM calendar""",
)
add(
    "x05_agg_top_issues",
    f"""{FACT}, {SCORES} SELECT category, rank, brand, primary_theme AS theme, frequency, avg_severity,
    recency_weight, impact_score, top_failure_mode,
    array_to_string(products, ', ') AS affected_products, substring(q[1], 1, 500) AS sample_quote
    FROM issues""",
)
add(
    "x06_agg_comparison_by_category",
    f"""{FACT}, {COMPARISON} SELECT category, count(*) AS comparisons,
    sum(our_sample_size)::BIGINT AS own_reviews FROM comparison GROUP BY 1""",
)
_PIVOT = ", ".join(f"count(*) FILTER (sentiment = {quoted(s)}) AS {s}" for s in SENTIMENTS)
add("x09_brand_sentiment_pivot", f"{FACT} SELECT brand, {_PIVOT} FROM fact GROUP BY 1")
_WIDE = ", ".join(f"count(*) FILTER (category = {quoted(c)}) AS {c}" for c in CATEGORIES)
add("x10_theme_category_pivot", f"{FACT} SELECT primary_theme, {_WIDE} FROM fact GROUP BY 1")
_CARD = f"""{rnd(_RATING, 3)} AS avg_rating, {rnd(_SEVERITY, 3)} AS avg_severity,
    count(*) AS review_count, {rnd(_NEG_SHARE, 3)} AS neg_pct"""
add("x11_brand_scorecard", f"{FACT} SELECT brand, {_CARD} FROM fact GROUP BY 1")
add("w04_bundle", f"{FACT} SELECT brand, {_PIVOT}, {_CARD} FROM fact GROUP BY 1")
_CLASSIFIED_PARTS = CLASSIFIED.removeprefix(TEXT)
_STAR = {
    "fact_reviews": "SELECT * FROM classified",
    "dim_date": "SELECT * FROM calendar",
    "dim_brand": "SELECT DISTINCT brand FROM classified",
    "dim_category": "SELECT DISTINCT category FROM classified",
    "agg_top_issues": f"""SELECT * FROM (
        SELECT category, row_number() OVER (PARTITION BY category) AS n FROM (
          SELECT DISTINCT category, brand, primary_theme FROM classified WHERE {_ISSUES}))
      WHERE n <= 10""",
    "agg_competitor_comparison": "SELECT * FROM comparison",
    "agg_emerging_issues": "SELECT * FROM emerging",
}
add(
    "x07_star_tables",
    FACT
    + ", docs AS ("
    + TEXT.strip().removeprefix("WITH docs AS (")
    + f"{_CLASSIFIED_PARTS}, {calendar('classified')}, {COMPARISON}, {EMERGING} "
    + " UNION ALL ".join(
        f"SELECT {quoted(name)} AS table_name, count(*) AS rows FROM ({sql})"
        for name, sql in _STAR.items()
    ),
)
add(
    "x12_star_join",
    f"""{CLASSIFIED} SELECT {_LABEL} AS category_label,
    CASE WHEN brand IN {OWN} THEN 'Own' ELSE 'Competitor' END AS brand_type,
    strftime(date, '%b %Y') AS month_year, count(*) AS reviews FROM classified GROUP BY ALL""",
)

add(
    "x12_star_slice",
    f"""{CLASSIFIED} SELECT {_LABEL} AS category_label,
    CASE WHEN brand IN {OWN} THEN 'Own' ELSE 'Competitor' END AS brand_type,
    strftime(date, '%b %Y') AS month_year, count(*) AS reviews FROM classified
    WHERE year(date) = 2024 AND quarter(date) IN (1, 3) GROUP BY ALL""",
)

# --- Measures -----------------------------------------------------------------

add(
    "m01_headline_measures",
    f"""{FACT} SELECT category, brand, count(*) AS total_reviews, {rnd(_RATING, 6)} AS avg_rating,
    {rnd(_NEG_SHARE + ' * 100', 6)} AS negative_pct, {rnd(_SEVERITY, 6)} AS avg_severity,
    {rnd(_VER_SHARE + ' * 100', 6)} AS verified_pct,
    count(DISTINCT product_name) AS distinct_products FROM fact GROUP BY ALL""",
)


def health(rating: str, negative: str, severity: str) -> str:
    return (
        f"({rating} / 5 * 40 + (100 - {negative}) / 100 * 30 + (5 - {severity}) / 4 * 30)"
    )


_ROUNDED = f"""{rnd(_RATING, 2)} AS avg_rating, {rnd(f'{_NEG_SHARE} * 100', 2)} AS neg_pct,
    {rnd(_SEVERITY, 2)} AS avg_severity, count(*) AS review_count"""
_WHOLE = f"round_even({health('avg_rating', 'neg_pct', 'avg_severity')}::DOUBLE, 0)::INT"
_AWAY = f"""{away(_RATING, 2)} AS avg_rating, {away(f'({_NEG_SHARE} * 100)', 2)} AS neg_pct,
    {away(_SEVERITY, 2)} AS avg_severity"""
_WHOLE_AWAY = f"{away(health('avg_rating', 'neg_pct', 'avg_severity'), 0)}::INT"
add(
    "m02_m03_health_and_band",
    f"""{FACT}, s AS (SELECT category, brand, {_AWAY} FROM fact GROUP BY ALL),
    h AS (SELECT category, brand, {_WHOLE_AWAY} AS health_score FROM s)
    SELECT *, CASE WHEN health_score >= 65 THEN 'Green' WHEN health_score >= 45 THEN 'Yellow'
      ELSE 'Red' END AS band, CASE WHEN health_score >= 65 THEN '#3FB950'
      WHEN health_score >= 45 THEN '#D29922' ELSE '#F85149' END AS colour FROM h""",
)
add(
    "m04_sentiment_delta",
    f"""{FACT}, {COMPARISON} SELECT competitor, theme, {rnd('avg(delta)', 6)} AS sentiment_delta
    FROM comparison GROUP BY ALL""",
)
add(
    "m05_theme_score",
    f"{FACT} SELECT primary_theme, {rnd(_SCORE, 6)} AS theme_score FROM fact GROUP BY 1",
)
add(
    "m06_issue_growth",
    f"""{FACT}, {EMERGING} SELECT theme, {rnd('avg(growth_factor)', 6)} AS issue_growth_rate
    FROM emerging GROUP BY 1""",
)
add(
    "m06_issue_impact",
    f"""{FACT}, {SCORES} SELECT brand, {rnd('sum(impact_score)', 6)} AS issue_impact_score
    FROM issues GROUP BY 1""",
)

# --- Exploration --------------------------------------------------------------

add(
    "d01_filter_reviews",
    f"""{FACT} SELECT review_id, category, brand, sentiment, severity FROM fact
    WHERE category IN ('small','promo') AND brand IN ('Brand#1','Brand#3') AND {_ISSUES}
      AND severity >= 3 AND verified_purchase""",
)
add("d01_own_brand_preset", f"{FACT} SELECT DISTINCT brand FROM fact WHERE brand IN {OWN}")
_SEL = "category IN ('small','promo') AND severity >= 2"
add(
    "d02_selection_counts",
    f"""{FACT} SELECT count(*) FILTER ({_SEL}) AS showing, count(*) AS total,
    {rnd(f"(count(*) FILTER ({_SEL} AND sentiment = 'negative'))::DOUBLE / (count(*) FILTER ({_SEL}))::DOUBLE * 100", 1)}
      AS negative_rate FROM fact""",
)
add(
    "d03_kpi_row",
    f"""{FACT} SELECT count(*) AS reviews, {rnd(_RATING, 2)} AS avg_rating,
    {rnd(_NEG_SHARE + ' * 100', 1)} AS negative_pct, {rnd(_SEVERITY, 1)} AS avg_severity,
    {rnd(_VER_SHARE + ' * 100', 0)} AS verified_pct, count(DISTINCT product_name) AS products,
    CASE WHEN {_RATING} >= 3.5 THEN 'Good' ELSE 'Watch' END AS rating_status,
    CASE WHEN {_NEG_SHARE} <= 0.3 THEN 'Good' ELSE 'Watch' END AS negative_status,
    CASE WHEN {_SEVERITY} <= 3 THEN 'Good' ELSE 'Watch' END AS severity_status FROM fact""",
)
add(
    "d04_brand_health",
    f"""{FACT}, s AS (SELECT brand, {_ROUNDED} FROM fact GROUP BY 1)
    SELECT *, {_WHOLE} AS health_score FROM s""",
)
add(
    "d05_theme_breakdown",
    f"""{FACT}, t AS (SELECT primary_theme, count(*) AS issues, sum(count(*)) OVER () AS total
      FROM fact WHERE {_ISSUES} GROUP BY 1)
    SELECT primary_theme, issues, total::BIGINT AS total_issues,
      {rnd('issues::DOUBLE / total::DOUBLE', 4)} AS share, {label_case('primary_theme')} AS theme_label
    FROM t ORDER BY issues DESC, primary_theme LIMIT 8""",
)
add(
    "d06_own_brand_panel",
    f"""{FACT}, own AS (SELECT * FROM fact WHERE brand IN {OWN}),
    modal AS (SELECT brand, primary_theme AS theme FROM (
        SELECT brand, primary_theme, count(*) AS n FROM own WHERE {_ISSUES} GROUP BY ALL)
      QUALIFY row_number() OVER (PARTITION BY brand ORDER BY n DESC, primary_theme) = 1),
    s AS (SELECT brand, count(*) AS reviews, {_RATING} AS r, {_NEG_SHARE} * 100 AS n,
      {_SEVERITY} AS v FROM own GROUP BY 1),
    t AS (SELECT *, trunc({health('r', 'n', 'v')})::INT AS score FROM s)
    SELECT brand, reviews, {rnd('r', 2)} AS avg_rating, {rnd('n', 0)} AS negative_pct,
      coalesce({label_case('theme')}, 'N/A') AS top_issue, score,
      CASE WHEN score >= 65 THEN 'Green' WHEN score >= 45 THEN 'Yellow' ELSE 'Red' END AS band
    FROM t LEFT JOIN modal USING (brand)""",
)
add("d07_rating_histogram", f"{FACT} SELECT rating, count(*) AS reviews FROM fact GROUP BY 1")
add(
    "d07_product_histogram",
    f"{FACT} SELECT product_name, rating, count(*) AS reviews FROM fact GROUP BY ALL",
)
add(
    "d08_issue_chart",
    f"""{FACT}, {SCORES} SELECT brand, primary_theme, impact_score, rank,
    {label_case('primary_theme')} AS theme_label FROM issues WHERE category = 'small'""",
)
add(
    "d09_issue_details",
    f"""{FACT}, {SCORES} SELECT category, rank, brand, {label_case('primary_theme')} AS theme_label,
    impact_score, {_PRODUCTS},
    array_to_string(list_transform(q, lambda t: substring(t, 1, 400)), '|') AS sample_quotes
    FROM issues WHERE rank <= 8""",
)
add(
    "d10_live_issues",
    f"""{FACT}, t AS (SELECT brand, primary_theme, category, count(*) AS n, {_SEVERITY} AS s
      FROM fact WHERE {_ISSUES} GROUP BY ALL)
    SELECT brand, primary_theme, category, n AS "count", {rnd('s', 6)} AS avg_severity,
      {rnd('n * s', 6)} AS impact, {label_case('primary_theme')} AS theme_label
    FROM t ORDER BY n * s DESC, brand, primary_theme, category LIMIT 15""",
)
_CELLS = ", ".join(
    rnd(f"coalesce(avg(delta) FILTER (theme = {quoted(t)}), 0)", 6) + f" AS {t}" for t in THEMES
)
add(
    "d11_delta_heatmap",
    f"""{FACT}, {COMPARISON} SELECT competitor, {_CELLS} FROM comparison
    WHERE category = 'small' GROUP BY 1""",
)
add(
    "d12_leads_and_lags",
    f"""{FACT}, {COMPARISON}, sided AS (
      SELECT category, CASE WHEN delta < -0.1 THEN 'lag' ELSE 'lead' END AS side, our_brand,
        competitor, theme, delta FROM comparison WHERE delta < -0.1 OR delta > 0.1)
    SELECT *, {label_case('theme')} AS theme_label FROM (
      SELECT *, row_number() OVER (PARTITION BY category, side
        ORDER BY abs(delta) DESC, our_brand, competitor, theme)::INT AS rank FROM sided)
    WHERE rank <= 5""",
)
add("d13_gap_table", f"{FACT}, {GAPS} SELECT *, {label_case('theme')} AS theme_label FROM gaps")
add(
    "d14_rating_comparison",
    f'{FACT} SELECT brand, {rnd(_RATING, 2)} AS avg_rating, count(*) AS "count" FROM fact GROUP BY 1',
)
add(
    "d15_product_stats",
    f"""{FACT} SELECT product_name, brand, category, count(*) AS reviews,
    {rnd(_RATING, 2)} AS avg_rating, {rnd(_NEG_SHARE + ' * 100', 2)} AS neg_pct,
    {rnd(_SEVERITY, 2)} AS avg_severity, {rnd(_POS_SHARE + ' * 100', 2)} AS pos_pct
    FROM fact GROUP BY ALL""",
)


def top_per_product(column: str, condition: str, n: int) -> str:
    return f"""t AS (SELECT product_name, {column}, count(*) AS n FROM fact WHERE {condition} GROUP BY ALL),
    u AS (SELECT *, row_number() OVER (PARTITION BY product_name
            ORDER BY n DESC, {column})::INT AS rank FROM t)"""


add(
    "d16_product_complaints",
    f"""{FACT}, {top_per_product('primary_theme', _ISSUES, 8)}
    SELECT product_name, primary_theme, n AS "count", rank,
      {label_case('primary_theme')} AS theme_label FROM u WHERE rank <= 8""",
)
add(
    "d17_product_failures",
    f"""{FACT}, {top_per_product('failure_mode', 'failure_mode IS NOT NULL', 5)}
    SELECT product_name, failure_mode, n AS "count", rank FROM u WHERE rank <= 5""",
)
add(
    "d18_product_samples",
    f"""{CLASSIFIED} SELECT product_name, position, sentiment,
      repeat('★', rating::INT) || repeat('☆', 5 - rating::INT) AS stars,
      substring(title, 1, 100) AS title, substring(review_text, 1, 500) AS review_text
    FROM (SELECT *, row_number() OVER (PARTITION BY product_name ORDER BY date, review_id)::INT AS position
          FROM classified WHERE sentiment = 'negative') WHERE position <= 8""",
)
add(
    "d19_monthly_sentiment",
    f"""{FACT} SELECT strftime(date, '%Y-%m') AS month, sentiment, count(*) AS "count"
    FROM fact WHERE date IS NOT NULL GROUP BY ALL""",
)
add(
    "d20_monthly_rating",
    f"""{FACT} SELECT strftime(date, '%Y-%m') AS month, brand, {rnd(_RATING, 6)} AS avg_rating
    FROM fact WHERE date IS NOT NULL GROUP BY ALL""",
)
add(
    "d21_emerging_labelled",
    f"{FACT}, {EMERGING} SELECT *, {label_case('theme')} AS theme_label FROM emerging",
)
add("d22_search_text", f"{CLASSIFIED} SELECT review_id, brand FROM classified WHERE contains(low, 'the mit license')")
add(
    "d22_search_index",
    f"{TEXT} SELECT needle, review_id FROM docs, (VALUES {', '.join(f'({quoted(n)})' for n in b.NEEDLES)}) AS n(needle) "
    "WHERE contains(low, lower(needle))",
)
_DISPLAY = (
    "brand, product_name, category, rating, sentiment, primary_theme, severity, "
    "verified_purchase, title, review_text"
)
add(
    "d23_sorted_view",
    f"{FACT} SELECT {_DISPLAY} FROM fact ORDER BY date DESC NULLS LAST, review_id LIMIT 500",
)
add(
    "d23_sorted_view_ascending",
    f"{FACT} SELECT {_DISPLAY} FROM fact ORDER BY helpful_votes NULLS LAST, review_id LIMIT 500",
)
add(
    "d23_shown_of_total",
    f"""{FACT} SELECT least(count(*), 500) AS shown, count(*) AS total FROM fact
    WHERE contains(lower(review_text), 'small')""",
)
add("d24_negative_extract", f"{FACT} SELECT review_id, rating FROM fact WHERE sentiment = 'negative'")
add(
    "d25_summary_extract",
    f"""{FACT} SELECT brand, category, primary_theme, count(*) AS "count",
    {rnd(_RATING, 2)} AS avg_rating, {rnd(_SEVERITY, 2)} AS avg_severity FROM fact GROUP BY ALL""",
)
add(
    "d26_header",
    f"""{FACT} SELECT count(*) AS total_reviews, count(DISTINCT category) AS categories,
    count(DISTINCT brand) AS brands FROM fact""",
)

# --- Evidence -----------------------------------------------------------------

add(
    "r01_engineering_evidence",
    f"""{FACT}, {SCORES} SELECT category, chr(10) || '## ' || upper(category) || chr(10) ||
    string_agg('- [' || brand || '] ' || primary_theme || ': impact=' || impact_score::VARCHAR
      || ', freq=' || frequency::VARCHAR || ', severity=' || avg_severity::VARCHAR || chr(10)
      || '  Failure mode: ' || coalesce(top_failure_mode, 'None') || chr(10)
      || '  Quote: "' || substring(q[1], 1, 150) || '..."' || chr(10), '' ORDER BY rank) AS evidence
    FROM issues WHERE rank <= 5 GROUP BY category""",
)
_KEYS = "category, our_brand, competitor, theme"
add(
    "r02_marketing_evidence",
    f"""{FACT}, {COMPARISON}, {GAPS}
    (SELECT 'advantage' AS kind, {_KEYS}, delta AS value FROM comparison WHERE delta > 0.15
      ORDER BY delta DESC, {_KEYS} LIMIT 10)
    UNION ALL (SELECT 'weakness', {_KEYS}, delta FROM comparison WHERE delta < -0.15
      ORDER BY delta, {_KEYS} LIMIT 10)
    UNION ALL (SELECT 'gap', category, NULL, competitor, theme, competitor_positive_count::DOUBLE
      FROM gaps ORDER BY competitor_positive_count DESC, category, competitor, theme LIMIT 10)""",
)
add(
    "r03_riskiest_products",
    f"""{CLASSIFIED}{RISK} SELECT product, return_risk_count, avg_severity FROM risky
    ORDER BY return_risk_count DESC, product LIMIT 5""",
)
add("r03_complaint_themes", f"{FACT}, {SCORES} SELECT {_ISSUE_VALUES} FROM issues WHERE rank <= 3")
add(
    "r04_scorecard_positions",
    f"""{FACT}, {COMPARISON} SELECT {_KEYS}, delta FROM comparison
    ORDER BY abs(delta) DESC, {_KEYS} LIMIT 15""",
)
add("r04_scorecard_summary", SQL["a01_summary_stats"])
add(
    "r04_scorecard_emerging",
    f"{FACT}, {EMERGING} SELECT * FROM emerging ORDER BY growth_factor DESC, category, theme LIMIT 10",
)
add("w05_summary_extract", SQL["d25_summary_extract"])
add("w05_negative_extract", SQL["d24_negative_extract"])
add(
    "k11_model_run",
    f"""{TEXT} SELECT review_id, CASE WHEN rating > 3 THEN 'positive' WHEN rating < 3 THEN 'negative' END
    AS sentiment, CASE WHEN rating = 3 THEN 'ValueError: undecided' END AS failed_reason FROM docs""",
)
add(
    "r05_brief_issues",
    f"""{FACT}, {SCORES}, mine AS (SELECT * FROM issues WHERE category = 'small'
      AND (brand = 'Brand#1' OR NOT EXISTS (
        SELECT 1 FROM issues WHERE category = 'small' AND brand = 'Brand#1')))
    SELECT {_ISSUE_VALUES} FROM mine ORDER BY rank LIMIT 5""",
)
add(
    "r05_brief_context",
    f"""{FACT}, {COMPARISON} SELECT {_KEYS}, delta FROM comparison WHERE category = 'small'
    ORDER BY abs(delta) DESC, {_KEYS} LIMIT 10""",
)
add(
    "r06_parse_generated_lists",
    """WITH a AS (SELECT doc_id AS id, doc_id % 4 = 1 AS bad, coalesce(text, '') AS text, n_chars::INT AS n FROM documents)
    SELECT id, 0 AS position, bad AS parse_error,
      CASE WHEN bad THEN '[{"quote": "cut, "rank": ' || n::VARCHAR END AS raw_response,
      CASE WHEN NOT bad THEN text END AS quote, CASE WHEN NOT bad THEN 1 END AS rank FROM a
    UNION ALL SELECT id, 1, false, NULL, 'x', n FROM a WHERE NOT bad""",
)
