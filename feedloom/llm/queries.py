"""Queries over the operators of this subpackage, one per operator, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import (
    exact_dedup, jaccard, langid, licenses, line_dedup, mixing, neighbours, packing, periodic, quality, secrets, sharding, spelling,
)
from feedloom.llm.common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


# The tree of the mix: which sources make up a domain, and the target weights.
DOMAINS = {
    "web": ("src0", "src1", "src2", "src3", "src4"),
    "news": ("src5", "src6", "src7", "src8", "src9"),
    "books": ("src10", "src11", "src12", "src13", "src14"),
}
WEIGHTS = {
    "domain": {"web": 30, "news": 20, "books": 40, "other": 10},
    "lang": {"en": 50, "de": 20, "fr": 20, "es": 10},
    "source": {"src0": 3, "src10": 2},
}


def tokenizer_path() -> str:
    """The public byte-level tokenizer; executors find it at the same place."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    domain = mixing.named(F.col("source"), DOMAINS, "other")
    return mixing.mix(docs, WEIGHTS, domain, portion=(1, 2), epochs=2)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    spans = F.transform("runs", lambda r: F.concat_ws(":", r["first"], r["last"]))
    return done.select(
        "row.doc_id",
        "n_lines",
        "n_removed",
        F.array_join(spans, ",").alias("removed"),
        F.sha2(F.coalesce("row.text", F.lit("")), 256).alias("text_sha256"),
        "row.text",
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.count_words(table(spark, sf_dir, "documents"), misspell=31))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"), shards=40)
    return placed.select(
        "doc_id",
        F.col("bytes").alias("size"),
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "tokens",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = periodic.find_runs(docs, text=periodic.with_planted_runs(F.col("doc_id"), F.col("text")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = found.withColumn("best", periodic.greatest_run(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(lines, lambda x: F.concat(x, F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words",
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_quality_score,
        op3_best_fit_packing,
        op4_exact_dedup,
        op5_language_id,
        op6_source_mix,
        op7_jaccard_join,
        op8_nearest_neighbours,
        op9_license_scan,
        op10_line_dedup,
        op11_spelling_variants,
        op12_sharding,
        op13_periodic_runs,
    )
}

WORDS = r"'[^\x20\x09-\x0D]+'"


def _case(column: str, names: dict[str, tuple[str, ...]], other: str) -> str:
    whens = " ".join(
        f"WHEN {column} IN ({', '.join(repr(v) for v in values)}) THEN '{name}'" for name, values in names.items()
    )
    return f"CASE {whens} ELSE '{other}' END"


def _weight(level: str) -> str:
    whens = " ".join(f"WHEN '{key}' THEN {w}" for key, w in WEIGHTS[level].items())
    return f"(CASE {level} {whens} ELSE 1 END)"


def _shared(name: str, nodes: str, parent: str) -> str:
    """Water-filling of the parents' budgets over their children (columns cap, weight, budget)."""
    part = f"PARTITION BY {parent}" if parent else ""
    key = nodes.split("_")[0]
    order = f"ORDER BY cap / weight, {key}"
    return f"""
    {nodes}_levels AS (SELECT *, (budget - coalesce(sum(cap) OVER ({part} {order}
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
        / (sum(weight) OVER ({part} {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level
      FROM {nodes}),
    {name} AS (SELECT * EXCLUDE (budget, cap, weight, level), (CASE WHEN cap / weight < served THEN cap
        ELSE least(cap, floor(served * weight)) END)::BIGINT AS budget
      FROM (SELECT *, max(level) OVER ({part}) AS served FROM {nodes}_levels))"""


SQL = {
    "op4_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op6_source_mix": f"""
    WITH docs AS (SELECT doc_id, {_case("source", DOMAINS, "other")} AS domain, coalesce(lang, '(none)') AS lang,
        coalesce(source, '(none)') AS source, len(regexp_extract_all(coalesce(text, ''), {WORDS}))::BIGINT AS tokens
      FROM documents),
    leaves AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS leaf_tokens FROM docs GROUP BY ALL),
    domain_nodes AS (SELECT domain, (sum(leaf_tokens) * 2)::BIGINT AS cap, {_weight("domain")} AS weight,
        (SELECT floor(sum(tokens) / 2)::BIGINT FROM docs) AS budget FROM leaves GROUP BY 1),
    {_shared("domains", "domain_nodes", "")},
    lang_nodes AS (SELECT domain, lang, (sum(leaf_tokens) * 2)::BIGINT AS cap, {_weight("lang")} AS weight,
        any_value(budget) AS budget FROM leaves JOIN domains USING (domain) GROUP BY 1, 2),
    {_shared("langs", "lang_nodes", "domain")},
    source_nodes AS (SELECT domain, lang, source, any_value(leaf_tokens) AS leaf_tokens,
        (sum(leaf_tokens) * 2)::BIGINT AS cap, {_weight("source")} AS weight,
        any_value(budget) AS budget FROM leaves JOIN langs USING (domain, lang) GROUP BY 1, 2, 3),
    {_shared("sources", "source_nodes", "domain, lang")},
    plans AS (SELECT *, CASE WHEN leaf_tokens > 0 THEN floor(budget / leaf_tokens)::BIGINT ELSE 2 END AS whole,
        CASE WHEN leaf_tokens > 0 THEN budget % leaf_tokens ELSE 0 END AS rest FROM sources),
    drawn AS (SELECT doc_id, domain, lang, source, tokens, whole, rest,
        unnest(range(least(2, whole + (rest > 0)::INT)))::INT AS epoch
      FROM docs JOIN plans USING (domain, lang, source)),
    placed AS (SELECT *, ('0x' || substr(md5('mix:' || epoch || ':' || doc_id), 1, 15))::BIGINT AS place FROM drawn),
    started AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source, epoch
        ORDER BY place, doc_id, tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
      FROM placed)
    SELECT doc_id, domain, lang, source, epoch, start, tokens FROM started WHERE epoch < whole OR start < rest
    """,
    "op7_jaccard_join": f"""
    WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {WORDS}) AS w FROM documents),
    shingles AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS shingle
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM words)),
    sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
    links AS MATERIALIZED (SELECT x, y FROM (
        SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
        FROM shingles a JOIN shingles b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL)
      JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
      WHERE 100 * shared >= 80 * (p.n + q.n - shared)),
    reached AS (SELECT doc_id, doc_id AS other FROM documents
      UNION SELECT reached.doc_id, y FROM reached JOIN links ON x = other)
    SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
    FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
    """,
}
