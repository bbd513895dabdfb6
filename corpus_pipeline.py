"""The corpus pipeline: from documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and returns a table that is written and read again
as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.staging import Stage
from feedloom.llm import jaccard, line_dedup, mixing, packing, quality
from feedloom.llm.common import table
from feedloom.llm.queries import DOMAINS, WEIGHTS, tokenizer_path

# Share of the tokens that the mix keeps, and how often it may read a document.
MIX_PORTION, MIX_EPOCHS = (3, 4), 1


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_quality(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of lines that occur earlier.

    Documents of which nothing is left go; those that were empty before stay.
    """
    done = line_dedup.dedup_lines(docs).filter("n_removed = 0 OR row.text RLIKE '[^ \\\\t-\\\\r]'")
    row = F.col("row")
    if "n_chars" in docs.columns:
        size = F.when(F.col("n_removed") > 0, F.char_length("row.text")).otherwise(F.col("row.n_chars"))
        row = row.withField("n_chars", size.cast(docs.schema["n_chars"].dataType))
    return done.select(row.alias("row")).select("row.*")


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """The whole rows, each with a key of its id (nulls last), its text and further columns."""
    doc_id = F.col("doc_id")
    key = F.struct(
        doc_id.isNull().alias("late"), doc_id, line_dedup.text_key(F.col("text")).alias("text_key"),
        *[F.coalesce(F.col(c), F.lit(mixing.NONE)).alias(c) for c in more],
    )
    return docs.select(F.struct("*").alias("row"), key.alias("key"), "doc_id", "text", *more)


def at_most(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Of each key in `wanted` so many rows, the first in the order of their columns, and all others.

    `wanted` lists repeated keys that keep fewer rows than they have; as a rule there are none.
    """
    if wanted.isEmpty():
        return rows
    kinds = rows.schema["row"].dataType
    order = [F.col("row")[f.name] for f in kinds if isinstance(f.dataType, T.AtomicType)]
    # The limits of most keys are one row, which Spark cuts to before the shuffle.
    place = F.row_number().over(W.partitionBy("key").orderBy(*order))
    one = rows.join(wanted.filter("wanted = 1"), "key", "left_semi").withColumn("n", place).filter("n = 1").drop("n")
    some = rows.join(wanted.filter("wanted > 1"), "key").withColumn("n", place).filter("n <= wanted").drop("n", "wanted")
    return rows.join(wanted, "key", "left_anti").unionByName(one).unionByName(some)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of similar documents, one row: that of the smallest id, null ids last.

    Rows that share an id are told apart by their texts, so another text under a dropped
    document's id stays. Rows without an id take part as any other. Of rows that repeat both
    id and text the first in the order of the columns stays. Documents without words are in
    no group and all stay.
    """
    rows = keyed(docs)
    stage = Stage(spark, "pipeline-near-duplicates")
    groups = stage.write(jaccard.jaccard_components(rows.select("key", "text"), id_col="key"))
    first = F.col("doc_id") == F.col("component_id")
    later = groups.filter(~first).select(F.col("doc_id").alias("key")).distinct()
    repeated = groups.filter(first & (F.col("n_shingles") > 0)).groupBy(F.col("doc_id").alias("key")).count()
    wanted = stage.write(repeated.filter("count > 1").select("key", F.lit(1).cast("long").alias("wanted")))
    return at_most(rows.join(later.hint("shuffle_hash"), "key", "left_anti"), wanted).select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the target weights of domains, languages and sources select.

    The rows that stay are those that the mix chose, whether they have an id or share it.
    Of rows with the same id, text, language and source as many stay as were chosen.
    """
    rows = keyed(docs, "lang", "source")
    stage = Stage(spark, "pipeline-mix")
    domain = mixing.named(F.col("source"), DOMAINS, "other")
    chosen = mixing.mix(rows, WEIGHTS, domain, portion=MIX_PORTION, epochs=MIX_EPOCHS, key=F.col("key"))
    # A later epoch only begins after a whole first one.
    taken = stage.write(chosen.filter("epoch = 0").groupBy("key").agg(F.count(F.lit(1)).alias("wanted")))
    repeated = rows.groupBy("key").count().filter("count > 1")
    wanted = stage.write(repeated.join(taken, "key").filter("wanted < count").select("key", "wanted"))
    kept = rows.join(taken.select("key").hint("shuffle_hash"), "key", "left_semi")
    return at_most(kept, wanted).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces of all documents."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality classifier", filter_quality),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack),
]

# A trained classifier decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    stage = Stage(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, function in STAGES:
        docs = stage.write(function(spark, docs, sf_dir))
    return docs


PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_SQL = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
