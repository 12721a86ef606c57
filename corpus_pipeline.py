"""A corpus pipeline of five stages: language ID, near duplicates, secrets, mixing, pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import language, mixing, ngram_join, pieces, secrets_scan
from gridloom.llm._shared import free, materialize


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text in a known language go, so those with null or empty text do. Each row is judged by itself:
    repeated rows and null ids are kept as often as they come, long texts are judged whole, an empty table stays empty,
    and columns of any name pass."""
    return language.keep_identified(docs)


def _numbered_rows(docs: DataFrame, name: str) -> DataFrame:
    """With a 64-bit number for each distinct doc_id and text. Numbers that different rows share, told by their SHA-256, are replaced
    by numbers from another hash; there are hardly any, so the table of them is small."""
    number, digest = F.xxhash64("doc_id", "text"), F.sha2(F.concat_ws("\n", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce(F.concat(F.lit("="), "text"), F.lit("null"))), 256)
    told = docs.select(number.alias("key"), F.xxhash64(digest).alias("a"), F.xxhash64(F.lit(1), digest).alias("b"))
    span = told.groupBy("key").agg(*[f(c).alias(f"{n}_{c}") for c in "ab" for n, f in (("low", F.min), ("high", F.max))])
    shared = materialize(span.where("low_a < high_a or low_b < high_b").select(F.col("key").alias(f"{name}_shared")), "shared-numbers")
    rows = docs.withColumn(name, number).join(shared, F.col(name) == F.col(f"{name}_shared"), "left")
    return rows.withColumn(name, F.when(F.col(f"{name}_shared").isNull(), F.col(name)).otherwise(F.xxhash64(F.lit(2), digest))).drop(f"{name}_shared")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the rows that links of Jaccard similarity 0.8 over five-word n-grams join, one with the smallest doc_id stays
    (null is the largest); of rows with one doc_id and text, one. Rows without words stay."""
    name = free(docs, "_row")
    rows = _numbered_rows(docs, name)
    found = ngram_join.jaccard_components(rows.select(F.col(name).alias("doc_id"), "text"), k=5, percent=80).where("n_shingles > 0")
    keys = found.groupBy(F.col("doc_id").alias("key")).agg(F.min("component_id").alias("comp"), F.count("*").alias("n"))
    ids = rows.groupBy(F.col(name).alias("key")).agg(F.min("doc_id").alias("doc_id"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    best = keys.join(ids, "key").groupBy("comp").agg(F.min(order).alias("best"))
    marked = keys.join(best, "comp").select("key", (F.col("key") == F.col("best.key")).alias("stays"), "n")
    marked = materialize(marked.where("not stays or n > 1"), "near-duplicates")
    rest = rows.join(marked.select(F.col("key").alias(name)), name, "left_anti")
    repeated = rows.join(marked.where("stays").select(F.col("key").alias(name)), name, "left_semi").dropDuplicates([name])
    return rest.unionByName(repeated).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are masked; all documents stay, repeated rows as often as they come. Null and empty texts stay as they
    are, long ones are searched whole, an empty table stays empty, and columns of any name pass."""
    return secrets_scan.mask_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it, zero to three times; repeated rows and null ids are told apart. Rows without words,
    null texts among them, have size 0 and aren't taken; a null source is a source. Ties in rank go by id, size and row. An
    empty table stays empty, and columns of any name pass."""
    name = free(docs, "_row")
    # a table, so that rows keep their number: repeated rows and null ids are told apart
    rows = materialize(docs.withColumn(name, F.monotonically_increasing_id()), "mix")
    copies = free(rows, "_copies")
    taken = mixing.mix_sources(rows, keep=(name,)).where("copies > 0").select(name, F.col("copies").alias(copies))
    rows = rows.join(taken, name).withColumn(copies, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
    return rows.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each text's SentencePiece ids; null and empty texts have none, long ones are encoded whole. Rows keep their number and
    all their columns but those that the encoding replaces; an empty table stays empty."""
    return pieces.encode(docs)


STAGES = [
    ("language ID", identify_languages),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", encode),
]
#: Model fits and samples have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, f"stage-{i}")
    return docs
