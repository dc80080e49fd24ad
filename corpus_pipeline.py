"""From raw documents to encoded training text, in five stages. Each is written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorflow.llm import chunk_reuse, near_dedup, quality_mil, secrets, tasks, tiling


# All stages: a null or empty text is a text like others and extra columns, whatever their names and types, come out as they went
# in. Repeated rows each count in every stage but near-dedup. Texts of any length are taken whole. Empty tables give empty ones.

def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on those left and their labels, does not reject.

    A null text is scored as an empty one. Without any label that fits, or with labels of one kind, the scores don't depend on
    the text.
    """
    tasks.prepare(spark)
    model = quality_mil.train(docs, tasks.table(spark, sf_dir, "labels"))
    return quality_mil.kept(docs, model)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id.

    A doc_id with several texts stays with the text of the smallest hash; its other texts, and texts without a doc_id, are
    documents of their own, behind all that have a doc_id to themselves. Of rows with equal doc_id and text one stays, by a
    fixed order. Null and empty texts are near to nothing. The row itself travels in a column of its own.
    """
    tasks.prepare(spark)
    named = [F.col(f"`{c}`") for c in docs.columns]
    hashed = docs.select(
        F.struct(*named).alias("document"), F.col("doc_id").alias("id"), "text",
        F.coalesce(F.sha2("text", 256), F.lit("none")).alias("hash"))  # a null text behind all others
    several = hashed.filter("id IS NOT NULL").groupBy("id").agg(F.min("hash").alias("first"), F.max("hash").alias("last"))
    several = tasks.written(several.filter("first < last").drop("last"), "several")
    own = F.col("id").isNull() | (F.col("hash") > F.coalesce("first", "hash"))
    number = F.lit(1 << 62) + F.pmod(F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("none")), "hash"), F.lit((1 << 62) - 1))
    rows = hashed.join(several, "id", "left").withColumn("row", F.when(own, number).otherwise(F.col("id")))
    found = near_dedup.near_duplicates(rows.select(F.col("row").alias("doc_id"), "text"))
    kept = found.filter("kept").select(F.col("doc_id").alias("row")).distinct()
    order = Window.partitionBy("row").orderBy(F.sha2(F.to_json("document"), 256))
    rows = rows.withColumn("at", F.row_number().over(order)).filter("at = 1")
    return rows.join(kept, "row", "left_semi").select("document.*")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item. A null or empty text holds none; without items all documents stay."""
    tasks.prepare(spark)
    return tiling.without_contaminated(docs, tasks.table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked and n_chars counted anew where that changed the text. A null text stays null."""
    tasks.prepare(spark)
    masked = secrets.without_secrets(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, SHA-256 of the ids and of the decoded text, for every document left. A null text has no ids."""
    tasks.prepare(spark)
    return chunk_reuse.encode_documents(docs, digests=True)


STAGES = [
    ("quality", good_quality),
    ("near_dedup", one_of_each),
    ("decontamination", decontaminated),
    ("secrets", without_secrets),
    ("encoding", encoded),
]
ORACLE_SQL = None  # the stages learn, hash and tokenize; tests/llm holds them against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks.prepare(spark)
    docs = tasks.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = tasks.written(stage(spark, docs, sf_dir), name)
    return docs
