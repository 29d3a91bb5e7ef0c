"""From raw documents to packed sequences, in five written stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.llm import line_dedup, mixing, packing, simhash, toxicity
from fieldtally.llm.common import run_folder
from fieldtally.llm.queries import table, toxic_model


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under one half."""
    model = toxic_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).filter(F.col("score") < 0.5).select(docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that repeat across documents, ``n_chars`` counted anew."""
    lean = line_dedup.drop_repeated_lines(docs)
    chars = F.when(F.col("n_dropped") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    return lean.withColumn("n_chars", chars.cast("long")).select(docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest id."""
    return simhash.keep_first(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their sources' weights, in shuffled order."""
    return mixing.mix(docs).select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("simhash_dedup", simhash_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL can express neither the network nor the tokens; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = run_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
