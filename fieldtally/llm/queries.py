"""Each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.llm import (
    embedding_dedup,
    html_wrappers,
    language_id,
    line_dedup,
    merkle,
    mixing,
    packing,
    periodic_runs,
    simhash,
    substring_dedup,
    token_counts,
    topk,
    toxicity,
)
from fieldtally.llm.tokens import encoder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language_id.remainder("doc_id", 4) == 2
    prototypes = language_id.train(docs.filter(~held_out))
    found = language_id.identify(docs.select("doc_id", "text"), prototypes)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def toxic_model(docs: DataFrame, labels: DataFrame):
    return toxicity.train(docs, labels.filter(language_id.remainder("doc_id", 5) != 0))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxic_model(docs, table(spark, sf_dir, "labels"))
    held_out = language_id.remainder("doc_id", 5) == 0
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_wrappers.main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", "n_chars")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id")


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.digest(line_dedup.drop_repeated_lines(docs))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = token_counts.corpus_blocks(table(spark, sf_dir, "documents"))
    return token_counts.count_tokens(blocks, encoder().end).select("doc_id", "n_tokens")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lean = substring_dedup.drop_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return lean.select("doc_id", "n_words", "n_removed", _text_hash("text").alias("kept_sha256"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of the documents as they are, held against texts of which every second has lost its line breaks."""
    docs = table(spark, sf_dir, "documents")
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    lost = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle.leaf_hash([lost if c == "text" else F.col(c) for c in merkle.FIELDS])
    proofs = merkle.prove(docs, merkle.leaf_hash([F.col(c) for c in merkle.FIELDS]), carry=[found.alias("found")])
    return merkle.verified(proofs, "found").select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_hash().alias("proof_sha256"), "folded_root", "verified"
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs.collapse_runs(docs)
    exponent = F.floor(1000 * F.col("length") / F.col("period"))
    return found.select(
        "doc_id", "n_runs", "start", "length", "period", exponent.alias("exponent_milli"),
        _text_hash("runs").alias("runs_sha256"), _text_hash("text").alias("collapsed_sha256"),
    )


def _text_hash(name: str) -> Column:
    return F.sha2(F.col(name).cast("binary"), 256)


REGISTERED = {
    f.__name__: f
    for f in (
        op1_mixing, op2_language, op3_embedding_dedup, op4_toxicity, op5_main_text, op6_simhash, op7_topk,
        op8_line_dedup, op9_token_counts, op10_packing, op11_substring_dedup, op12_merkle, op13_periodic_runs,
    )
}
