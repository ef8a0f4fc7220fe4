"""Queries over the standard tables for the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import merkle, substrings, urls


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """The vocabulary file of a public tokenizer, at the same place on every worker."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import pii, secrets

    docs = table(spark, sf_dir, "documents")
    return pii.digest(secrets.find(docs, secrets.train(docs), keep=("doc_id",)), secrets.KINDS)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import packing

    placed = packing.packed(packing.pieces(table(spark, sf_dir, "documents"), tokenizer=tokenizer_path()))
    return placed.withColumnRenamed("id", "doc_id")


def op3_chroma_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings, played as notes, are the recordings: the tables hold no audio."""
    from . import chroma

    prints = chroma.fingerprints(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", chroma.score_samples)
    found = chroma.groups(prints)
    return found.select(
        F.col("id").alias("vec_id"), F.size("codes").alias("n_codes"), F.sha2(F.array_join("codes", ","), 256).alias("codes_sha256"),
        "group_id", "with_id", "offset", "bit_error",
    )


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import neighbours

    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import bpe

    return bpe.encode(table(spark, sf_dir, "documents"), tokenizer_path(), result="digests").withColumnRenamed("id", "doc_id")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import toxicity

    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep=("doc_id",)).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "spans",
    )


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import pii

    docs = table(spark, sf_dir, "documents")
    return pii.digest(pii.find(docs, pii.train(docs), keep=("doc_id",)))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), keep=("page_id",)).drop("purity")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "text", "n_sentences", "n_removed")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import alignment

    found = alignment.score(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))
    return found.withColumnRenamed("id", "doc_id")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.documents(table(spark, sf_dir, "documents"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality

    found = quality.judge(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_chroma_fingerprints": op3_chroma_fingerprints,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_bpe": op5_bpe,
    "op6_toxicity": op6_toxicity,
    "op7_pii": op7_pii,
    "op8_url_filter": op8_url_filter,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_quality_rules": op13_quality_rules,
}

ORACLES: dict[str, str] = {"op8_url_filter": urls.ORACLE, "op9_substring_dedup": substrings.ORACLE, "op12_merkle_manifest": merkle.ORACLE}
