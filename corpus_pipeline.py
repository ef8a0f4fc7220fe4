"""The corpus pipeline: toxicity, SimHash near-dedup, substring dedup, PII, best-fit packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's docs. All but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veridact.llm import packing, pii, simhash, substrings, toxicity
from veridact.llm.common import materialize
from veridact.llm.queries import table, tokenizer_path


def wrapped(docs: DataFrame, *columns: str) -> DataFrame:
    """All columns as one struct doc, beside those named, so that no added column can clash."""
    return docs.select(F.struct("*").alias("doc"), *columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half; null and empty texts are scored like any."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(wrapped(docs, "text"), model, keep=("doc",)).where("score < 0.5").select("doc.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest doc_id; of rows equal in it, one.

    Texts without words are no copies of anything and stay.
    """
    return simhash.keep_one(wrapped(docs, "doc_id", "text")).select("doc.*")


def rewritten(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs' columns from found (doc, text), where text is the new one; n_chars follows a changed text."""
    changed = ~F.col("text").eqNullSafe(F.col("doc.text"))
    new = {"text": F.col("text"), "n_chars": F.when(changed, F.length("text").cast("long")).otherwise(F.col("doc.n_chars"))}
    return found.select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the sentences of spans that occurred before; n_chars follows the text."""
    return rewritten(docs, substrings.dedup(wrapped(docs, "doc_id", "text")))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; n_chars follows the text."""
    return rewritten(docs, pii.redact(wrapped(docs, "text"), pii.train(docs)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document, in real tokens, with its bin, the bin's capacity and the place in it."""
    return packing.packed(packing.pieces(docs, tokenizer=tokenizer_path())).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("pii", mask_personal_data),
    ("best_fit_packing", pack),
]

#: The learnt stages can't be said in SQL; tests hold the pipeline against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
