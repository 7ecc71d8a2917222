"""From raw documents to packed sequences: each stage works on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrearium.llm import decontaminate, language, near_dup, packing, queries, secret_scan
from arrearium.llm.common import held_out, table
from arrearium.session import stored


#: Languages that the first stage keeps; None: every language that was learned.
KEEP_LANGUAGES: tuple[str, ...] | None = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects what has no language (null text, or no letters) and what is in none of KEEP_LANGUAGES. lang becomes the language found.

    A decision that is flagged as ambiguous changes no label that a document came with, and is no ground to reject.

    Where no language was learned, as no row outside the held-out quarter is labelled, letters alone decide. A score of 0
    says that a text has no letters; the label 'und' does not, as the corpus may use it too.
    """
    model = language.train(docs.where(~held_out("doc_id")))
    if not model.languages:
        return docs.where(language.lettered())
    found = F.explode(F.array(language.identify(docs, model))).alias("l")  # decided once for each row, whatever reads it
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"), found).where("l.score > 0")
    lang = F.when(F.col("l.ambiguous") & F.col("d.lang").isNotNull(), F.col("d.lang")).otherwise(F.col("l.lang"))
    named = named.withColumn("lang", lang)
    if KEEP_LANGUAGES is not None:
        named = named.where(F.col("lang").isin(*KEEP_LANGUAGES) | F.col("l.ambiguous"))
    return named.select(*[F.col("lang") if c == "lang" else F.col(f"d.`{c}`") for c in docs.columns])


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates."""
    return near_dup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a benchmark window."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Redacts secrets; every document stays."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left."""
    return packing.pack(docs, queries.tokenizer_path(), sequence_tokens=queries.SEQUENCE_TOKENS, with_ids=False)


STAGES = [("language_id", language_id), ("minhash_dedup", minhash_dedup), ("decontamination", decontamination), ("secrets", secrets), ("pack", pack)]

# Learned and sketched stages are beyond SQL; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
