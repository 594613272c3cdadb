"""The corpus pipeline: quality rules, SimHash near-dedup, benchmark decontamination, secret scan, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from axonlake.llm import decontam, packing, quality, secrets, simhash
from axonlake.llm.common import forget, saved, table
from axonlake.llm.queries import tokenizer

#: Near-duplicate stage: words a shingle, and the similarity from which documents are copies.
SHINGLE, SIMILARITY = 5, 0.8


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line-frequency rules keep."""
    return quality.kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest doc_id."""
    return simhash.first_of_each(docs, width=SHINGLE, similarity=SIMILARITY)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item."""
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts masked and n_chars counted anew."""
    x = secrets.redacted(docs)
    return x.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in x.columns else x


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens."""
    return packing.packed(docs, tokenizer("word_bpe_49k.json"), spaced=False, end=2, size=4096)


STAGES = [("quality rules", quality_rules), ("near dedup", near_dedup), ("decontamination", decontaminate), ("secret scan", redact_secrets), ("packing", pack)]
#: Fingerprints, alignment and packing can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written and read again as the next one's input, then deleted."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        done = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        forget(docs)
        docs = done
    return docs
