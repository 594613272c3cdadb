"""Queries of the corpus operators: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, hard_negatives, lm, merkle, oracles, packing, pii, quality, secrets, sharding, simhash, suffix_dedup, tokens, winnowing
from .common import table


SHARD_BYTES = 1 << 20


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = sharding.shards(table(spark, sf_dir, "documents"), SHARD_BYTES)
    return x.select("doc_id", "n_bytes", "shard", "depth", "shard_bytes", "part")


OP1_SQL = f"""
WITH h AS (SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes, ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS h FROM documents),
levels AS (SELECT unnest(range(0, 61))::INT AS depth),
sizes AS (SELECT depth, h >> (60 - depth) AS p, sum(n_bytes)::BIGINT AS shard_bytes FROM h, levels GROUP BY 1, 2),
leaf AS (SELECT h.doc_id, min(s.depth) AS depth FROM h, levels l, sizes s WHERE s.depth = l.depth AND s.p = h.h >> (60 - l.depth) AND s.shard_bytes <= {SHARD_BYTES} GROUP BY 1)
SELECT h.doc_id, h.n_bytes, substr(lpad(bin(h.h), 60, '0'), 1, leaf.depth) AS shard, leaf.depth::INT AS depth, s.shard_bytes, 0::BIGINT AS part
FROM h JOIN leaf USING (doc_id) JOIN sizes s ON s.depth = leaf.depth AND s.p = h.h >> (60 - leaf.depth)
"""


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(table(spark, sf_dir, "documents"))


def op4_attention_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.tiktoken"))


def op5_line_frequency_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents")).drop("kept_words")


def op6_disclosure_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = pii.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda r: r["k"] < 4)
    n = lambda k: F.size(F.filter("spans", lambda r: r["k"] == k)).cast("long")
    return x.select("doc_id", *(n(k).alias(f"n_{pii.KINDS[k]}") for k in range(4)), F.sha2(pii.digest(base), 256).alias("base_sha256"), pii.digest(F.col("spans")).alias("spans"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    base = F.filter("spans", lambda r: r["k"] < 3)
    n = lambda k: F.size(F.filter("spans", lambda r: r["k"] == k)).cast("long")
    return x.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"), F.sha2(secrets.digest(base), 256).alias("base_sha256"), secrets.digest(F.col("spans")).alias("spans"))


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.read_ids(tokens.write_ids(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), spaced=True, end=0))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), spaced=False, end=2, size=4096)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    text = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.translate("text", string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.col("text"))
    tampered = merkle.leaf(*(text if c == "text" else F.col(c) for c in fields))
    x = merkle.manifest(table(spark, sf_dir, "documents"), F.col("lang"), F.col("doc_id"), merkle.leaf(*map(F.col, fields)), {"doc_id": F.col("doc_id"), "found": tampered})
    x = x.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof(F.col("path")), 256).alias("proof_sha256"), merkle.folded(F.col("found"), F.col("path")).alias("folded_root"))
    return x.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_winnowing_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = winnowing.against_edits(table(spark, sf_dir, "documents"))
    entries = lambda c: F.array_join(F.transform(c, lambda e: F.concat_ws(":", e["place"].cast("string"), F.lower(F.hex(e["hash"])))), ",").alias(c)
    return x.select("doc_id", "n_chars", "edited_sha256", entries("fingerprint"), entries("edited_fingerprint"), "near_edited", "near_next")


def op13_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "embeddings").where(hard_negatives.usable(F.col("embedding")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(x.select(F.col("vec_id").alias("id"), label.alias("label"), hard_negatives.integers(F.col("embedding"), 256).alias("v")), F.col("id") % 100 == 0)


def queries() -> dict:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op1_extendible_sharding": OP1_SQL, "op3_suffix_array_dedup": oracles.SUFFIX_SQL, "op5_line_frequency_quality": oracles.QUALITY_SQL, "op11_merkle_manifest": oracles.MERKLE_SQL, "op13_hard_negative_mining": oracles.NEGATIVES_SQL}
