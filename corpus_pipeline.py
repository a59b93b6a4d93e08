"""The corpus pipeline: quality rules, near-duplicates, decontamination, secrets, token ids.

Each stage calls one operator of ``tessera.llm`` on all that its predecessor
kept and returns a frame, which is written as Parquet and read again for the
next one. All stages but the last return the columns of ``documents``.

Null and empty texts fail the quality rules. Where a doc_id is null or
repeated, rows are told apart by their texts; extra columns pass through. An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, duck_bpe, quality, secret_scan, simhash
from tessera.llm.common import free_name, materialize, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the production policy rejects go."""
    name = free_name(docs, "_ledger")
    got = quality.ledger(docs, out=name)
    return got.where(~quality.fails(F.col(f"{name}.failed"), quality.PRODUCTION)).select(*[f"`{c}`" for c in docs.columns])


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that with the smallest doc_id."""
    return simhash.keep_one(docs, shingle=3, max_distance=2)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"), **decontaminate.WHOLE)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live values are replaced in the text; no document goes."""
    return secret_scan.redact(docs, owner_col="source", repo_col="lang", length_col="n_chars")


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, and the digests of the ids and of the text decoded from them."""
    import public_tokenizers

    name = free_name(docs, "_bpe")
    got = duck_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep=["doc_id"], out=name)
    return got.select("doc_id", f"{name}.*")


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("byte_level_bpe", byte_level_bpe),
]
#: Fingerprints and BPE have no SQL form; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
