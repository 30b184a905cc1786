"""From raw documents to packed training sequences: five stages, each over what the last kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmill.llm import decontam, minhash, packing, quality, secrets
from tripmill.llm.common import ship, small_batches, stored, table
from tripmill.llm.queries import tokenizer_file

#: No stage can be expressed in SQL as a whole: a language model decides in the first.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the perplexity bands reject go."""
    small_batches(ship(spark))
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    small_batches(ship(spark))
    return minhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Credentials are replaced by a mark; all documents stay."""
    small_batches(ship(spark))
    return secrets.redact_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the sequences that all documents are packed into."""
    small_batches(ship(spark))
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"), with_ids=False).drop("ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each writes Parquet that the next one reads."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
