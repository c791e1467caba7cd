"""The corpus pipeline: quality rules, deduplication, decontamination, secret
redaction and tokenization. Each stage is written as Parquet to the shared
folder and read back as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltide.llm import decontamination, jaccard_join, quality_rules, secrets, sentencepiece_bpe
from voltide.llm.queries import piece_model, table
from voltide.session import materialize


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least id stays. Near
    copies share 80 percent or more of their five-word shingles."""
    return jaccard_join.keep_one(docs, shingle=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mask; the documents stay."""
    return secrets.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text."""
    return sentencepiece_bpe.encode_documents(docs, piece_model())


STAGES = [
    ("quality rules", apply_quality_rules),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("SentencePiece encoding", encode),
]

#: SQL can neither test randomness by the same tails nor encode pieces.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
