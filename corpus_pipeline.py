"""From raw documents to sampled piece ids, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the docs of the next.  All but the last return the columns of their docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vaultwright.llm import line_dedup, piece_sampling, prob_minhash, quality_rules, template_decontamination
from vaultwright.llm.common import stage, table

SAMPLES = 2

# No SQL: segmentations are sampled.  tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive rules reject go."""
    return quality_rules.keep(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go; so do documents that lose all their lines."""
    return line_dedup.dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return prob_minhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return template_decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations: doc_id, rank, n_pieces, log_prob, perturbed, log_inclusion, ids."""
    vocabulary = piece_sampling.Vocabulary.load(piece_sampling.default_model())
    return piece_sampling.encode(docs, vocabulary, k=SAMPLES)


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pieces", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
