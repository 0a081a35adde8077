"""Corpus pipeline: quality rules, SimHash near-dedup, personal data, best-fit packing.

Every stage reads the table the one before has written; all but the last give the columns of
`documents`. Near-duplicates are the components of fingerprints as op1 links them (three-word
shingles, two bits); personal data are replaced by their kind, and the packed sequences hold
what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchwright.llm import bpe, packing, pii, quality, simhash
from matchwright.llm.queries import tokenizer_path
from matchwright.session import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule of the current policy rejects go."""
    return quality.keep(docs, "v1")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints link stays: op1's shingles and its greatest distance."""
    return simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts give way to their kind."""
    return pii.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of the documents and their places in the sequences."""
    return packing.pack(docs, bpe.read_tokenizer(tokenizer_path()))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_dedup),
    ("pii", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: SQL has neither the shingle hashes nor the tokenizer; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each over the stored result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
