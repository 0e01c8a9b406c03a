"""Documents through a training-data pipeline: language, near-duplicates, secrets, mix, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clausemill.llm import stages
from clausemill.llm._shared import Scratch, table

STAGES = [
    ("language id", stages.identify_language),
    ("near duplicates", stages.drop_near_duplicates),
    ("secrets", stages.redact_secrets),
    ("mix", stages.mix_sources),
    ("packing", stages.pack_sequences),
]
#: Compression, hashes of word n-grams and byte-level BPE have no SQL; tests hold the stages to brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; each result is written in the shared folder and read again by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = scratch.keep(docs, f"stage-{k}")
    return docs
