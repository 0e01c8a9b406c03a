"""Runnable jobs over tables of documents, and the queries that run them on the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from clausemill.sources.scratch import shared_folder

from . import clause_feed, rule_catalogue


def _twice(job, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job run two times into one new folder, whose files stay; what the folder then holds."""
    out = f"{shared_folder(spark)}/{job.__name__.rpartition('.')[2]}-{uuid.uuid4().hex}"
    settings = {**job.DEFAULTS, "headers": True}
    for _ in range(2):
        job.run(spark, f"{sf_dir}/documents.parquet", out, settings)
    return job.read(spark, out)


def job1_rule_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule cards of all documents with what cites them."""
    return _twice(rule_catalogue, spark, sf_dir)


def job2_clause_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clauses that hold after all changes of the feed, and how many versions each had."""
    return _twice(clause_feed, spark, sf_dir)


QUERIES = {"job1_rule_catalogue": job1_rule_catalogue, "job2_clause_feed": job2_clause_feed}
ORACLES = {"job1_rule_catalogue": rule_catalogue.SQL, "job2_clause_feed": clause_feed.SQL}
