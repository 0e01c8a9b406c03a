"""What both jobs need: settings from a file, logs with row counts, a command line."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clausemill.operators import clauses
from clausemill.plans import corpus

log = logging.getLogger("jobs")


def settings(spark: SparkSession, path: str | None, defaults: dict) -> dict:
    """The defaults with what a JSON file says instead; a name that isn't known is an error. The file may be remote."""
    said = spark.read.option("multiLine", True).json(path).first().asDict() if path else {}
    unknown = sorted(set(said) - set(defaults))
    if unknown:
        raise ValueError(f"unknown settings in {path}: {', '.join(unknown)}")
    return {**defaults, **{k: v for k, v in said.items() if v is not None}}


def lines_of(docs: DataFrame, headers: bool, lines_a_page: int) -> DataFrame:
    """docs (document_id, text) -> their lines by page. With ``headers``, lines get the prefixes that make plain prose a legal text."""
    if headers:
        return corpus.lines_of(docs)
    rows = docs.select("document_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return rows.select("document_id", F.expr(f"cast(1 + line_no div {lines_a_page} AS INT)").alias("page"), "line_no", "line")


def parsed_of(docs: DataFrame, settings: dict) -> DataFrame:
    return clauses.parse_lines(lines_of(docs, settings["headers"], settings["lines_a_page"]))


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """df, and its number of rows once something has read it."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def command_line(run: Callable[[SparkSession, str, str, dict], dict], defaults: dict, about: str, arguments: list[str] | None = None) -> dict:
    """Creates a session, runs the job and stops it."""
    ask = argparse.ArgumentParser(description=about)
    ask.add_argument("documents", help="the table of documents: Parquet with doc_id and text")
    ask.add_argument("out", help="the folder of the job's tables")
    ask.add_argument("--config", help="a JSON file of settings")
    given = ask.parse_args(arguments)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName(run.__module__).getOrCreate()
    try:
        return run(spark, given.documents, given.out, settings(spark, given.config, defaults))
    finally:
        spark.stop()
