"""The catalogue of rules: every article's card with its citation, where it stands, what it refers to and how often others cite it.

    python -m jobs.rule_catalogue DOCUMENTS OUT [--config jobs/rule_catalogue.json]

Documents are parsed into clauses, references are resolved, articles become cards. Two tables come of it, for agents that look up
rules: ``catalogue`` (Parquet by snapshot and topic) and ``documents`` (JSON by snapshot: what was parsed, and numbers that are missing).
A run replaces its snapshot, and only that, so it can be repeated; snapshots with other names stay.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clausemill.operators import cards, clauses, quality, references
from clausemill.plans import sql as S
from clausemill.sources.scratch import held

from ._common import command_line, counted, log, parsed_of

DEFAULTS = {"headers": False, "lines_a_page": 60, "snapshot": "current", "no_topic": "none"}
CATALOGUE = "card_id long, document_id long, citation string, page_start int, page_end int, statement string, bound_actor string, penalty string, refs_resolved long, refs_dangling long, cited_by long, snapshot string, topic string"


def catalogue(kept: DataFrame, extracted: DataFrame, refs: DataFrame, no_topic: str) -> DataFrame:
    """Stored clauses, their cards and resolved references -> a row for each valid card. References count for the article that their clause is in;
    ``cited_by`` counts those from other articles. All these tables grow with the documents, so every join moves both sides and none is broadcast,
    whatever their files' sizes say."""
    of = kept.select("clause_id", "document_id", "dieu").hint("merge")
    source = refs.join(of.select(F.col("clause_id").alias("src_clause_id"), F.col("dieu").alias("from_article")), "src_clause_id")
    out = source.groupBy("document_id", F.col("from_article").alias("dieu")).agg(
        F.count("dst_clause_id").alias("refs_resolved"), F.count_if(F.col("dst_clause_id").isNull()).alias("refs_dangling")
    )
    target = source.join(of.select(F.col("clause_id").alias("dst_clause_id"), "dieu"), "dst_clause_id").where(~F.col("from_article").eqNullSafe(F.col("dieu")))
    cited = target.groupBy("document_id", "dieu").agg(F.count(F.lit(1)).alias("cited_by"))
    made = extracted.where("error IS NULL").join(kept.select("clause_id", "dieu", "page_start", "page_end").hint("merge"), "clause_id")
    rows = made.join(out.hint("merge"), ["document_id", "dieu"], "left").join(cited.hint("merge"), ["document_id", "dieu"], "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("refs_resolved", "refs_dangling", "cited_by")]
    topic = F.coalesce(F.get("topic_tags", F.lit(0)), F.lit(no_topic)).alias("topic")
    return rows.select("card_id", "document_id", "citation", "page_start", "page_end", "statement", "bound_actor", "penalty", *counts, topic)


def summaries(lines: DataFrame, parsed: DataFrame, extracted: DataFrame, kept: DataFrame, refs: DataFrame) -> DataFrame:
    """A row for each document: pages, clauses, references, and how many article numbers are missing."""
    missing = quality.numbering_gaps(kept).groupBy("document_id").agg(F.sum(F.col("last_missing") - F.col("first_missing") + 1).alias("numbers_missing"))
    rows = references.summary(lines, parsed, extracted, refs).join(missing.hint("merge"), "document_id", "left")
    return rows.withColumn("numbers_missing", F.coalesce("numbers_missing", F.lit(0)))


def run(spark: SparkSession, documents: str, out: str, settings: dict) -> dict:
    """Reads the table of documents, writes both tables under ``out``; how many rows were read and written."""
    snapshot = settings["snapshot"]
    rows, seen = counted(spark.read.parquet(documents).where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").alias("document_id"), "text"), "documents")
    # Clauses are written once for all that reads them, and cards before they are filtered, as a filter on what they say works them out again.
    with held(clauses.ranked(parsed_of(rows, settings))) as parsed:
        kept = clauses.kept(parsed)
        with held(references.extract(parsed), cards.extract(kept)) as (extracted, carded), held(references.resolve(extracted, kept)) as refs:
            made = catalogue(kept, carded, refs, settings["no_topic"])
            # Files of like size in each topic, also where one topic has most of the cards.
            made.hint("rebalance", "topic").write.mode("overwrite").partitionBy("topic").parquet(f"{out}/catalogue/snapshot={snapshot}")
            pages = parsed.select("document_id", F.col("page_end").alias("page"))
            summaries(pages, parsed, extracted, kept, refs).write.mode("overwrite").json(f"{out}/documents/snapshot={snapshot}")
    told = {"documents": seen.get["rows"], "cards": read(spark, out, snapshot).count()}
    log.info("read %d documents from %s; wrote %d cards to %s/catalogue/snapshot=%s", told["documents"], documents, told["cards"], out, snapshot)
    return told


def read(spark: SparkSession, out: str, snapshot: str = DEFAULTS["snapshot"]) -> DataFrame:
    """A snapshot of the catalogue."""
    return spark.read.schema(CATALOGUE).parquet(f"{out}/catalogue").where(F.col("snapshot") == snapshot).drop("snapshot")


SQL = S.lines_up(
    S.PARSED_SQL,
    S.STORED_SQL,
    S.EXTRACTED_SQL,
    S.RESOLVED_SQL,
    S.CARDS_SQL,
    """sourced_refs AS (SELECT r.*, c.dieu AS from_article FROM refs r JOIN clauses c ON c.clause_id = r.src_clause_id
    ), outgoing AS (SELECT document_id, from_article AS dieu, count(dst_clause_id) AS refs_resolved, count(*) FILTER (WHERE dst_clause_id IS NULL) AS refs_dangling FROM sourced_refs GROUP BY ALL
    ), incoming AS (
      SELECT c.document_id, c.dieu, count(*) AS cited_by FROM sourced_refs r JOIN clauses c ON c.clause_id = r.dst_clause_id WHERE r.from_article IS DISTINCT FROM c.dieu GROUP BY ALL
    )""",
    select="""SELECT k.card_id, k.document_id, k.citation, c.page_start, c.page_end, k.statement, k.bound_actor, k.penalty, coalesce(o.refs_resolved, 0) AS refs_resolved,
      coalesce(o.refs_dangling, 0) AS refs_dangling, coalesce(i.cited_by, 0) AS cited_by, coalesce(k.topic, 'none') AS topic
    FROM cards k JOIN clauses c ON c.clause_id = k.clause_id LEFT JOIN outgoing o ON o.document_id = c.document_id AND o.dieu = c.dieu LEFT JOIN incoming i ON i.document_id = c.document_id AND i.dieu = c.dieu""",
)

if __name__ == "__main__":
    sys.exit(0 if command_line(run, DEFAULTS, __doc__.splitlines()[0]) else 1)
