"""The feed of changed clauses: what each new or newly delivered document adds, changes and takes away.

    python -m jobs.clause_feed DOCUMENTS OUT [--config jobs/clause_feed.json]

DOCUMENTS is a folder of Parquet files that grows, or a single file. A file stream takes the files that are new since the last run, in batches, and
ends when there are none left. The documents of a batch are parsed and held against the clauses that the earlier batches left of them; the
differences go to ``changes`` (Parquet by batch and part). Spark's checkpoint in OUT says which files are done. A batch that fails is run
again under its number and replaces what it had written, and it looks at earlier batches only, so it always writes the same.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clausemill.operators import clauses
from clausemill.plans import sql as S
from clausemill.sources.scratch import held

from ._common import command_line, log, parsed_of

DEFAULTS = {"headers": False, "lines_a_page": 60, "files_a_batch": 100, "parts": 64}
CHANGES = "document_id long, citation string, change string, version int, kind string, number string, page_start int, page_end int, body string, body_md5 string, batch long, part int"
KEY = ["document_id", "citation"]
ABOUT = ["kind", "number", "page_start", "page_end", "body", "body_md5"]


def changes(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(CHANGES).parquet(f"{out}/changes")


def latest(rows: DataFrame, *columns: str) -> DataFrame:
    """The last change of each clause."""
    last = F.max_by(F.struct("change", "version", *columns), "batch").alias("last")
    return rows.groupBy(*KEY).agg(last).select(*KEY, *[F.col(f"last.{c}").alias(c) for c in ("change", "version", *columns)])


def differences(new: DataFrame, before: DataFrame) -> DataFrame:
    """Clauses of a batch's documents against those before: added, changed or removed, with the number of versions so far.

    A clause that comes back after it was removed is added again; one whose text, place and number are as before gives nothing.
    """
    old = before.select(*[F.col(c).alias(f"old_{c}") for c in before.columns])
    same_key = (F.col("document_id") == F.col("old_document_id")) & (F.col("citation") == F.col("old_citation"))
    both = new.withColumn("here", F.lit(True)).join(old, same_key, "full_outer")
    had = F.coalesce(F.col("old_change") != "removed", F.lit(False))
    differs = ~(F.col("body_md5").eqNullSafe(F.col("old_body_md5")) & F.col("page_start").eqNullSafe(F.col("old_page_start")) & F.col("page_end").eqNullSafe(F.col("old_page_end")))
    change = F.when(F.col("here") & ~had, "added").when(F.col("here") & differs, "changed").when(F.col("here").isNull() & had, "removed")
    version = (F.coalesce("old_version", F.lit(0)) + F.when(F.col("here"), 1).otherwise(0)).cast("int")
    keys = [F.coalesce(c, f"old_{c}").alias(c) for c in KEY]
    return both.select(*keys, change.alias("change"), version.alias("version"), *ABOUT).where("change IS NOT NULL")


def step(docs: DataFrame, batch: int, out: str, settings: dict) -> None:
    """One batch: its documents' clauses against the earlier batches' and the differences as this batch's."""
    spark = docs.sparkSession
    # Of a document that a batch holds twice, the greatest text counts.
    one = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").groupBy(F.col("doc_id").alias("document_id")).agg(F.max("text").alias("text"))
    part = F.pmod(F.xxhash64("document_id"), F.lit(settings["parts"])).cast("int")
    with held(one) as texts:
        read = texts.count()
        fresh = clauses.stored(parsed_of(texts, settings)).withColumn("body_md5", F.md5("body"))
        earlier = changes(spark, out).where(F.col("batch") < batch) if batch else spark.createDataFrame([], CHANGES)
        touched = [r["part"] for r in texts.select(part.alias("part")).distinct().collect()]  # at most ``parts`` numbers
        mine = earlier.where(F.col("part").isin(touched)).join(texts.select("document_id"), "document_id", "left_semi")
        found = differences(fresh.select(*KEY, *ABOUT), latest(mine, "body_md5", "page_start", "page_end"))
        found.withColumn("part", part).write.mode("overwrite").partitionBy("part").parquet(f"{out}/changes/batch={batch}")
    wrote = changes(spark, out).where(F.col("batch") == batch).count()
    log.info("batch %d: read %d documents; wrote %d changes to %s/changes/batch=%d", batch, read, wrote, out, batch)


def run(spark: SparkSession, documents: str, out: str, settings: dict) -> dict:
    """Takes the files that are new, to their end; how many batches and rows of the table that made."""
    schema = spark.read.parquet(documents).select("doc_id", "text").schema
    # A stream reads a folder or what a pattern finds; as a pattern, a table may also be a single file.
    path = documents.rstrip("/")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", settings["files_a_batch"]).parquet(f"{path[:-1]}[{path[-1]}]")
    query = (
        stream.writeStream.foreachBatch(lambda docs, batch: step(docs, batch, out, settings)).option("checkpointLocation", f"{out}/_checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    done = [p for p in query.recentProgress if p["numInputRows"] > 0]
    told = {"batches": len(done), "rows": sum(p["numInputRows"] for p in done)}
    log.info("took %d new rows of %s in %d batches", told["rows"], documents, told["batches"])
    return told


def read(spark: SparkSession, out: str) -> DataFrame:
    """The clauses that hold now."""
    now = latest(changes(spark, out), *[c for c in ABOUT if c != "body"])
    return now.where("change <> 'removed'").drop("change")


SQL = S.lines_up(S.PARSED_SQL, S.STORED_SQL, select="SELECT document_id, citation, 1::INTEGER AS version, kind, number, page_start, page_end, md5(body) AS body_md5 FROM clauses")

if __name__ == "__main__":
    sys.exit(0 if command_line(run, DEFAULTS, __doc__.splitlines()[0]) is not None else 1)
