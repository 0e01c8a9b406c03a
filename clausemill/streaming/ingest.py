"""Page records as a file stream: new files become clauses once, whatever fails in between."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import clauses, references
from ..schemas import OCR_PAGES
from ..sources.scratch import held
from ..sources.store import Store


def page_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(OCR_PAGES).option("maxFilesPerTrigger", files_per_batch).json(path)


def ingest(spark: SparkSession, path: str, books: Store, checkpoint: str) -> StreamingQuery:
    """All files that are there now, then an end: each micro-batch adds its pages and parses the documents they belong to anew.

    The writes are upserts by natural key, so a batch that runs twice leaves what one run leaves.
    """

    def batch(pages: DataFrame, _: int) -> None:
        if pages.isEmpty():
            return
        known = books.save_pages(pages)
        touched = known.join(pages.select("document_id").distinct(), "document_id", "left_semi")
        structure(books, touched)

    return page_stream(spark, path).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def structure(books: Store, pages: DataFrame, rebuild: bool = False) -> None:
    """Clauses and references of the pages' documents into the store; with rebuild, what they had goes first."""
    if rebuild:
        books.delete_documents(pages.select("document_id").distinct())
    with held(clauses.parse_pages(pages)) as parsed:
        kept = books.save_clauses(clauses.stored(parsed))
        mine = kept.join(pages.select("document_id").distinct(), "document_id", "left_semi")
        books.save_references(references.numbered(references.resolve(references.extract(parsed), mine)))
    whole = pages.select("document_id").distinct().select("document_id", F.lit(0).cast("long").alias("unit_id"), F.lit("done").alias("status"))
    books.mark(whole, "structure")
