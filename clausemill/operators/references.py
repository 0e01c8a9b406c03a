"""References between clauses: extraction, resolution against the clause table, and their graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X


def found(parsed: DataFrame, strict_digits: bool = False) -> DataFrame:
    """parsed clauses with what their texts refer to, in the texts' place: all that ``extract`` needs of them, and much less to keep."""
    return parsed.withColumn("found", X.references(F.col("body"), strict_digits)).drop("body")


def extract(parsed: DataFrame, strict_digits: bool = False) -> DataFrame:
    """parsed clauses, also those of ``found`` -> document_id, ord, citation, dieu, place, kind, raw_text, target_citation.

    Sorted by where the raw text first occurs; of equal (raw text, target), letter case aside, the first stays.
    """
    # Not by ``inline``, before which the optimizer tests the array for rows, and so works it out again.
    held = parsed if "found" in parsed.columns else found(parsed, strict_digits)
    rows = held.select("document_id", "ord", "citation", "dieu", F.inline_outer("found")).where("rank IS NOT NULL")
    key = Window.partitionBy("document_id", "ord", F.lower("raw_text"), F.lower("target_citation")).orderBy("position", "rank", "place")
    first = rows.withColumn("n", F.row_number().over(key)).where("n = 1")
    order = Window.partitionBy("document_id", "ord").orderBy("position", "rank", "place")
    return first.select("document_id", "ord", "citation", "dieu", F.row_number().over(order).alias("place"), "kind", "raw_text", "target_citation")


def resolve(extracted: DataFrame, clauses: DataFrame) -> DataFrame:
    """extracted references, stored clauses -> references with src and dst ids; a miss dangles as external.

    Of one (source, raw text, target) the first stays. dst_clause_id is null where nothing is found.
    """
    # Both joins move both sides: files of clauses are many times smaller than their rows, and by the files Spark would broadcast a table that grows.
    refs = extracted.withColumn("target", X.resolved_target(F.col("kind"), F.col("target_citation"), F.col("dieu")))
    source = clauses.select(F.col("document_id").alias("sd"), F.col("citation").alias("sc"), F.col("clause_id").alias("src_clause_id"))
    target = clauses.select(F.col("document_id").alias("td"), F.col("citation").alias("tc"), F.col("clause_id").alias("dst_clause_id"))
    rows = refs.join(source.hint("merge"), (F.col("document_id") == F.col("sd")) & (F.col("citation") == F.col("sc")))
    key = Window.partitionBy("document_id", "src_clause_id", "raw_text", "target").orderBy("ord", "place")
    rows = rows.withColumn("n", F.row_number().over(key)).where("n = 1")
    both = rows.join(target.hint("merge"), (F.col("document_id") == F.col("td")) & (F.col("target") == F.col("tc")) & (F.col("kind") != "external"), "left")
    return both.select(
        "document_id",
        "src_clause_id",
        "dst_clause_id",
        F.when(F.col("dst_clause_id").isNotNull(), "internal").otherwise("external").alias("kind"),
        "raw_text",
        F.col("target").alias("target_citation"),
        F.lit(None).cast("long").alias("target_document_id"),
        "ord",
        "place",
    )


def numbered(references: DataFrame) -> DataFrame:
    """With reference_id: the document, then the place in it."""
    order = Window.partitionBy("document_id").orderBy("ord", "place", "raw_text")
    return references.withColumn("reference_id", F.shiftleft(F.col("document_id").cast("long"), 24) + F.row_number().over(order))


def dangling(references: DataFrame) -> DataFrame:
    return references.where(F.col("dst_clause_id").isNull())


def of_clause(references: DataFrame, clause_id: int, direction: str = "out") -> DataFrame:
    if direction not in ("out", "in"):
        raise ValueError(f"direction is out or in, not {direction!r}")
    return references.where(F.col("src_clause_id" if direction == "out" else "dst_clause_id") == clause_id)


def in_degrees(references: DataFrame) -> DataFrame:
    return references.where(F.col("dst_clause_id").isNotNull()).groupBy("document_id", "dst_clause_id").agg(F.count("*").alias("n"))


def summary(pages: DataFrame, parsed: DataFrame, extracted: DataFrame, references: DataFrame) -> DataFrame:
    """Counts by document, of what was parsed and extracted and of what is stored. There are as many of each as documents, so none is broadcast."""
    page = pages.groupBy("document_id").agg(F.max("page").cast("int").alias("pages"))
    clause = parsed.groupBy("document_id").agg(F.count("*").alias("clauses"), F.countDistinct("citation").alias("clauses_stored"))
    found = extracted.groupBy("document_id").agg(F.count("*").alias("refs_extracted"))
    kept = references.groupBy("document_id").agg(F.count_if(F.col("kind") == "internal").alias("refs_internal"), F.count_if(F.col("kind") == "external").alias("refs_external"))
    out = page
    for counts in (clause, found, kept):
        out = out.join(counts.hint("merge"), "document_id", "left")
    return out.select("document_id", "pages", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("clauses", "clauses_stored", "refs_extracted", "refs_internal", "refs_external")])
