"""Invariants over the clause graph: issues fail a document, notes don't."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X

_REPORT = ("document_id", "severity", "rule", "key", "message")


def _row(df: DataFrame, severity: str, rule: str, key, message) -> DataFrame:
    return df.select("document_id", F.lit(severity).alias("severity"), F.lit(rule).alias("rule"), key.cast("string").alias("key"), message.alias("message"))


def chapter_pages(lines: DataFrame) -> DataFrame:
    """(document_id, page) with a chapter mark at a line start."""
    return lines.where(F.rlike(F.col("line"), F.lit(X.CHAPTER))).select("document_id", F.col("page").alias("chapter_page")).distinct()


def articles(clauses: DataFrame) -> DataFrame:
    """Articles with their number and the pages where a chapter mark before them may stand (lo..page_start)."""
    rows = clauses.where(F.col("kind") == "dieu").withColumn("num", F.expr("try_cast(number AS INT)")).where("num IS NOT NULL")
    before = Window.partitionBy("document_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("lo", F.greatest(F.coalesce(F.max("page_end").over(before), F.lit(0)), F.lit(1)))


def after_chapter(clauses: DataFrame, lines: DataFrame) -> DataFrame:
    """Articles with a chapter mark in the page range before them: (document_id, ord)."""
    marks = chapter_pages(lines).withColumnRenamed("document_id", "d")
    rows = articles(clauses)
    on = (F.col("document_id") == F.col("d")) & F.col("chapter_page").between(F.col("lo"), F.col("page_start"))
    return rows.join(marks, on, "left_semi").select("document_id", "ord")


def numbering_gaps(clauses: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Missing article numbers, a row for each range of them: document_id, first_missing, last_missing, before_ord, after_ord, by_chapter.

    before_ord: the last article with a smaller number; after_ord: the first with a larger one. Numbers stand once, in
    their order, so a range costs a row however long it is.
    """
    rows = articles(clauses).groupBy("document_id", F.col("num").cast("long").alias("num")).agg(F.max("ord").alias("hi"), F.min("ord").alias("lo"))
    order = Window.partitionBy("document_id").orderBy("num")
    found = rows.select(
        "document_id",
        (F.col("num") + 1).alias("first_missing"),
        (F.lead("num").over(order) - 1).alias("last_missing"),
        F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("before_ord"),
        F.min("lo").over(order.rowsBetween(1, Window.unboundedFollowing)).alias("after_ord"),
    ).where("last_missing >= first_missing")
    if lines is None:
        return found.withColumn("by_chapter", F.lit(False))
    marked = after_chapter(clauses, lines).select(F.col("document_id").alias("d"), F.col("ord").alias("o"), F.lit(True).alias("marked"))
    out = found.join(marked, (F.col("document_id") == F.col("d")) & (F.col("after_ord") == F.col("o")), "left")
    return out.select(*found.columns, F.coalesce("marked", F.lit(False)).alias("by_chapter"))


def extra_numbers(clauses: DataFrame) -> DataFrame:
    """(document_id, num) of article numbers outside the range from the least to the highest: there are none, as the numbers make the range."""
    rows = articles(clauses).select("document_id", F.col("num").cast("long").alias("num")).distinct()
    all_ = Window.partitionBy("document_id")
    return rows.withColumn("lo", F.min("num").over(all_)).withColumn("hi", F.max("num").over(all_)).where("num < lo OR num > hi").select("document_id", "num")


def _range(first, last):
    return F.when(first == last, first.cast("string")).otherwise(F.concat_ws("-", first.cast("string"), last.cast("string")))


def _rules(df: DataFrame, *rules: tuple) -> DataFrame:
    """Issues of rows for which a rule's condition holds, in one pass; rules: (name, condition, key, message)."""
    each = [F.when(bad, F.struct(F.lit(name).alias("rule"), key.cast("string").alias("key"), F.lit(message).alias("message"))) for name, bad, key, message in rules]
    found = df.select("document_id", F.explode(F.filter(F.array(*each), lambda x: x.isNotNull())).alias("x"))
    return found.select("document_id", F.lit("issue").alias("severity"), "x.rule", "x.key", "x.message")


def check(documents: DataFrame, clauses: DataFrame, references: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """All violations of all documents: (document_id, severity, rule, key, message). Clauses are read several times, so write them first."""
    have = clauses.select("document_id").distinct()
    none = _row(documents.join(have, "document_id", "left_anti"), "issue", "has_clauses", F.lit(None), F.lit("no clauses for the document"))
    empty = F.coalesce(X.strip(F.col("body")), F.lit("")) == ""
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    of_clauses = _rules(clauses, ("citation", blank("citation"), F.col("clause_id"), "empty citation"), ("body", empty, F.col("citation"), "empty body"))
    refs = references.join(clauses.select(F.col("clause_id").alias("src_clause_id")).hint("merge"), "src_clause_id", "left_semi")  # as in ``references.resolve``
    of_references = _rules(refs, *[(c, blank(c), F.col("src_clause_id"), f"empty {c}") for c in ("raw_text", "target_citation")])
    each = F.struct("first_missing", _range(F.col("first_missing"), F.col("last_missing")).alias("said"))
    gaps = numbering_gaps(clauses, lines).where("NOT by_chapter").groupBy("document_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(each)), lambda x: x["said"]), ", ").alias("gaps"))
    note = _row(gaps, "note", "numbering", F.lit(None), F.concat(F.lit("numbers missing without a chapter boundary: "), F.col("gaps")))
    return none.unionByName(of_clauses).unionByName(of_references).unionByName(note)


def report(documents: DataFrame, violations: DataFrame) -> DataFrame:
    """document_id, ok, issues, notes."""
    per = violations.groupBy("document_id").agg(F.count_if(F.col("severity") == "issue").alias("issues"), F.count_if(F.col("severity") == "note").alias("notes"))
    out = documents.select("document_id").join(per, "document_id", "left")
    issues, notes = (F.coalesce(c, F.lit(0)).cast("long") for c in ("issues", "notes"))
    return out.select("document_id", (issues == 0).alias("ok"), issues.alias("issues"), notes.alias("notes"))
