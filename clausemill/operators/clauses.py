"""Clause trees from page text, without Python in the plan.

Headers are anchored at line starts and end within their line, and pages are joined by line ends, so lines
can be read one by one: they are numbered, classified, and every document's windows (running header number,
running parents) and sums by header share one exchange on the document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X


def lines_of(pages: DataFrame) -> DataFrame:
    """pages (document_id, page_ordinal, raw_text) -> document_id, page, line_no (in its page), line."""
    lines = F.split(F.coalesce("raw_text", F.lit("")), "\n", -1)
    return pages.select("document_id", F.col("page_ordinal").cast("int").alias("page"), F.posexplode(lines).alias("line_no", "line"))


def parse_lines(lines: DataFrame) -> DataFrame:
    """lines -> document_id, ord, kind, number, citation, dieu, khoan, page_start, page_end, body; duplicates included.

    Text before a document's first header belongs to no clause. dieu and khoan are the running parents.
    """
    head = lines.withColumn("kind", X.header_kind(F.col("line")))
    head = head.withColumn("number", X.header_number(F.col("line"), F.col("kind"))).withColumn("rest", X.after_header(F.col("line"), F.col("kind")))
    order = Window.partitionBy("document_id").orderBy("page", "line_no")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    head = head.withColumn("ord", F.sum(F.when(F.col("kind").isNotNull(), 1).otherwise(0)).over(upto)).withColumn("article", F.sum(F.when(F.col("kind") == "dieu", 1).otherwise(0)).over(upto))
    head = head.where("ord > 0")
    # One row for each header, its lines gathered in order: what a clause holds is bounded by its document.
    part = F.struct("page", "line_no", "rest")
    first = lambda c: F.max(F.when(F.col("kind").isNotNull(), F.col(c)))
    per = head.groupBy("document_id", "ord").agg(
        first("article").alias("article"),
        F.max("kind").alias("kind"),
        F.max("number").alias("number"),
        first("page").alias("page_start"),
        F.max(F.when(X.has_content(F.col("rest")), F.col("page"))).alias("last"),
        F.array_join(F.sort_array(F.collect_list(part))["rest"], "\n").alias("text"),
    )
    within = Window.partitionBy("document_id", "article").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    dieu = F.last(F.when(F.col("kind") == "dieu", F.col("number")), True).over(within)
    khoan = F.last(F.when(F.col("kind") == "khoan", F.col("number")), True).over(within)
    per = per.withColumn("dieu", dieu).withColumn("khoan", khoan)
    return per.select(
        "document_id",
        F.col("ord").cast("int").alias("ord"),
        "kind",
        "number",
        X.citation(F.col("kind"), F.col("number"), F.col("dieu"), F.col("khoan")).alias("citation"),
        "dieu",
        "khoan",
        "page_start",
        F.coalesce(F.greatest("last", "page_start"), "page_start").alias("page_end"),
        X.strip(F.col("text")).alias("body"),
    )


def parse_pages(pages: DataFrame) -> DataFrame:
    return parse_lines(lines_of(pages))


def parent_numbers(parsed: DataFrame) -> DataFrame:
    """The clauses with parent_number, the numbers of their ancestors: null, (dieu) or (dieu, khoan)."""
    d, k = F.col("dieu"), F.col("khoan")
    below = F.when(F.col("kind") == "khoan", F.array(d)).when(F.col("kind") == "diem", F.when(k.isNotNull(), F.array(d, k)).otherwise(F.array(d)))
    return parsed.withColumn("parent_number", F.when(d.isNotNull(), below))


def ranked(parsed: DataFrame) -> DataFrame:
    """parsed with clause_id, parent_id and ``last``, whether it is the one of its citation to store: a table that has parsed and stored clauses in one.

    clause_id is document_id * 2^24 + the first ord, so it needs no global numbering.
    """
    by = Window.partitionBy("document_id", "citation")
    # A parent is the first clause of its name, and clauses of one name have one article and one clause above
    # them: windows below the document's partitioning, where a join would move and read everything twice.
    article, clause = Window.partitionBy("document_id", "dieu"), Window.partitionBy("document_id", "dieu", "khoan")
    rows = parsed.withColumn("first", F.min("ord").over(by)).withColumn("later", F.max("ord").over(by))
    rows = rows.withColumn("in_article", F.min(F.when(F.col("kind") == "dieu", F.col("ord"))).over(article))
    rows = rows.withColumn("in_clause", F.min(F.when(F.col("kind") == "khoan", F.col("ord"))).over(clause))
    above = F.when(F.col("kind") == "khoan", F.col("in_article")).when(F.col("kind") == "diem", F.when(F.col("khoan").isNotNull(), F.col("in_clause")).otherwise(F.col("in_article")))
    # An id has 39 bits for the document and 24 for the place in it.
    d = F.col("document_id").cast("long")
    base = F.shiftleft(F.when((d >= -(1 << 39)) & (d < 1 << 39), d).otherwise(F.raise_error(F.concat(F.lit("no clause id has room for the document "), d.cast("string"))).cast("long")), 24)
    return rows.select(*parsed.columns, (base + F.col("first")).alias("clause_id"), F.when(F.col("dieu").isNotNull(), base + above).alias("parent_id"), (F.col("ord") == F.col("later")).alias("last"))


def kept(ranked: DataFrame) -> DataFrame:
    """What ``ranked`` says is to store."""
    return ranked.where("last").select("clause_id", "document_id", "parent_id", *[c for c in ("kind", "number", "citation", "page_start", "page_end", "body", "ord", "dieu") if c in ranked.columns])


def stored(parsed: DataFrame) -> DataFrame:
    """One row for each (document, citation): the last parsed, under the id of the first; with parent_id, and with the body where parsed has it."""
    return kept(ranked(parsed))


def citation_map(parsed: DataFrame) -> DataFrame:
    """document_id and a map from citation to (kind, number, body, ord); of a repeated citation the last parsed. Its size is a document's."""
    last = F.max_by(F.struct("kind", "number", "body", "ord"), "ord").alias("clause")
    per = parsed.groupBy("document_id", "citation").agg(last)
    return per.groupBy("document_id").agg(F.map_from_entries(F.collect_list(F.struct("citation", "clause"))).alias("clauses"))


def found(rows: DataFrame, wanted: DataFrame, key: list[str]) -> DataFrame:
    """Rows with a key that is asked for, each once; keys are compared exactly."""
    return rows.join(wanted.select(*key).distinct(), key, "left_semi")


def kind_counts(clauses: DataFrame) -> DataFrame:
    return clauses.groupBy("document_id", "kind").agg(F.count("*").alias("n"))


def page_counts(pages: DataFrame) -> DataFrame:
    """The highest ordinal of each document, not its number of pages."""
    return pages.groupBy("document_id").agg(F.max("page_ordinal").cast("int").alias("page_count"))


def children(clauses: DataFrame, clause_id: int) -> DataFrame:
    return clauses.where(F.col("parent_id") == clause_id).orderBy("ord")
