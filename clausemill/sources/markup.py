"""Import of one marked-up file for each document: batches, pages and layout marks, line by line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import WS

# The marks of the format.
BATCH = r"^<!-- page (\d+)-(\d+) -->\s*$"
PAGE = "<PAGE>"
DETECTION = r"(?md)^<\|det\|>[^<]*<\|/det\|>"
PAGE_NUMBER = rf"(?md)^<\|det\|>page_number\b[^<]*<\|/det\|>{WS}*\p{{Nd}}+{WS}*$\n?"
NON_TEXT = r"(?md)^[ \t]*\[Non-Text\][ \t]*$\n?"


def cleaned(text: Column) -> Column:
    """Without printed page numbers, layout prefixes and placeholders, in that order, and line ends around it."""
    for pattern in (PAGE_NUMBER, DETECTION, NON_TEXT):
        text = F.regexp_replace(text, pattern, "")
    return F.regexp_replace(F.regexp_replace(text, r"^\n+", ""), r"\n+$", "")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """path, value: a row for each whole file."""
    return spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("path"), "value")


def _batched(files: DataFrame) -> DataFrame:
    """files (document_id, value) -> document_id, at, line, batch (by number, from 1), first, last (the batch's pages), is_batch."""
    lines = files.select("document_id", F.posexplode(F.split(F.coalesce("value", F.lit("")), "\n", -1)).alias("at", "line"))
    order = Window.partitionBy("document_id").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    is_batch = F.rlike("line", F.lit(BATCH))
    rows = lines.withColumn("is_batch", is_batch).withColumn("batch", F.sum(F.when(is_batch, 1).otherwise(0)).over(order))
    page = lambda g: F.last(F.when(F.col("is_batch"), F.expr(f"try_cast(regexp_extract(line, r'{BATCH}', {g}) AS INT)")), True).over(order)
    rows = rows.withColumn("first", page(1)).withColumn("last", page(2))
    none = F.max("batch").over(Window.partitionBy("document_id")) == 0
    return rows.withColumn("batch", F.when(none, F.raise_error(F.lit("a file has no page markers"))).otherwise(F.col("batch"))).where("batch > 0")


def _texts(batched: DataFrame) -> DataFrame:
    """document_id, batch, page_ordinal, raw_text of the pages that have a mark."""
    starts = F.startswith("line", F.lit(PAGE))
    within = Window.partitionBy("document_id", "batch").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rows = batched.where("NOT is_batch").withColumn("k", F.sum(F.when(starts, 1).otherwise(0)).over(within)).where("k > 0")
    rows = rows.withColumn("page_ordinal", F.col("first") + F.col("k").cast("int") - 1).where("page_ordinal <= last")
    rows = rows.withColumn("said", F.when(starts, F.substring("line", len(PAGE) + 1, 1 << 30)).otherwise(F.col("line")))
    # The line end before a batch line belongs to the page before it; it is a line end at the page's end, and goes.
    per = rows.groupBy("document_id", "batch", "page_ordinal").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "said"))), lambda x: x["said"]), "\n").alias("text"))
    return per.select("document_id", "batch", "page_ordinal", cleaned(F.col("text")).alias("raw_text"))


def split_pages(files: DataFrame) -> DataFrame:
    """files (document_id, value) -> document_id, page_ordinal, raw_text of the pages that have a mark.

    A batch line opens pages N to M; each <PAGE> at a line start takes the next of them, and marks beyond M are
    dropped. A page of several batches has the text of the last that has a mark for it. Text before the first
    batch, and in a batch before its first mark, is dropped. A document without a batch line fails.
    """
    last = Window.partitionBy("document_id", "page_ordinal").orderBy(F.desc("batch"))
    return _texts(_batched(files)).withColumn("n", F.row_number().over(last)).where("n = 1").select("document_id", "page_ordinal", "raw_text")


def import_pages(registered: DataFrame, files: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """Registered pages that aren't done, with their text in the last batch that names them; '' where that has no mark for
    them, and where no batch names them."""
    todo = registered if done is None else registered.join(done.select("document_id", "page_ordinal"), ["document_id", "page_ordinal"], "left_anti")
    batched = _batched(files)
    ranges = batched.where("is_batch").select(F.col("document_id").alias("d"), "batch", "first", "last")
    # Within a document, its pages meet its batch lines.
    named = todo.select("document_id", "page_ordinal").join(ranges, (F.col("document_id") == F.col("d")) & F.col("page_ordinal").between(F.col("first"), F.col("last")))
    last = named.groupBy("document_id", "page_ordinal").agg(F.max("batch").alias("batch"))
    text = last.join(_texts(batched), ["document_id", "batch", "page_ordinal"]).drop("batch")
    return todo.join(text, ["document_id", "page_ordinal"], "left").withColumn("raw_text", F.coalesce("raw_text", F.lit("")))


# ---- the registered queries: documents as files, a batch line every 6 lines and a page mark every 2; a last batch names
# pages 1 and 2 again and has a mark for 1 only


def _as_file(text: str) -> str:
    return f"""array_join(transform(split({text}, '\\n', -1), (l, i) -> concat(
        CASE WHEN i % 6 = 0 THEN concat('<!-- page ', cast(1 + 2 * (i div 6) AS STRING), '-', cast(2 + 2 * (i div 6) AS STRING), ' -->\\n') ELSE '' END,
        CASE WHEN i % 2 = 0 THEN '<PAGE><|det|>page_number [1,2]<|/det|>7\\n<|det|>title [1,2]<|/det|>' WHEN i % 6 = 3 THEN '[Non-Text]\\n' ELSE '' END, l)), '\\n') || '\\n<!-- page 1-2 -->\\n<PAGE>again'"""


def page_import_query(documents: DataFrame) -> DataFrame:
    docs = documents.where("text IS NOT NULL").select(F.col("doc_id").alias("document_id"), "text")
    count = F.size(F.split("text", "\n", -1))
    registered = docs.select("document_id", F.explode(F.sequence(F.lit(1), F.floor((count + 5) / 6).cast("int") * 2)).alias("page_ordinal"))
    files = docs.select("document_id", F.expr(_as_file("text")).alias("value"))
    got = import_pages(registered, files)
    return got.select("document_id", "page_ordinal", F.md5("raw_text").alias("text_md5"), F.length("raw_text").alias("chars"))


#: Page k of a batch of six lines holds lines 2k and 2k + 1: the format's marks go, the third pair is surplus.
PAGE_IMPORT_SQL = r"""
WITH l AS (SELECT doc_id, unnest(s) AS line, unnest(range(0, len(s))) AS i, len(s) AS n FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents WHERE text IS NOT NULL)
), pages AS (
  SELECT doc_id, 1 + 2 * (i // 6) + (i % 6) // 2 AS page, string_agg(line, chr(10) ORDER BY i) AS text FROM l WHERE i % 6 < 4 GROUP BY ALL
), every AS (SELECT DISTINCT doc_id, unnest(range(1, 2 * ((n + 5) // 6) + 1)) AS page FROM l
), clean AS (
  SELECT e.doc_id, e.page, CASE e.page WHEN 1 THEN 'again' WHEN 2 THEN '' ELSE regexp_replace(regexp_replace(coalesce(text, ''), '^\n+', ''), '\n+$', '') END AS text FROM every e LEFT JOIN pages USING (doc_id, page)
)
SELECT doc_id AS document_id, page::INTEGER AS page_ordinal, md5(text) AS text_md5, length(text)::INTEGER AS chars FROM clean
"""


def clean_query(pages: DataFrame) -> DataFrame:
    marked = F.expr(
        "array_join(transform(split(coalesce(html, ''), '\\n', -1), (l, i) -> concat('<|det|>text [', cast(i AS STRING), ']<|/det|>', l, CASE WHEN i % 3 = 1 THEN '\\n  [Non-Text] ' WHEN i % 3 = 2 THEN '\\n<|det|>page_number [0]<|/det|> 12' ELSE '' END)), '\\n')"
    )
    text = cleaned(marked)
    return pages.select("page_id", F.md5(text).alias("text_md5"), F.length(text).alias("chars"))


CLEAN_SQL = r"""
SELECT page_id, md5(t) AS text_md5, length(t)::INTEGER AS chars
FROM (SELECT page_id, regexp_replace(regexp_replace(coalesce(html, ''), '^\n+', ''), '\n+$', '') AS t FROM pages)
"""
