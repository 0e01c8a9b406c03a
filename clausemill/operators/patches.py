"""Corrections smaller than a page: stretches of a page's text are replaced, and places in the text move along.

A page's patches are few, so they are worked on as an array beside its text, by expressions; pages meet their patches in one join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE = ["document_id", "page_ordinal"]
PATCH = "array<struct<start:int,end:int,text:string,chars:int,at:int>>"


def _kept(patches: Column, length: Column) -> Column:
    """The patches that count, in order of their places. Of two that overlap the later in order counts; one that doesn't lie in the text doesn't.

    Two patches overlap if they share a character, or one lies strictly within the other, or both put something in at one place.
    """
    fits = F.filter(patches, lambda p: (p["start"] >= 0) & (p["start"] <= p["end"]) & (p["end"] <= length))
    latest = F.reverse(F.array_sort(fits))
    apart = lambda p, q: ((p["end"] <= q["start"]) | (q["end"] <= p["start"])) & ~((p["start"] == q["start"]) & (p["end"] == q["end"]))
    none = F.filter(latest, lambda _: F.lit(False))
    chosen = F.aggregate(latest, none, lambda kept, p: F.when(F.forall(kept, lambda q: apart(p, q)), F.concat(kept, F.array(p))).otherwise(kept))
    # An insertion at the start of a replaced stretch stands before it.
    places = F.transform(chosen, lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), p["text"].alias("text")))
    return F.array_sort(places)


def _placed(kept: Column) -> Column:
    """Patches with the length of their text, and where that begins in the new text."""
    empty = F.array().cast(PATCH)
    size = lambda p: F.length(p["text"])

    def add(out: Column, p: Column) -> Column:
        last = F.try_element_at(out, F.lit(-1))
        at = F.when(F.size(out) == 0, p["start"]).otherwise(last["at"] + last["chars"] + p["start"] - last["end"])
        return F.concat(out, F.array(F.struct(p["start"].alias("start"), p["end"].alias("end"), p["text"].alias("text"), size(p).alias("chars"), at.alias("at"))))

    return F.aggregate(kept, empty, add)


def corrected(pages: DataFrame, patches: DataFrame) -> DataFrame:
    """pages (document_id, page_ordinal, raw_text, ...) with their text after the patches, and ``moves``, which says what went where.

    patches: document_id, page_ordinal, seq, start, end (in characters of the text before, end exclusive), text. ``seq`` orders patches; of
    equal ones those of higher places and texts come later. A null text deletes. Pages without patches are as they were, with no moves;
    patches of pages that aren't there do nothing; a page without text is empty.
    """
    one = F.struct(F.col("seq").cast("long").alias("seq"), F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"), F.coalesce("text", F.lit("")).alias("text"))
    whole = F.col("seq").isNotNull() & F.col("start").isNotNull() & F.col("end").isNotNull()
    per = patches.where(whole).groupBy(*PAGE).agg(F.array_distinct(F.collect_list(one)).alias("__patches"))
    rows = pages.join(per, PAGE, "left").withColumn("__text", F.coalesce("raw_text", F.lit("")))
    moves = F.coalesce(_placed(_kept(F.col("__patches"), F.length("__text"))), F.array().cast(PATCH))
    rows = rows.withColumn("moves", moves)
    # What lies between two patches, and after the last, is as it was.
    before = F.transform("moves", lambda p, i: F.concat(F.substr(F.col("__text"), F.when(i == 0, F.lit(0)).otherwise(F.get("moves", i - 1)["end"]) + 1, p["start"] - F.when(i == 0, F.lit(0)).otherwise(F.get("moves", i - 1)["end"])), p["text"]))
    rest = F.substr(F.col("__text"), F.coalesce(F.try_element_at("moves", F.lit(-1))["end"], F.lit(0)) + 1)
    text = F.when(F.size("moves") > 0, F.concat(F.array_join(before, ""), rest)).otherwise(F.col("raw_text"))
    return rows.withColumn("raw_text", text).select(*[c for c in pages.columns if c != "moves"], "moves")


def moved(offset: Column, moves: Column, end: bool = False) -> Column:
    """Where a place of the text before is in the new one. A place within a replaced stretch goes to where its text begins, or ends.

    An insertion at a place stands before what begins there, and after what ends there.
    """
    passed = F.filter(moves, lambda p: (p["end"] <= offset) & ((p["start"] < offset) | F.lit(not end)))
    last = F.try_element_at(passed, F.lit(-1))
    shifted = F.coalesce(last["at"] + last["chars"] - last["end"], F.lit(0)) + offset
    inside = F.try_element_at(F.filter(moves, lambda p: (p["start"] < offset) & (offset < p["end"])), F.lit(-1))
    return F.coalesce(inside["at"] + F.when(F.lit(end), inside["chars"]).otherwise(F.lit(0)), shifted)


def moved_spans(spans: DataFrame, pages: DataFrame) -> DataFrame:
    """spans (document_id, page_ordinal, start, end, ...) of the text before, in the text of ``corrected`` pages; ``touched`` says whether a patch changed it."""
    known = pages.select(*[F.col(c).alias(f"__{c}") for c in PAGE], F.col("moves").alias("__moves"))
    on = (F.col("document_id") == F.col("__document_id")) & (F.col("page_ordinal") == F.col("__page_ordinal"))
    rows = spans.join(known, on, "left").withColumn("__moves", F.coalesce("__moves", F.array().cast(PATCH)))
    touched = F.exists("__moves", lambda p: (p["start"] < F.col("end")) & (p["end"] > F.col("start")))
    out = rows.withColumn("__s", moved(F.col("start"), F.col("__moves"))).withColumn("__e", moved(F.col("end"), F.col("__moves"), True)).withColumn("touched", touched)
    return out.withColumn("start", F.col("__s")).withColumn("end", F.greatest("__s", "__e")).select(*[c for c in spans.columns if c != "touched"], "touched")


# ---- the registered query


def patches_query(lines: DataFrame) -> DataFrame:
    """Every page corrected by four patches, two of which overlap, and the spans of its lines moved along."""
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    pages = lines.groupBy("document_id", F.col("page").alias("page_ordinal")).agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("raw_text"))
    each = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(("seq", "start", "end", "text"), p, strict=True)]) for p in PATCHES])
    fixed = corrected(pages, pages.select(*PAGE, F.inline(each)))
    length = F.length("line")
    cuts = F.transform(F.sequence(F.lit(1), F.size(F.split("raw_text", "\n", -1))), lambda i: F.length(F.array_join(F.slice(F.split("raw_text", "\n", -1), F.lit(1), i), "\n")))
    spans = pages.select(*PAGE, F.posexplode(F.split("raw_text", "\n", -1)).alias("i", "line"), cuts.alias("cuts"))
    spans = spans.select(*PAGE, "i", (F.get("cuts", F.col("i")) - length).alias("start"), F.get("cuts", F.col("i")).alias("end"))
    said = F.format_string("%d-%d-%s", "start", "end", F.col("touched").cast("string"))
    per = moved_spans(spans, fixed).groupBy(*PAGE).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", said.alias("s")))), lambda x: x["s"]), ",").alias("spans"))
    return fixed.join(per, PAGE).select("document_id", "page_ordinal", F.md5("raw_text").alias("text_md5"), F.size("moves").alias("patches"), "spans")


#: (seq, start, end, text): the third overlaps the second and is later; the last puts something in.
PATCHES = ((1, 4, 6, "SỬA LẠI"), (2, 10, 14, "x"), (3, 12, 20, ""), (4, 30, 30, "chèn "))
PATCHES_SQL = """
joined AS (SELECT document_id, page AS page_ordinal, string_agg(line, chr(10) ORDER BY line_no) AS t FROM lines GROUP BY 1, 2
), flags AS (SELECT *, length(t) >= 6 AS p1, length(t) BETWEEN 14 AND 19 AS p2, length(t) >= 20 AS p3, length(t) >= 30 AS p4 FROM joined
), fixed AS (
  SELECT *, CASE WHEN p1 THEN left(t, 4) || 'SỬA LẠI' || substr(t, 7, 4) ELSE left(t, 10) END
         || CASE WHEN p3 THEN substr(t, 11, 2) || substr(t, 21, 10) WHEN p2 THEN 'x' || substr(t, 15, 16) ELSE substr(t, 11, 20) END
         || CASE WHEN p4 THEN 'chèn ' ELSE '' END || substr(t, 31) AS new
  FROM flags
), cut AS (
  SELECT l.document_id, l.page AS page_ordinal, l.line_no, length(l.line) AS n, sum(length(l.line) + 1) OVER (PARTITION BY l.document_id, l.page ORDER BY l.line_no) - 1 AS e FROM lines l
), placed AS (SELECT c.*, e - n AS s, p1, p2, p3, p4 FROM cut c JOIN flags USING (document_id, page_ordinal)
), moved AS (
  SELECT *,
    CASE WHEN p1 AND s > 4 AND s < 6 THEN 4 WHEN p2 AND s > 10 AND s < 14 THEN 10 + d1 WHEN p3 AND s > 12 AND s < 20 THEN 12 + d1
      ELSE s + CASE WHEN p1 AND s >= 6 THEN 5 ELSE 0 END + CASE WHEN p2 AND s >= 14 THEN -3 ELSE 0 END + CASE WHEN p3 AND s >= 20 THEN -8 ELSE 0 END + CASE WHEN p4 AND s >= 30 THEN 5 ELSE 0 END END AS ns,
    CASE WHEN p1 AND e > 4 AND e < 6 THEN 11 WHEN p2 AND e > 10 AND e < 14 THEN 11 + d1 WHEN p3 AND e > 12 AND e < 20 THEN 12 + d1
      ELSE e + CASE WHEN p1 AND e >= 6 THEN 5 ELSE 0 END + CASE WHEN p2 AND e >= 14 THEN -3 ELSE 0 END + CASE WHEN p3 AND e >= 20 THEN -8 ELSE 0 END + CASE WHEN p4 AND e > 30 THEN 5 ELSE 0 END END AS ne,
    coalesce((p1 AND 4 < e AND 6 > s) OR (p2 AND 10 < e AND 14 > s) OR (p3 AND 12 < e AND 20 > s) OR (p4 AND 30 < e AND 30 > s), false) AS touched
  FROM (SELECT *, CASE WHEN p1 THEN 5 ELSE 0 END AS d1 FROM placed)
), spans AS (SELECT document_id, page_ordinal, string_agg(ns || '-' || greatest(ns, ne) || '-' || touched, ',' ORDER BY line_no) AS spans FROM moved GROUP BY 1, 2)
"""
