"""As-of joins and running sums that split a long key into ranges, with what one range hands to the next.

A window over a key holds all its rows in one task. Here a key's rows are dealt by ranges of their order too, each range is worked out by
itself, and a second level of one row a range carries sums, or last rows, across them. Everything is plans over DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X


def running_sum(rows: DataFrame, by: Sequence[str], order: str, value: str, name: str = "before", width: int = 4096) -> DataFrame:
    """rows with ``name``: the sum of ``value`` over the rows of their key that come before them in the order of a whole number.

    Ranges of ``width`` numbers are summed by themselves, and their sums run along the key. Rows of one number come in no order among
    themselves, so numbers should stand once in a key; null values count as 0; a row without a key has no sum.
    """
    part = F.floor(F.col(order) / width).alias("__range")
    some = F.coalesce(F.col(value), F.lit(0)).cast("long")
    totals = rows.groupBy(*by, part).agg(F.sum(some).alias("__sum"))
    along = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*[F.col(c).alias(f"__{c}") for c in by], F.col("__range").alias("__r"), F.coalesce(F.sum("__sum").over(along), F.lit(0)).alias("__carry"))
    ranged = rows.withColumn("__range", F.floor(F.col(order) / width))
    on = F.col("__range") == F.col("__r")
    for c in by:
        on = on & (F.col(c) == F.col(f"__{c}"))
    inside = Window.partitionBy(*by, "__range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.withColumn("__in", F.coalesce(F.sum(some).over(inside), F.lit(0))).join(carried, on, "left")
    return out.withColumn(name, F.col("__in") + F.col("__carry")).select(*[c for c in rows.columns if c != name], name)


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], at: str, right_at: str, take: Sequence[str], width: int = 1 << 16) -> DataFrame:
    """left with ``take``, the columns of the right row of its key that is the last with ``right_at`` <= ``at``; null where there is none.

    Both sides are one table, sorted within ranges of ``width`` units of the order: a left row takes the last right row before it in its
    range, or else what the last range with right rows hands on. Of right rows at one place the greatest, by ``take``, counts. Rows whose key or
    place is null find nothing; left rows keep their number and other columns.
    """
    keys = [f"__k{i}" for i in range(len(by))]
    place, given = F.col("__at"), F.struct(*[F.col(f"`{c}`").alias(f"t{i}") for i, c in enumerate(take)])
    known = lambda df, order: df.where(F.col(order).isNotNull()).where(" AND ".join([f"`{c}` IS NOT NULL" for c in by]))
    kept = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    lrows = known(left, at).select(*[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], F.col(at).cast("long").alias("__at"), F.lit(1).alias("__side"), kept.alias("__row"), F.lit(None).cast(right.select(given).schema[0].dataType).alias("__take"))
    rrows = known(right, right_at).select(*[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], F.col(right_at).cast("long").alias("__at"), F.lit(0).alias("__side"), F.lit(None).cast(left.select(kept).schema[0].dataType).alias("__row"), given.alias("__take"))
    # A right row is worth its columns even if they are all null, so it is wrapped once more.
    both = lrows.unionByName(rrows).withColumn("__range", F.floor(place / width)).withColumn("__have", F.when(F.col("__side") == 0, F.struct("__at", "__take")))
    upto = Window.partitionBy(*keys, "__range").orderBy("__at", "__side", "__take").rowsBetween(Window.unboundedPreceding, 0)
    filled = both.withColumn("__last", F.last("__have", True).over(upto)).where("__side = 1")
    ends = rrows.groupBy(*keys, F.floor(place / width).alias("__range")).agg(F.max(F.struct("__at", "__take")).alias("__end"))
    # One row for each range with right rows, and one before it where left rows lack one: the last right row of the ranges before.
    asked = filled.where("__last IS NULL").select(*keys, "__range").distinct()
    steps = asked.withColumn("__end", F.lit(None).cast(ends.schema["__end"].dataType)).withColumn("__asks", F.lit(True)).unionByName(ends.withColumn("__asks", F.lit(False)))
    before = Window.partitionBy(*keys).orderBy("__range", F.desc("__asks")).rowsBetween(Window.unboundedPreceding, -1)
    handed = steps.withColumn("__carry", F.last("__end", True).over(before)).where("__asks").select(*[F.col(k).alias(f"{k}r") for k in keys], F.col("__range").alias("__r"), "__carry")
    on = F.col("__range") == F.col("__r")
    for k in keys:
        on = on & (F.col(k) == F.col(f"{k}r"))
    lacking = filled.where("__last IS NULL").join(handed, on, "left").select("__row", F.col("__carry.__take").alias("__take"))
    found = filled.where("__last IS NOT NULL").select("__row", F.col("__last.__take").alias("__take")).unionByName(lacking)
    out = found.select("__row.*", *[F.col("__take")[f"t{i}"].alias(c) for i, c in enumerate(take)])
    unknown = left.where(F.col(at).isNull() | F.expr(" OR ".join(f"`{c}` IS NULL" for c in by)))
    return out.unionByName(unknown.select("*", *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in take]))


# ---- pages from offsets


def page_starts(pages: DataFrame, width: int = 4096) -> DataFrame:
    """pages (document_id, page_ordinal, raw_text) -> document_id, page_ordinal, start: where each page begins in the document's text.

    Pages follow each other by their ordinals, with a line end between them.
    """
    sized = pages.select("document_id", F.col("page_ordinal").cast("long").alias("page_ordinal"), (F.length(F.coalesce("raw_text", F.lit(""))) + 1).cast("long").alias("chars"))
    return running_sum(sized, ["document_id"], "page_ordinal", "chars", "start", width).select("document_id", "page_ordinal", "start")


def pages_at(offsets: DataFrame, starts: DataFrame, at: str = "offset", width: int = 1 << 16) -> DataFrame:
    """offsets (document_id, offset, ...) with page: the page of the document's text that the offset lies on; null before the first."""
    return asof_join(offsets, starts.select("document_id", F.col("start").alias("__start"), F.col("page_ordinal").cast("int").alias("page")), ["document_id"], at, "__start", ["page"], width)


def header_offsets(lines: DataFrame, width: int = 4096) -> DataFrame:
    """lines (document_id, page, line_no, line) -> document_id, offset, kind of each header line: its place in the document's text.

    line_no counts on within the document.
    """
    sized = lines.withColumn("chars", (F.length("line") + 1).cast("long"))
    placed = running_sum(sized, ["document_id"], "line_no", "chars", "offset", width)
    return placed.withColumn("kind", X.header_kind(F.col("line"))).where("kind IS NOT NULL").select("document_id", "offset", "kind", F.col("page").alias("line_page"))
