"""External references to the version of an instrument that held when it was cited.

An instrument has a canonical key: its numbers, and the letters of its kind and issuer. Letters may be misspelt by one edit, found by what
is left when one letter is dropped on either side, so nothing is compared with all; numbers must be right, as another number is another
instrument. An instrument's versions are the documents of its key, each from its own date on; a reference is resolved as of its date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..sources.scratch import written
from .asof import asof_join

#: Why a reference stays dangling.
NOT_NAMED, UNKNOWN, SEVERAL, NO_DATE, NOT_YET = "names no instrument", "not in the corpus", "several are spelt like it", "cited without a date", "no version held then"
EXACT, SPELT = "key", "spelling"

_NAME = rf"^{X.WS}*({'|'.join(k.upper() for k in X.INSTRUMENTS)}){X.WS}+SỐ{X.WS}+([0-9]+(?:[/-][0-9A-ZĐƠƯ]+)*)"


def key_of(citation: Column) -> tuple[Column, Column]:
    """(numbers without leading zeros, joined by ``/``; kind and the rest in capitals) of a citation's instrument; null where it names none."""
    said = F.upper(X.folded_digits(citation))
    kind, code = F.regexp_extract(said, _NAME, 1), F.regexp_extract(said, _NAME, 2)
    numbers = F.transform(F.regexp_extract_all(code, F.lit(r"[0-9]+"), F.lit(0)), lambda x: F.regexp_replace(x, "^0+(?=[0-9])", ""))
    named = kind != ""
    return F.when(named, F.array_join(numbers, "/")), F.when(named, F.concat(kind, F.lit(" "), F.regexp_replace(code, "[0-9]+", "")))


def shortened(letters: Column) -> Column:
    """The letters, and what is left of them without any one: two texts within one edit of each other share one of these."""
    places = F.sequence(F.lit(1), F.greatest(F.length(letters), F.lit(1)))
    left = F.transform(places, lambda i: F.concat(F.substr(letters, F.lit(1), i - 1), F.substr(letters, i + 1)))
    return F.array_distinct(F.concat(F.array(letters), left))


def versions(documents: DataFrame) -> DataFrame:
    """documents (document_id, title, effective_from) -> numbers, letters, since (in days), version, document_id: one row for each date on which
    an instrument has a document; of several on one date the highest id. Documents without an instrument's name or a date have no version."""
    numbers, letters = key_of(F.col("title"))
    rows = documents.select("document_id", numbers.alias("numbers"), letters.alias("letters"), F.unix_date("effective_from").cast("long").alias("since")).where("numbers IS NOT NULL AND since IS NOT NULL")
    per = rows.groupBy("numbers", "letters", "since").agg(F.max("document_id").alias("document_id"))
    return per.withColumn("version", F.row_number().over(Window.partitionBy("numbers", "letters").orderBy("since")))


def matched(wanted: DataFrame, known: DataFrame) -> DataFrame:
    """wanted and known keys (numbers, letters) -> numbers, letters, found (the letters of the known key), likes (how many are as near), how."""
    key = ["numbers", "letters"]
    wanted, known = wanted.distinct(), known.distinct()
    exact = wanted.join(known, key, "left_semi").select(*key, F.col("letters").alias("found"), F.lit(1).cast("long").alias("likes"), F.lit(EXACT).alias("how"))
    rest = wanted.join(known, key, "left_anti").select(*key, F.explode(shortened(F.col("letters"))).alias("part"))
    parts = known.select(F.col("numbers").alias("n"), F.col("letters").alias("found"), F.explode(shortened(F.col("letters"))).alias("p"))
    near = rest.join(parts, (F.col("numbers") == F.col("n")) & (F.col("part") == F.col("p"))).where(F.levenshtein("letters", "found") <= 1)
    best = near.groupBy(*key).agg(F.min("found").alias("found"), F.count_distinct("found").alias("likes"))
    return exact.unionByName(best.withColumn("how", F.lit(SPELT)))


def resolve(references: DataFrame, documents: DataFrame) -> DataFrame:
    """references (target_citation, cited_on, ...) with target_document_id, version, provenance and reason.

    ``provenance`` says whether the key or a spelling led to the document, ``reason`` why nothing did; one of them is null. What is asked
    for is worked out once for each instrument and day, so one that a third of all references name isn't one task's work. Keys are worked
    out once for each different citation, and written, as filters on them would go below the grouping and read every reference.
    """
    numbers, letters = key_of(F.col("__cited"))
    keys = written(references.select(F.col("target_citation").alias("__cited")).where("__cited IS NOT NULL").distinct().select("__cited", numbers.alias("__n"), letters.alias("__l")), "keys")
    rows = references.join(keys, F.col("target_citation") == F.col("__cited"), "left").withColumn("__day", F.unix_date("cited_on").cast("long"))
    chains = written(versions(documents), "versions")
    asked = written(rows.where("__n IS NOT NULL").select(F.col("__n").alias("numbers"), F.col("__l").alias("letters"), F.col("__day").alias("day")).distinct(), "asked")
    names = matched(asked.select("numbers", "letters"), chains.select("numbers", "letters"))
    looked = asked.join(names, ["numbers", "letters"])
    held = asof_join(looked, chains.withColumnRenamed("letters", "found"), ["numbers", "found"], "day", "since", ["document_id", "version"], 4096)
    told = held.select(F.col("numbers").alias("__rn"), F.col("letters").alias("__rl"), F.col("day").alias("__rd"), "likes", "how", "document_id", F.col("version").alias("__version"))
    on = (F.col("__n") == F.col("__rn")) & (F.col("__l") == F.col("__rl")) & F.col("__day").eqNullSafe(F.col("__rd"))
    out = rows.join(told.withColumnRenamed("document_id", "__document"), on, "left")
    reason = (
        F.when(F.col("__n").isNull(), NOT_NAMED)
        .when(F.col("how").isNull(), UNKNOWN)
        .when(F.col("likes") > 1, SEVERAL)
        .when(F.col("__day").isNull(), NO_DATE)
        .when(F.col("__document").isNull(), NOT_YET)
    )
    found = reason.isNull()
    return out.select(
        *[F.col(f"`{c}`") for c in references.columns if c not in ("target_document_id", "version", "provenance", "reason")],
        F.when(found, F.col("__document")).alias("target_document_id"),
        F.when(found, F.col("__version")).alias("version"),
        F.when(found, F.col("how")).alias("provenance"),
        reason.alias("reason"),
    )
