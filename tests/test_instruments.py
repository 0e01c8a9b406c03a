"""References to instruments: spelling, versions and reasons."""

import datetime as dt

from pyspark.sql import functions as F

from clausemill.operators import instruments as N

DOCS = "document_id long, title string, effective_from date"
REFS = "reference_id int, target_citation string, cited_on date, version string"
DAY = dt.date


def keys(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [tuple(r)[1:] for r in df.select("i", *N.key_of(F.col("t"))).orderBy("i").collect()]


def test_keys(spark):
    same = ("39/2014", "THÔNG TƯ //TT-BTC")
    assert keys(spark, "Thông tư số 39/2014/TT-BTC", "  thông tư  số ０39/2014/tt-btc", "THÔNG TƯ SỐ 39/2014/TT-BTC ngày") == [same] * 3
    assert keys(spark, "Điều 3", None, "Thông tư 39", "Luật số 5") == [(None, None)] * 3 + [("5", "LUẬT ")]


def test_shortened_finds_every_single_edit(spark):
    words = ["abc", "ab", "abcd", "xbc", "acb", "abd", "a", "", "bbc", "abbc"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    rows = df.select("w", F.explode(N.shortened(F.col("w"))).alias("p"))
    other = rows.select(F.col("w").alias("v"), "p")
    met = {(r["w"], r["v"]) for r in rows.join(other, "p").where(F.levenshtein("w", "v") <= 1).select("w", "v").distinct().collect()}

    def near(a, b):
        if a == b:
            return True
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    assert met == {(a, b) for a in words for b in words if near(a, b)}


def test_versions_and_reasons(spark):
    docs = [
        (1, "Thông tư số 39/2014/TT-BTC", DAY(2014, 6, 1)),
        (2, "Thông tư số 39/2014/TT-BTC", DAY(2016, 1, 1)),  # amended
        (3, "Thông tư số 39/2014/TT-BTC", DAY(2016, 1, 1)),  # the same day: the higher id
        (4, "Thông tư số 38/2014/TT-BTC", DAY(2014, 1, 1)),
        (5, "Luật số 7/2010/QH", DAY(2010, 1, 1)),
        (6, "Luật số 7/2010/QB", DAY(2010, 1, 1)),
        (7, "no instrument", DAY(2010, 1, 1)),
        (8, "Luật số 8", None),
    ]
    refs = [
        (1, "Thông tư số 39/2014/TT-BTC", DAY(2015, 1, 1), "x"),
        (2, "thông tư số 039/2014/TT-BTC", DAY(2016, 1, 1), None),
        (3, "Thông tư số 39/2014/TT-BC", DAY(2030, 1, 1), None),  # a letter dropped
        (4, "Thông tư số 39/2014/TT-BTC", DAY(2014, 5, 31), None),
        (5, "Thông tư số 37/2014/TT-BTC", DAY(2020, 1, 1), None),  # another number
        (6, "Luật số 7/2010/QX", DAY(2020, 1, 1), None),
        (7, "Luật số 7/2010/QB", DAY(2020, 1, 1), None),
        (8, "Điều 5", DAY(2020, 1, 1), None),
        (9, None, DAY(2020, 1, 1), None),
        (10, "Luật số 7/2010/QH", None, None),
        (11, "Luật số 8", DAY(2020, 1, 1), None),
        (11, "Luật số 8", DAY(2020, 1, 1), None),
    ]
    out = N.resolve(spark.createDataFrame(refs, REFS), spark.createDataFrame(docs, DOCS))
    assert out.columns == ["reference_id", "target_citation", "cited_on", "target_document_id", "version", "provenance", "reason"]
    got = sorted((r["reference_id"], r["target_document_id"], r["version"], r["provenance"], r["reason"]) for r in out.collect())
    assert got == [
        (1, 1, 1, N.EXACT, None),
        (2, 3, 2, N.EXACT, None),
        (3, 3, 2, N.SPELT, None),
        (4, None, None, None, N.NOT_YET),
        (5, None, None, None, N.UNKNOWN),
        (6, None, None, None, N.SEVERAL),
        (7, 6, 1, N.EXACT, None),
        (8, None, None, None, N.NOT_NAMED),
        (9, None, None, None, N.NOT_NAMED),
        (10, None, None, None, N.NO_DATE),
        (11, None, None, None, N.UNKNOWN),
        (11, None, None, None, N.UNKNOWN),
    ]
    none = N.resolve(spark.createDataFrame(refs, REFS), spark.createDataFrame([], DOCS))
    assert none.count() == len(refs) and none.where("reason IS NULL").count() == 0
    assert N.resolve(spark.createDataFrame([], REFS), spark.createDataFrame(docs, DOCS)).count() == 0


def test_patterns_run_once_for_each_different_citation(spark):
    """What reads the references again has keys from a table, not by patterns; a null citation names nothing."""
    refs = spark.range(600).select(F.col("id").cast("int").alias("reference_id"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("Luật số "), (F.col("id") % 2 + 7).cast("string"))).alias("target_citation"), F.lit(DAY(2020, 1, 1)).alias("cited_on"))
    docs = spark.createDataFrame([(1, "Luật số 7", DAY(2010, 1, 1))], DOCS)
    out = N.resolve(refs, docs)
    assert "regexp_extract" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {(r["target_document_id"], r["reason"]): r["n"] for r in out.groupBy("target_document_id", "reason").agg(F.count("*").alias("n")).collect()}
    assert got == {(1, None): 200, (None, N.UNKNOWN): 200, (None, N.NOT_NAMED): 200}
