"""Steps that all plans over clauses share: what they give by cheaper ways is what the patterns give."""

import re

from pyspark.sql import functions as F

from clausemill.functions import text as X
from clausemill.operators import clauses as K
from clausemill.operators import references as R
from clausemill.plans.corpus import lines

LINES = [
    "Điều 1. x", " \tĐiều  ２３ : y", "Khoản 7) z", "  a) point", "\tĐiểm b. p", "a) none", "Điều x", " Khoản 1 none", " Điều 5. none", "", None, "  ", "Điều 12.", "    đ )x \n y", "Điều1. none",
]
BLANKS = ["", None, " \t\r\n", " ", "　 a b \x85\n", "\x1c x ", "​x​", "a \n", "\v"]


def test_headers_by_how_a_line_begins(spark):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(LINES)], "i int, line string")
    kind = F.when(F.rlike("line", F.lit(X.DIEU)), "dieu").when(F.rlike("line", F.lit(X.KHOAN)), "khoan").when(F.rlike("line", F.lit(X.DIEM)), "diem")
    rest = F.coalesce(*[F.when(F.col("want") == k, F.regexp_replace("line", p, "")) for k, p in (("dieu", X.DIEU), ("khoan", X.KHOAN), ("diem", X.DIEM))], "line")
    got = rows.withColumn("want", kind).withColumn("got", X.header_kind(F.col("line"))).withColumn("rest", rest).withColumn("after", X.after_header(F.col("line"), F.col("got"))).collect()
    assert [(r["want"], r["rest"]) for r in got] == [(r["got"], r["after"]) for r in got]
    assert [r["got"] for r in got].count("dieu") == 3


def test_stripped_without_patterns(spark):
    rows = spark.createDataFrame([(x,) for x in BLANKS + LINES], "s string")
    plain = F.regexp_replace(F.regexp_replace("s", f"^{X.WS}+", ""), f"{X.WS}+$", "")
    got = rows.select(plain.alias("a"), X.strip(F.col("s")).alias("b"), (F.length(F.regexp_replace("s", r"[ \t\r\n]+", "")) > 0).alias("c"), X.has_content(F.col("s")).alias("d")).collect()
    assert all(r["a"] == r["b"] and r["c"] == r["d"] for r in got)
    every = "".join(chr(c) for c in range(0x3100) if re.match(r"\s", chr(c)) or c in (0x85, 0x1C))
    assert spark.range(1).select(X.strip(F.lit(every + "x" + every)).alias("s")).first()["s"] == "x"


def test_article_after_a_letter_is_no_reference(spark):
    body = "xĐiều 3, Điều 4 và điều 4; ađiều 5 Điều 4"
    rows = spark.createDataFrame([(1, 1, "Điều 1", "1", body)], "document_id long, ord int, citation string, dieu string, body string")
    got = [(r["raw_text"], r["target_citation"]) for r in R.extract(rows).orderBy("place").collect()]
    assert got == [("Điều 4", "Điều 4")]


def test_references_are_worked_out_once_and_kept_without_texts(spark, sf_dir):
    parsed = K.parse_lines(lines(spark, sf_dir))
    short = R.found(parsed)
    assert "body" not in short.columns and "body" not in K.stored(short).columns
    key = ["document_id", "ord", "place", "kind", "raw_text", "target_citation"]
    a, b = R.extract(parsed).select(*key), R.extract(short).select(*key)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and not a.isEmpty()
    # A filter on the array would work every pattern out again: one scan of each stands in the plan.
    plan = R.extract(parsed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == len(X.reference_patterns())
