"""Page text to clauses and references: the small cases."""

import pytest

from clausemill.operators import clauses as K
from clausemill.operators import quality as Q
from clausemill.operators import references as R


def parse(spark, pages):
    df = spark.createDataFrame([(1, p, t) for p, t in pages], "document_id long, page_ordinal int, raw_text string")
    return K.parse_pages(df)


def rows(spark, *pages):
    return [r.asDict() for r in parse(spark, pages).orderBy("ord").collect()]


def cites(spark, *pages):
    return [r["citation"] for r in rows(spark, *pages)]


def test_one_article(spark):
    (r,) = rows(spark, (1, "Điều 1. Phạm vi\nNội dung"))
    assert (r["kind"], r["number"], r["page_start"], r["page_end"], r["body"], r["ord"]) == ("dieu", "1", 1, 1, "Phạm vi\nNội dung", 1)


def test_no_headers_and_no_pages(spark):
    assert rows(spark, (1, "văn xuôi")) == []
    assert rows(spark, (1, "")) == []


def test_nesting_and_reset(spark):
    got = cites(spark, (1, "Điều 1. x\n  Khoản 1. y\n    a) z\nĐiều 2. x\n    b) z\nKhoản 1: y\n  Điểm c. w"))
    assert got == ["Điều 1", "Khoản 1 Điều 1", "Điểm a Khoản 1 Điều 1", "Điều 2", "Điểm b Điều 2", "Khoản 1 Điều 2", "Điểm c Khoản 1 Điều 2"]


def test_orphans_are_named_after_none(spark):
    got = rows(spark, (1, "Khoản 1. x\n  a) y"))
    assert [r["citation"] for r in got] == ["Khoản 1 Điều None", "Điểm a Khoản 1 Điều None"]


def test_spans_over_pages_in_any_order(spark):
    got = rows(spark, (3, "tail"), (2, "more\nĐiều 2. b"), (1, "Điều 1. a"))
    assert [(r["page_start"], r["page_end"]) for r in got] == [(1, 2), (2, 3)]


def test_blank_page_does_not_count(spark):
    (r,) = rows(spark, (1, "Điều 1. a"), (2, " \n\t"))
    assert r["page_end"] == 1


@pytest.mark.parametrize("text,number", [("Điều １.", "1"), ("Điều １２.", "12"), ("  Điều 7 -", "7")])
def test_digits(spark, text, number):
    assert rows(spark, (1, text))[0]["number"] == number


@pytest.mark.parametrize("text", ["a) at the margin", "1. a bare number", "theo Điều 5. giữa dòng", "Điều khoản 1."])
def test_not_headers(spark, text):
    assert rows(spark, (1, text)) == []


def test_last_wins_under_the_first_id(spark):
    parsed = parse(spark, [(1, "Điều 1. một\nĐiều 2. hai\nĐiều 1. ba")])
    got = {r["citation"]: r for r in K.stored(parsed).collect()}
    assert got["Điều 1"]["body"] == "ba" and got["Điều 1"]["clause_id"] == (1 << 24) + 1 and len(got) == 2


def test_parents(spark):
    got = {r["citation"]: r for r in K.stored(parse(spark, [(1, "Điều 3. x\nKhoản 2. y\n a) z")])).collect()}
    assert got["Điểm a Khoản 2 Điều 3"]["parent_id"] == got["Khoản 2 Điều 3"]["clause_id"]
    assert got["Khoản 2 Điều 3"]["parent_id"] == got["Điều 3"]["clause_id"] and got["Điều 3"]["parent_id"] is None


def refs(spark, body, **options):
    parsed = parse(spark, [(1, f"Điều 3. {body}")])
    return [(r["target_citation"], r["kind"]) for r in R.extract(parsed, **options).orderBy("place").collect()]


def targets(spark, body, **options):
    return {t for t, _ in refs(spark, body, **options)}


@pytest.mark.parametrize(
    "body,want",
    [
        ("theo Điều 5 của", {"Điều 5"}),
        ("khoản 2 Điều 3 của", {"Khoản 2 Điều 3", "Điều 3"}),
        ("khoản 2 Điều này", {"Khoản 2 Điều này"}),
        ("điểm a khoản 2 Điều 10 của", {"Điểm a Khoản 2 Điều 10", "Khoản 2 Điều 10", "Điều 10"}),
        ("điểm b khoản 1 Điều này", {"Điểm b Khoản 1 Điều này", "Khoản 1 Điều này"}),
        ("điểm a Điều 7 của", {"Điểm a Điều 7", "Điều 7"}),
        ("Thông tư số 39/2014/TT-BTC", {"Thông tư số 39/2014/TT-BTC"}),
        ("Luật số ３8/2019", {"Luật số 38/2019"}),
        ("các điều khoản khác", set()),
        ("khoản 2 Điều 12.", {"Khoản 2 Điều 1", "Điều 12"}),
        ("khoản 2 Điều 3.", {"Điều 3"}),
        ("aĐiều 5", set()),
    ],
)
def test_targets(spark, body, want):
    assert targets(spark, body) == want


def test_strict_digits(spark):
    assert targets(spark, "khoản 2 Điều 12.", strict_digits=True) == {"Điều 12"}


def test_repeated_reference_counts_once(spark):
    assert refs(spark, "theo Điều 5 và Điều 5 và điều 5") == [("Điều 5", "internal")]


def test_resolution(spark):
    text = "Điều 1. theo Điều 2 và khoản 1 Điều này và Nghị định số 1/2020/NĐ-CP và Điều 9\nKhoản 1. x\nĐiều 2. y"
    parsed = parse(spark, [(1, text)])
    got = {r["target_citation"]: r for r in R.resolve(R.extract(parsed), K.stored(parsed)).collect()}
    assert got["Điều 2"]["kind"] == "internal" and got["Khoản 1 Điều 1"]["dst_clause_id"] is not None
    assert got["Điều 9"]["dst_clause_id"] is None and got["Nghị định số 1/2020/NĐ-CP"]["kind"] == "external"


def check(spark, text):
    df = spark.createDataFrame([(1, 1, text)], "document_id long, page_ordinal int, raw_text string")
    parsed = K.parse_pages(df)
    kept = K.stored(parsed)
    documents = spark.createDataFrame([(1,)], "document_id long")
    found = Q.check(documents, kept, R.resolve(R.extract(parsed), kept), K.lines_of(df))
    return Q.report(documents, found).first(), [r["rule"] for r in found.collect()]


def test_gap_is_a_note(spark):
    report, rules = check(spark, "Điều 1. a\nĐiều 3. b")
    assert report["ok"] and rules == ["numbering"]


def test_a_large_number_is_one_gap(spark):
    df = spark.createDataFrame([(1, 1, "Điều 2. a\nĐiều 2147483647. b\nĐiều 5. c\nĐiều 99999999999999. d\nĐiều 3. e")], "document_id long, page_ordinal int, raw_text string")
    got = Q.numbering_gaps(K.stored(K.parse_pages(df))).orderBy("first_missing").collect()
    assert [(r["first_missing"], r["last_missing"], r["before_ord"], r["after_ord"]) for r in got] == [(4, 4, 5, 2), (6, 2147483646, 5, 2)]
    assert check(spark, "Điều 1. a\nĐiều 3. b\nĐiều 9. c")[1] == ["numbering"]


def test_gap_at_a_chapter_is_silent(spark):
    report, rules = check(spark, "Điều 13. a\nChương III\nĐiều 17. b")
    assert report["ok"] and rules == []


def test_empty_body_and_no_clauses(spark):
    assert not check(spark, "Điều 1. ")[0]["ok"]
    assert check(spark, "văn xuôi")[1] == ["has_clauses"]
