"""Corrections of stretches against plain string work."""

import random

from pyspark.sql import functions as F

from clausemill.operators import asof, clauses, patches

PAGES = "document_id long, page_ordinal int, raw_text string, moves string"
PATCHES = "document_id long, page_ordinal int, seq int, start int, end int, text string"


def resolve(text, rows):
    """The patches that count, by plain rules."""
    fits = sorted({(q, s, e, t or "") for q, s, e, t in rows if 0 <= s <= e <= len(text)}, reverse=True)
    kept = []
    for _, s, e, t in fits:
        if all((e <= a or b <= s) and (s, e) != (a, b) for a, b, _ in kept):
            kept.append((s, e, t))
    return sorted(kept)


def applied(text, kept):
    out, at = "", 0
    for s, e, t in kept:
        out += text[at:s] + t
        at = e
    return out + text[at:]


def test_random_patches(spark):
    """Texts, and marks in them: a character that no patch touches is found again at its moved place."""
    rng = random.Random(4)
    pages, rows, want = [], [], {}
    for p in range(60):
        text = "".join(rng.choice("abcđ😀 \n") for _ in range(rng.randint(0, 40)))
        mine = []
        for q in range(rng.randint(0, 6)):
            s = rng.randint(-1, 42)
            mine.append((rng.randint(0, 3), s, s + rng.choice([0, 0, 1, 3, 8, -1]), rng.choice(["", "XY", "Z😀", None, "QQQQQ"])))
        pages.append((1, p, text, "m"))
        rows += [(1, p, *m) for m in mine]
        want[p] = (text, resolve(text, mine))
    rows.append((9, 9, 1, 0, 1, "no such page"))
    fixed = patches.corrected(spark.createDataFrame(pages, PAGES), spark.createDataFrame(rows, PATCHES))
    got = {r["page_ordinal"]: r for r in fixed.collect()}
    assert {p: r["raw_text"] for p, r in got.items()} == {p: applied(*w) for p, w in want.items()}
    assert {p: [(m["start"], m["end"], m["text"]) for m in r["moves"]] for p, r in got.items()} == {p: k for p, (_, k) in want.items()}
    spans = spark.createDataFrame([(1, p, i, i + 1) for p, (t, _) in want.items() for i in range(len(t))], "document_id long, page_ordinal int, start int, end int").withColumn("was", F.col("start"))
    seen = 0
    for r in patches.moved_spans(spans, fixed).collect():
        text, kept = want[r["page_ordinal"]]
        touched = any(s < r["was"] + 1 and e > r["was"] for s, e, _ in kept)
        assert r["touched"] == touched and 0 <= r["start"] <= r["end"] <= len(got[r["page_ordinal"]]["raw_text"])
        if not touched:
            seen += 1
            assert got[r["page_ordinal"]]["raw_text"][r["start"] : r["end"]] == text[r["was"]]
    assert seen > 300


def test_patched_then_parsed_equals_moved(spark):
    """Headers of the corrected text are where those of the text before moved to."""
    text = "Điều 1. Một\nchữ sai\nKhoản 1. hai\n    a) ba\nĐiều 2. Bốn"
    pages = spark.createDataFrame([(1, 1, text, None)], PAGES)
    rows = [(1, 1, 1, text.index("sai"), text.index("sai") + 3, "đúng rồi"), (1, 1, 2, text.index("hai"), text.index("hai"), "mười "), (1, 1, 3, text.index("ba"), text.index("ba") + 2, "")]
    fixed = patches.corrected(pages, spark.createDataFrame(rows, PATCHES))
    heads = lambda df: asof.header_offsets(clauses.lines_of(df)).withColumnsRenamed({"line_page": "page_ordinal", "offset": "start"}).withColumn("end", F.col("start"))
    old = heads(pages)
    want = sorted((r["kind"], r["start"]) for r in heads(fixed).collect())
    assert sorted((r["kind"], r["start"]) for r in patches.moved_spans(old, fixed).collect()) == want and len(want) == 4
    assert patches.corrected(pages, spark.createDataFrame([], PATCHES)).first()["raw_text"] == text
    assert patches.corrected(pages.limit(0), spark.createDataFrame(rows, PATCHES)).count() == 0
