"""As-of joins and running sums over ranges against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from clausemill.functions import text as X
from clausemill.operators import asof, clauses


def test_running_sum(spark):
    rng = random.Random(1)
    rows = [(d, k, rng.choice([None, 0, 1, 7, 30])) for d in (1, 2) for k in rng.sample(range(5000), 300)] + [(None, 1, 5)]
    df = spark.createDataFrame(rows, "d long, k long, v long")
    want = {(d, k): sum(v or 0 for e, j, v in rows if e == d and j < k) if d is not None else None for d, k, _ in rows}
    for width in (1, 64, 1 << 20):
        assert {(r["d"], r["k"]): r["before"] for r in asof.running_sum(df, ["d"], "k", "v", "before", width).collect()} == want


@pytest.mark.parametrize("width", [1, 10, 1000])
def test_asof_join(spark, width):
    """Ties, keys without right rows, places before the first, ranges without any, nulls, and columns that clash."""
    rng = random.Random(2)
    right = [(rng.choice("ab"), rng.randrange(200), rng.choice([None, 1, 2]), "r") for _ in range(25)] + [(None, 3, 9, "r"), ("a", None, 9, "r")]
    left = [(rng.choice("abc"), rng.randrange(-5, 260), i, "l") for i in range(150)] + [(None, 3, 900, "l"), ("a", None, 901, "l")]
    df = spark.createDataFrame(left, "k string, at long, i int, __at string")
    other = spark.createDataFrame(right, "k string, since long, v int, w string")

    def last(k, at):
        fit = [(s, (v is not None, v or 0), v, w) for j, s, v, w in right if j is not None and j == k and s is not None and at is not None and s <= at]
        return max(fit)[2:] if fit else (None, None)

    want = sorted(((k, at, i, x, *last(k, at)) for k, at, i, x in left), key=repr)
    out = asof.asof_join(df, other, ["k"], "at", "since", ["v", "w"], width)
    assert out.columns == ["k", "at", "i", "__at", "v", "w"]
    assert sorted(map(tuple, out.collect()), key=repr) == want
    assert asof.asof_join(df, other.limit(0), ["k"], "at", "since", ["v"], width).where("v IS NOT NULL").count() == 0
    assert asof.asof_join(df.limit(0), other, ["k"], "at", "since", ["v"], width).count() == 0


def test_pages_from_offsets_equal_those_from_lines(spark):
    """Also for one document of very many pages, whose pages are dealt over ranges."""
    text = lambda p: [f"Điều {p}. Một", "  chữ 😀", "Khoản 1. hai"][: p % 4]
    pages = spark.createDataFrame([(d, p, "\n".join(text(p))) for d, n in ((1, 3000), (2, 5)) for p in range(1, n + 1)], "document_id long, page_ordinal int, raw_text string")
    lines = clauses.lines_of(pages).withColumn("line_no", (F.col("page") * 10 + F.col("line_no")).cast("long"))
    offsets = asof.header_offsets(lines, 1000)
    found = asof.pages_at(offsets, asof.page_starts(pages, 100), width=500)
    assert found.count() == lines.where(X.header_kind(F.col("line")).isNotNull()).count() > 2000
    assert found.where("page IS DISTINCT FROM line_page").count() == 0
