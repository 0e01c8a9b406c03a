"""Pages that arrive in any order end in the clauses of whole documents, and touch no more than the articles they lie in."""

import os
import random

from clausemill.operators import clauses as K
from clausemill.schemas import OCR_PAGES
from clausemill.streaming import articles

LINES = ["Điều {n}. Mức", "Khoản 1. Khai", "    a) Nộp", "chữ", "", "Khoản 2. Hết", "Chương II", "    b) Sau"]


def deliver(spark, path, pages, at=None):
    """One file of page records, a list of (document, page, text)."""
    before = set(os.listdir(path)) if os.path.exists(path) else set()
    rows = [(d, p, None, None, t) for d, p, t in pages]
    spark.createDataFrame(rows, OCR_PAGES).coalesce(1).write.mode("append").json(str(path))
    if at is not None:
        for name in set(os.listdir(path)) - before:
            os.utime(f"{path}/{name}", (at, at))


def whole(spark, pages):
    rows = spark.createDataFrame(pages, "document_id long, page_ordinal int, raw_text string")
    return sorted(map(tuple, K.parse_pages(rows).collect()), key=repr)


def now(spark, out):
    return sorted(map(tuple, articles.current(spark, out).collect()), key=repr)


def test_any_order_ends_like_the_whole(spark, tmp_path):
    """Random documents in random order over three runs, pages of some delivered again with other text."""
    r = random.Random(2)
    made = {}
    for d in (1, 2, 3):
        for p in range(1, 9):
            made[d, p] = "\n".join(r.choice(LINES).format(n=r.randint(1, 20)) for _ in range(r.randint(1, 5))) if r.random() > 0.1 else ""
    first = {k: "\n".join(r.choice(LINES).format(n=9) for _ in range(3)) for k in r.sample(sorted(made), 6)}
    order = [(*k, t) for k, t in first.items()] + [(*k, t) for k, t in r.sample(sorted(made.items()), len(made))]
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    for lo, hi in ((0, 6), (6, 15), (15, len(order))):
        deliver(spark, path, order[lo:hi])
        articles.ingest(spark, path, out)
    assert now(spark, out) == whole(spark, [(*k, t) for k, t in made.items()])


def test_only_touched_articles_are_written(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    pages = [(1, p, f"Điều {p}. Mức\nKhoản 1. Khai") for p in (1, 2, 3, 5, 6)]
    deliver(spark, path, [*pages, (None, 1, "Điều 1. x"), (2, None, "Điều 1. x"), (3, 1, None)])
    articles.ingest(spark, path, out)
    late = (1, 4, "đuôi\nĐiều 4. Sau")
    deliver(spark, path, [late, pages[0]])  # a page that comes again as it was touches nothing
    articles.ingest(spark, path, out)
    wrote = articles.batches(spark, out).where("batch = 1 AND ord = 0").collect()
    assert sorted((r["document_id"], r["article_page"], r["article_line"]) for r in wrote) == [(1, 3, 0), (1, 4, 1)]
    assert now(spark, out) == whole(spark, [*pages, late])
    # Nothing new: nothing done; an article that goes takes its clauses along, and what follows falls to the one before.
    articles.ingest(spark, path, out)
    deliver(spark, path, [(1, 5, "Khoản 7. Rest")])
    articles.ingest(spark, path, out)
    assert now(spark, out) == whole(spark, [*[p for p in pages if p[1] != 5], late, (1, 5, "Khoản 7. Rest")])
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "unset") != articles._ROCKS


def test_pages_that_lack_are_waited_for(spark, tmp_path):
    """An article over a gap is held back: until the page comes, or until the time is over."""
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    run = lambda: articles.ingest(spark, path, out, wait_seconds=60)
    said = lambda: {(r["document_id"], r["citation"]) for r in articles.current(spark, out).collect()}
    deliver(spark, path, [(1, 1, "Điều 1. a"), (1, 3, "c\nĐiều 2. d"), (2, 1, "Điều 1. a"), (2, 3, "c\nĐiều 2. d")], at=1_000_000)
    run()
    assert said() == {(1, "Điều 2"), (2, "Điều 2")}
    deliver(spark, path, [(1, 2, "b")], at=1_000_030)
    run()
    assert said() == {(1, "Điều 1"), (1, "Điều 2"), (2, "Điều 2")}
    deliver(spark, path, [(9, 1, "Điều 9. x")], at=1_000_200)
    run()
    assert said() == {(1, "Điều 1"), (1, "Điều 2"), (2, "Điều 1"), (2, "Điều 2"), (9, "Điều 9")}


class Kept:
    """A state of one key in memory, which counts the calls."""

    def __init__(self, calls):
        self.calls, self.value, self.map = calls, None, {}

    def exists(self):
        self.calls.append("exists")
        return self.value is not None

    def get(self):
        self.calls.append("get")
        return self.value

    def update(self, value):
        self.calls.append("update")
        self.value = value

    def getValue(self, key):
        self.calls.append("getValue")
        return self.map.get(key)

    def updateValue(self, key, value):
        self.calls.append("updateValue")
        self.map[key] = value


def test_a_short_document_takes_two_calls_to_the_state(monkeypatch):
    r = random.Random(4)
    text = lambda: "\n".join(r.choice(LINES).format(n=r.randint(1, 9)) for _ in range(4))
    heads = lambda t: [i for i, line in enumerate(t.split("\n")) if line.startswith("Điều")]
    given = [[(p, text()) for p in r.sample(range(1, 9), 5)] for _ in range(6)]
    got, calls = [], []
    for near in (articles.NEAR, 0, 60):  # where texts lie makes no difference
        monkeypatch.setattr(articles, "NEAR", near)
        calls.append([])
        one = articles.Articles()
        one.texts, one.index = Kept(calls[-1]), Kept(calls[-1])
        rows = [{"page": p, "text": t, "heads": heads(t), "arrived": None} for batch in given for p, t in batch]
        got.append([[tuple(x) for x in one.handleInputRows((7,), iter(rows[k : k + 5]), None)] for k in range(0, len(rows), 5)])
    assert got[0] == got[1] == got[2] and len(got[0][0]) > 0
    assert calls[0] == ["get", "update"] * len(given)
