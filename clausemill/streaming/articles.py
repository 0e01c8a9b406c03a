"""Pages in any order of arrival become clauses article by article: a late page is read with the article before it, not with its document.

A document's pages and the places of its articles are state (``transformWithState``). What a clause is depends on the lines of its
article alone, so a page that comes, or comes again with other text, touches the article that is open where it begins and those that
begin on it. Only these are read again, by the plan that reads whole documents, and only they are written.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions import text as X
from ..operators import clauses as K
from ..sources.scratch import held
from .ingest import page_stream

#: Of which article: the page and line of its header; both null for what stands before a document's first article.
ARTICLE = ["document_id", "article_page", "article_line"]
REGIONS = "document_id long, article_page int, article_line int, page int, first_line int, text string"
CLAUSES = "document_id long, article_page int, article_line int, batch long, ord int, kind string, number string, citation string, dieu string, khoan string, page_start int, page_end int, body string"
_INDEX = "pages array<int>, head_pages array<int>, head_lines array<int>, held_pages array<int>, held_lines array<int>, held_until array<bigint>, texts array<string>"
#: Characters of a document's texts that lie with its index, so that a call to the state brings them all; others lie by page.
NEAR = 16_384
_BEFORE = (-(1 << 31), 0)
_REGION = Row("document_id", "article_page", "article_line", "page", "first_line", "text")
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_heads(pages: DataFrame) -> DataFrame:
    """Pages with the numbers of their lines that begin an article; what has no document or no place goes, null text is empty."""
    text = F.coalesce("raw_text", F.lit(""))
    heads = F.transform(F.split(text, "\n", -1), lambda line, i: F.when(X.header_kind(line) == "dieu", i))
    places = F.filter(heads, lambda i: i.isNotNull())
    return pages.where("document_id IS NOT NULL AND page_ordinal IS NOT NULL").select("document_id", F.col("page_ordinal").cast("int").alias("page"), text.alias("text"), places.alias("heads"), "arrived")


class Articles(StatefulProcessor):
    """A document's pages -> the lines of each article that they touch; an article that is no more gives a row without text.

    The list of pages and article places is one small value of a document, some bytes a page; up to ``NEAR`` characters of its
    texts lie in it, the others in the state one by one. ``wait`` (ms) holds an article back while one of its pages is missing, until it comes or the watermark passes
    arrival + wait; what a document lacks before its first article counts from page 1.
    """

    def __init__(self, wait: int | None = None):
        self.wait = wait

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.texts = handle.getMapState("texts", "page int", "text string")
        self.index = handle.getValueState("index", _INDEX)

    def _load(self) -> tuple[list, list, dict, dict]:
        pages, head_pages, head_lines, held_pages, held_lines, until, texts = self.index.get() or ([],) * 7
        near = {p: t for p, t in zip(pages, texts) if t is not None}
        return list(pages), list(zip(head_pages, head_lines)), dict(zip(zip(held_pages, held_lines), until)), near

    def _keep(self, pages: list, heads: list, waits: dict, near: dict) -> None:
        places = sorted(waits)
        self.index.update((pages, [p for p, _ in heads], [n for _, n in heads], [p for p, _ in places], [n for _, n in places], [waits[k] for k in places], [near.get(p) for p in pages]))

    def _text(self, page: int, near: dict) -> str:
        return near[page] if page in near else self.texts.getValue((page,))[0]

    def _range(self, place: tuple, pages: list, heads: list) -> tuple[list, tuple | None]:
        """The pages that an article has lines on, and the article after it."""
        k = bisect_right(heads, place)
        after = heads[k] if k < len(heads) else None
        return pages[bisect_left(pages, place[0]) : bisect_right(pages, after[0]) if after else len(pages)], after

    def _lacks(self, place: tuple, pages: list, heads: list) -> bool:
        mine, _ = self._range(place, pages, heads)
        first = 1 if place == _BEFORE else place[0]
        return bool(mine) and (mine[0] > first or mine[-1] - mine[0] + 1 != len(mine))

    def _lines(self, document: int, place: tuple, pages: list, heads: list, at_hand: dict) -> Iterator[Row]:
        """at_hand: texts by page; the others' come from the state."""
        mine, after = self._range(place, pages, heads)
        at = (None, None) if place == _BEFORE else place
        none = True
        for page in mine:
            lines = self._text(page, at_hand).split("\n")
            lo, hi = place[1] if page == place[0] else 0, after[1] if after and page == after[0] else len(lines)
            if lo < hi:
                none = False
                yield _REGION(document, *at, page, lo, "\n".join(lines[lo:hi]))
        if none:
            yield _REGION(document, *at, None, None, None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        (document,) = key
        pages, heads, waits, near = self._load()
        new: dict[int, tuple[str, list]] = {}
        arrived = 0
        for r in rows:
            arrived = max(arrived, int(r["arrived"].timestamp() * 1000) if r["arrived"] else 0)
            if r["page"] not in new or r["text"] > new[r["page"]][0]:  # of a page that a batch has twice, the greatest text counts
                new[r["page"]] = (r["text"], list(r["heads"]))
        have = set(pages)
        new = {p: said for p, said in new.items() if p not in have or self._text(p, near) != said[0]}
        if not new:
            return
        near = {p: text for p, text in near.items() if p not in new}
        room = NEAR - sum(map(len, near.values()))
        for p, (text, _) in new.items():
            if len(text) <= room:
                near[p], room = text, room - len(text)
            else:
                self.texts.updateValue((p,), (text,))
        at_hand = near | {p: text for p, (text, _) in new.items()}
        gone = {h for h in heads if h[0] in new}
        heads = sorted([h for h in heads if h[0] not in new] + [(p, n) for p, (_, ns) in new.items() for n in ns])
        pages = sorted(have | set(new))
        touched = set(waits)
        for p in new:
            k = bisect_left(heads, (p, 0))
            touched.add(heads[k - 1] if k else _BEFORE)
            touched.update((p, n) for n in new[p][1])
        stand = {*heads, _BEFORE}
        gone = (gone | touched) - stand
        waiting = {}
        for place in sorted(touched & stand):
            if self.wait is not None and self._lacks(place, pages, heads):
                waiting[place] = waits.get(place, arrived + self.wait)
                self.handle.registerTimer(waiting[place])
            else:
                yield from self._lines(document, place, pages, heads, at_hand)
        for place in sorted(gone):
            yield _REGION(document, *place, None, None, None)
        self._keep(pages, heads, waiting, near)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        (document,) = key
        pages, heads, waits, near = self._load()
        over = {place for place, until in waits.items() if until <= expiredTimerInfo.getExpiryTimeInMs()}
        for place in sorted(over):
            yield from self._lines(document, place, pages, heads, near)
        self._keep(pages, heads, {place: until for place, until in waits.items() if place not in over}, near)

    def close(self) -> None:
        pass


def parsed(regions: DataFrame) -> DataFrame:
    """Lines of articles -> their clauses, and for each article a row of ord 0, which is all that one without clauses has."""
    article = F.struct(*ARTICLE).alias("document_id")
    lines = regions.where("text IS NOT NULL").select(article, "page", "first_line", F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    read = K.parse_lines(lines.select("document_id", "page", (F.col("first_line") + F.col("at")).alias("line_no"), "line"))
    read = read.select(*[F.col(f"document_id.{c}").alias(c) for c in ARTICLE], *[c for c in read.columns if c != "document_id"])
    marks = regions.select(*ARTICLE).distinct().withColumn("ord", F.lit(0))
    return read.unionByName(marks, allowMissingColumns=True)


def ingest(spark: SparkSession, path: str, out: str, files_per_batch: int = 1000, wait_seconds: int | None = None) -> StreamingQuery:
    """Takes the page records that are new under ``path`` to their end; clauses by batch go to ``out``/clauses, the checkpoint beside them.

    A batch replaces its own folder, so one that is done again writes the same. Arrival is the time of a record's file.
    """
    pages = page_stream(spark, path, files_per_batch).withColumn("arrived", F.col("_metadata.file_modification_time"))
    wait = None if wait_seconds is None else 1000 * wait_seconds
    pages = pages if wait is None else pages.withWatermark("arrived", "0 seconds")
    regions = with_heads(pages).groupBy("document_id").transformWithState(Articles(wait), REGIONS, "Update", "None" if wait is None else "EventTime")

    def batch(rows: DataFrame, number: int) -> None:
        # The state moves on when rows are made, so they are made once.
        with held(rows) as kept:
            parsed(kept).write.mode("overwrite").parquet(f"{out}/clauses/batch={number}")

    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, _ROCKS)
    try:
        query = regions.writeStream.foreachBatch(batch).outputMode("update").option("checkpointLocation", f"{out}/_checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)
    return query


def batches(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(CLAUSES).parquet(f"{out}/clauses")


def current(spark: SparkSession, out: str) -> DataFrame:
    """The clauses that hold now, numbered through their documents as if these had been read whole."""
    article, document = Window.partitionBy(*ARTICLE), Window.partitionBy("document_id").orderBy("article_page", "article_line", "ord")
    last = batches(spark, out).withColumn("newest", F.max("batch").over(article)).where("batch = newest AND ord > 0")
    return last.withColumn("ord", F.row_number().over(document)).select("document_id", "ord", "kind", "number", "citation", "dieu", "khoan", "page_start", "page_end", "body")
