"""PDF pages as images, by a renderer that can be replaced.

A document of many hundred pages is no single task: its file is cut into parts of a few pages, which is cheap, the parts move once, and
each part is rendered in a task of its own, which is not. A part that fails is rendered again alone. Images are rows of a table, written by
Spark's writer under the document's partition, so executors need no folder in common but the one Spark writes to.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..schemas import DEFAULT_DPI
from . import store
from .scratch import held

PAGES_A_PART = 32
IMAGES = "page_ordinal int, image_path string, width int, height int, dpi int, image binary, document_id long"
#: Rows go back to Spark once they hold so many bytes.
BATCH_BYTES = 8 << 20


class Renderer(Protocol):
    """A file's bytes -> (ordinal from 1, width, height, PNG bytes) of each page; runs inside a task.

    A renderer may also have ``split(content, pages)``, which gives (ordinal of the first page, bytes of a file of its own) of each part of
    so many pages; without it, a document is one part.
    """

    def __call__(self, content: bytes, dpi: int) -> Iterator[tuple[int, int, int, bytes]]: ...


class Mupdf:
    """With an optional package; 72 points an inch."""

    @staticmethod
    def _open(content: bytes):
        try:
            import fitz
        except ImportError as gone:
            raise RuntimeError("rendering PDFs needs the package PyMuPDF, or another renderer") from gone
        return fitz, fitz.open(stream=content, filetype="pdf")

    def split(self, content: bytes, pages: int) -> Iterator[tuple[int, bytes]]:
        fitz, pdf = self._open(content)
        with pdf:
            for first in range(0, pdf.page_count, pages):
                with fitz.open() as part:
                    part.insert_pdf(pdf, from_page=first, to_page=min(first + pages, pdf.page_count) - 1)
                    yield first + 1, part.tobytes()

    def __call__(self, content: bytes, dpi: int) -> Iterator[tuple[int, int, int, bytes]]:
        fitz, pdf = self._open(content)
        with pdf:
            for k, page in enumerate(pdf, 1):
                image = page.get_pixmap(matrix=fitz.Matrix(dpi / 72, dpi / 72), alpha=False)
                yield k, image.width, image.height, image.tobytes("png")


mupdf = Mupdf()


class TextBook:
    """A stand-in for PDFs: plain text, so many lines a page; a page's image is its size and its text."""

    def __init__(self, lines: int = 8):
        self.lines = lines

    def split(self, content: bytes, pages: int) -> Iterator[tuple[int, bytes]]:
        lines = content.split(b"\n")
        for first in range(0, len(lines), self.lines * pages):
            yield first // self.lines + 1, b"\n".join(lines[first : first + self.lines * pages])

    def __call__(self, content: bytes, dpi: int) -> Iterator[tuple[int, int, int, bytes]]:
        lines = content.decode().split("\n")
        for k, first in enumerate(range(0, len(lines), self.lines), 1):
            page = lines[first : first + self.lines]
            width, height = max(map(len, page)) * dpi // 72, len(page) * 12 * dpi // 72
            yield k, width, height, f"{width}x{height}\n{chr(10).join(page)}".encode()


def read_pdfs(spark: SparkSession, documents: DataFrame, path: str) -> DataFrame:
    """documents (document_id, source_path) with the content of their files under ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", True).load(path)
    name = F.regexp_extract("path", "[^/]*$", 0)
    return documents.join(files.select(name.alias("name"), "content"), F.regexp_extract("source_path", "[^/]*$", 0) == F.col("name")).select("document_id", "content")


def parts(pdfs: DataFrame, renderer: Renderer = mupdf, pages: int = PAGES_A_PART) -> DataFrame:
    """pdfs (document_id, content) -> document_id, first (the ordinal of its first page), content: files of so many pages at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for document, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                whole = content.as_py()
                if whole is None:
                    continue
                cut = getattr(renderer, "split", None)
                for first, part in cut(whole, pages) if cut else [(1, whole)]:
                    yield pa.RecordBatch.from_arrays([pa.array([document], pa.int64()), pa.array([first], pa.int32()), pa.array([part], pa.binary())], names=["document_id", "first", "content"])

    return pdfs.select(F.col("document_id").cast("long"), "content").mapInArrow(run, "document_id long, first int, content binary")


def render(pdfs: DataFrame, out_dir: str, dpi: int = DEFAULT_DPI, renderer: Renderer = mupdf, pages: int = PAGES_A_PART) -> DataFrame:
    """pdfs (document_id, content) -> a row for each page with its image. A document without content has no pages."""
    fields = [("document_id", pa.int64()), ("page_ordinal", pa.int32()), ("width", pa.int32()), ("height", pa.int32()), ("image", pa.binary())]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)], names=[n for n, _ in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for b in batches:
            for document, first, content in zip(*[b.column(c) for c in ("document_id", "first", "content")], strict=True):
                for ordinal, width, height, image in renderer(content.as_py(), dpi):
                    rows.append((document.as_py(), first.as_py() + ordinal - 1, width, height, image))
                    size += len(image)
                    if size > BATCH_BYTES:
                        yield batch(rows)
                        rows, size = [], 0
        if rows:
            yield batch(rows)

    # By the parts' keys in as many partitions as there are for shuffles: rendering, not the bytes, is what has to be spread.
    n = int(pdfs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = parts(pdfs, renderer, pages).repartition(n, "document_id", "first")
    made = dealt.mapInArrow(run, "document_id long, page_ordinal int, width int, height int, image binary")
    path = X.page_image_path(F.lit(out_dir), F.col("document_id"), F.col("page_ordinal"))
    return made.select("page_ordinal", path.alias("image_path"), "width", "height", F.lit(dpi).alias("dpi"), "image", "document_id")


def write_images(images: DataFrame, out_dir: str) -> None:
    """Images as a table of partitions by document; a document that is there is replaced whole, others stay."""
    images.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("document_id").parquet(f"{out_dir}/images")


def read_images(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.schema(IMAGES).parquet(f"{out_dir}/images")


def export_files(images: DataFrame) -> None:
    """Every image as a file at its path, written by the tasks; for a folder that all of them see."""

    def write(rows: Iterator) -> None:
        for r in rows:
            os.makedirs(os.path.dirname(r["image_path"]), exist_ok=True)
            with open(r["image_path"], "wb") as f:
                f.write(r["image"])

    images.select("image_path", "image").foreachPartition(write)


def pages_stage(books: store.Store, pdfs: DataFrame, out_dir: str, dpi: int = DEFAULT_DPI, renderer: Renderer = mupdf, pages: int = PAGES_A_PART, files: bool = False) -> int:
    """Documents whose pages aren't done yet: rendered, their images written, registered and marked; how many pages that made.

    With ``files`` the images are files too. A run that ends before the marks is done again and replaces what it had written.
    """
    spark = pdfs.sparkSession
    done = books.read("checkpoints").where("stage = 'pages' AND unit_id = 0")
    todo = store.pending(pdfs.withColumn("unit_id", F.lit(0).cast("long")), done, ["document_id", "unit_id"]).drop("unit_id")
    before = books.read("pages").count()
    with held(todo.select("document_id").distinct()) as ids:
        if ids.isEmpty():
            return 0
        write_images(render(todo, out_dir, dpi, renderer, pages), out_dir)
        images = read_images(spark, out_dir).join(ids, "document_id", "left_semi")
        if files:
            export_files(images)
        with held(images.drop("image")) as made:
            known = books.patch("pages", made, lambda old: store.upsert(old, made, ["document_id", "page_ordinal"], ["dpi"]))
        fresh = known.join(ids, "document_id", "left_semi")
        units = fresh.select("document_id", F.col("page_ordinal").cast("long").alias("unit_id"), F.col("image_path").alias("artifact_path"))
        whole = ids.select("document_id", F.lit(0).cast("long").alias("unit_id"), F.lit(None).cast("string").alias("artifact_path"))
        books.mark(units.union(whole).withColumn("status", F.lit("done")), "pages")
    return books.read("pages").count() - before


# ---- the registered query


def ranges_query(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) as books of 8 lines a page, in parts of 4 pages."""
    books = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("document_id"), F.encode("text", "UTF-8").alias("content"))
    rows = render(books, "out", 144, TextBook(8), 4)
    return rows.select("document_id", "page_ordinal", "image_path", "width", "height", "dpi", F.md5("image").alias("image_md5"))


RANGES_SQL = """
WITH lined AS (SELECT doc_id AS document_id, unnest(s) AS line, unnest(range(0, len(s))) AS n FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL)
), paged AS (
  SELECT document_id, (n // 8 + 1)::INTEGER AS page_ordinal, (max(length(line)) * 144 // 72)::INTEGER AS width, (count(*) * 12 * 144 // 72)::INTEGER AS height, string_agg(line, chr(10) ORDER BY n) AS text FROM lined GROUP BY 1, 2
)
SELECT document_id, page_ordinal, 'out/doc' || document_id || '/page' || lpad(page_ordinal::VARCHAR, greatest(4, length(page_ordinal::VARCHAR))::INTEGER, '0') || '.png' AS image_path, width, height, 144 AS dpi,
       md5(width || 'x' || height || chr(10) || text) AS image_md5
FROM paged
"""
