"""python -m clausemill [register, list, pages, ocr, ocr-import, structure, invariants, cards, embed, retrieve]."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import clauses as K
from .operators import quality as Q
from .operators import references as R
from .operators import retrieve as H
from .operators import stages
from .operators import vectors as V
from .schemas import DEFAULT_DIM, DEFAULT_DPI
from .sources import artifacts, markup, ocr, rasterise
from .sources.store import Store
from .streaming.ingest import structure


DEMO = "first-try.pdf"


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="clausemill")
    p.add_argument("--db", default=".clausemill", help="root folder of the tables")
    sub = p.add_subparsers(dest="command")
    add = sub.add_parser("register")
    add.add_argument("path")
    add.add_argument("--title")
    sub.add_parser("list")
    add = sub.add_parser("pages")
    add.add_argument("pdf")
    add.add_argument("--out", default=".clausemill/pages")
    add.add_argument("--dpi", type=int, default=DEFAULT_DPI)
    add.add_argument("--title")
    add = sub.add_parser("ocr")
    add.add_argument("document", type=int)
    add.add_argument("--backend", choices=("stub", "http"), default="stub")
    add = sub.add_parser("ocr-import")
    add.add_argument("document", type=int)
    add.add_argument("file")
    for name in ("structure", "cards", "embed", "invariants"):
        add = sub.add_parser(name)
        add.add_argument("document", type=int)
        if name != "invariants":
            add.add_argument("--rebuild", action="store_true")
        if name in ("structure", "cards"):
            add.add_argument("--out", help="folder for the JSON artifact")
        if name == "embed":
            add.add_argument("--dim", type=int, default=DEFAULT_DIM)
    add = sub.add_parser("retrieve")
    add.add_argument("text")
    add.add_argument("--k", type=int, default=10)
    add.add_argument("--topic")
    add.add_argument("--actor")
    add.add_argument("--dim", type=int, default=DEFAULT_DIM)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """0, or 1 where something failed in the stage, or 2 where the document isn't known or the input is unusable."""
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("clausemill").getOrCreate()
    books = Store(spark, a.db)
    say = lambda row: print(json.dumps(row.asDict(recursive=True), ensure_ascii=False, default=str))
    if getattr(a, "document", None) is not None and books.by("documents", document_id=a.document).isEmpty():
        print(f"no document {a.document}", file=sys.stderr)
        return 2
    if a.command is None:  # a first try: a document of its own, and how many there are
        books.insert(spark.createDataFrame([(DEMO, None)], "source_path string, title string"))
        print(f"inserted doc_id={books.by('documents', source_path=DEMO).first()['document_id']}; total docs={books.read('documents').count()}")
        return 0
    if a.command == "list":
        for row in books.read("documents").orderBy("document_id").toLocalIterator():
            say(row)
        return 0
    if a.command in ("register", "pages"):
        path = a.path if a.command == "register" else a.pdf
        books.register(spark.createDataFrame([(path, a.title)], "source_path string, title string"))
        known = books.by("documents", source_path=path)
        if a.command == "pages":
            pdfs = known.join(spark.read.format("binaryFile").load(path).select("content"), F.lit(True)).select("document_id", "content")
            print(rasterise.pages_stage(books, pdfs, a.out, a.dpi, files="://" not in a.out))
        else:
            say(known.first())
        return 0
    if a.command == "ocr":
        backend = ocr.StubBackend() if a.backend == "stub" else ocr.default_backend()
        made = ocr.transcribe(books.by("pages", document_id=a.document), backend, books.read("checkpoints"))
        kept = books.save_pages(made.where("status = 'done'").drop("status", "error"))
        mine = books.by("pages", document_id=a.document).select("document_id", "page_ordinal").join(kept.select("document_id", "page_ordinal", F.lit("done").alias("s")), ["document_id", "page_ordinal"], "left")
        books.mark(mine.select("document_id", F.col("page_ordinal").cast("long").alias("unit_id"), F.coalesce("s", F.lit("failed")).alias("status")), "ocr")
        print(books.by("ocr_pages", document_id=a.document).count())
        return 0
    if a.command == "ocr-import":
        registered = books.by("pages", document_id=a.document).select("document_id", "page_ordinal", "image_path")
        if registered.isEmpty():
            print("the document has no registered pages", file=sys.stderr)
            return 2
        files = markup.read_files(spark, a.file).select(F.lit(a.document).cast("long").alias("document_id"), "value")
        try:
            made = markup.import_pages(registered, files, books.read("checkpoints").where("stage = 'ocr' AND status = 'done'").withColumnRenamed("unit_id", "page_ordinal"))
            books.save_pages(made)
        except Exception as e:
            if "no page markers" not in str(e):
                raise
            print("the file has no page markers", file=sys.stderr)
            return 2
        books.mark(registered.select("document_id", F.col("page_ordinal").cast("long").alias("unit_id"), F.lit("done").alias("status")), "ocr")
        print(books.by("ocr_pages", document_id=a.document).count())
        return 0
    if a.command == "structure":
        pages = books.by("ocr_pages", document_id=a.document)
        structure(books, pages, a.rebuild)
        parsed, kept = K.parse_pages(pages), books.by("clauses", document_id=a.document)
        refs = books.read("clause_references").where(F.shiftright("src_clause_id", 24) == a.document).withColumn("document_id", F.lit(a.document).cast("long"))
        numbered = pages.withColumn("page", F.col("page_ordinal"))
        for row in R.summary(numbered, parsed, R.extract(parsed), refs).collect():
            say(row)
        if a.out and not pages.isEmpty():
            artifacts.write(artifacts.clause_graphs(numbered, parsed, kept), f"{a.out}/structure/doc{a.document}", "clauses.json")
        return 0
    if a.command == "invariants":
        documents, kept = books.by("documents", document_id=a.document), books.by("clauses", document_id=a.document)
        found = Q.check(documents, kept, books.read("clause_references").withColumn("document_id", F.lit(a.document)), K.lines_of(books.by("ocr_pages", document_id=a.document)))
        for row in found.collect():
            say(row)
        return 0 if Q.report(documents, found).first()["ok"] else 1
    if a.command == "cards":
        row = stages.run_cards(books, a.document, a.rebuild)
        say(row)
        if a.out:
            mine = books.read("rule_cards").where(F.col("document_id") == a.document)
            artifacts.write(artifacts.card_files(books.by("documents", document_id=a.document), mine), f"{a.out}/cards/doc{a.document}", "cards.json")
        return 0 if row["ok"] else 1
    if a.command == "embed":
        row = stages.run_embed(books, V.default_encoder(a.dim), a.document, a.rebuild)
        say(row)
        return 0 if row["ok"] else 1
    wanted = [float(x) for x in V.default_encoder(a.dim).encode(a.text)]
    for row in H.retrieve(books.read("rule_cards"), wanted, a.k, topic=a.topic, actor=a.actor).collect():
        say(row)
    return 0
