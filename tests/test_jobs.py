import json
import logging
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clausemill.operators import clauses
from jobs import _common, clause_feed, rule_catalogue

LAW = "Điều 1. Tổ chức lập hóa đơn; xong\nKhoản 1. theo Điều 2 của Luật\nĐiều 2. Cá nhân bị phạt tiền theo mức 5.\nKhoản 1. xem khoản 1 Điều 1 và Thông tư số 5/2020\nĐiều 5. Khác. Điều 2 và Điều 2 này"
DOCS = "doc_id long, text string, extra string"


def rows_of(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def write(spark, path, rows, mode="append"):
    spark.createDataFrame(rows, DOCS).coalesce(1).write.mode(mode).parquet(path)


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    write(spark, path, [(1, LAW, "x"), (2, "no clause", None), (3, None, None), (None, LAW, None), (4, "", None)])
    return path


def test_catalogue(spark, table, tmp_path, caplog):
    out = str(tmp_path / "out")
    settings = {**rule_catalogue.DEFAULTS, "no_topic": "khác"}
    with caplog.at_level(logging.INFO):
        told = rule_catalogue.run(spark, table, out, settings)
    assert told == {"documents": 3, "cards": 3} and "read 3 documents" in caplog.text and "wrote 3 cards" in caplog.text
    found = {r["citation"]: r for r in rule_catalogue.read(spark, out).collect()}
    assert {c: r["topic"] for c, r in found.items()} == {"Điều 1": "hóa đơn", "Điều 2": "xử phạt", "Điều 5": "khác"}
    assert {c: (r["refs_resolved"], r["refs_dangling"], r["cited_by"]) for c, r in found.items()} == {"Điều 1": (1, 0, 2), "Điều 2": (2, 1, 2), "Điều 5": (1, 0, 0)}
    summary = spark.read.json(f"{out}/documents").collect()
    assert [(r["document_id"], r["clauses"], r["numbers_missing"], r["snapshot"]) for r in summary] == [(1, 5, 2, "current")]
    # Again: the same; under another name: beside it.
    before = rows_of(rule_catalogue.read(spark, out))
    rule_catalogue.run(spark, table, out, settings)
    rule_catalogue.run(spark, table, out, {**settings, "snapshot": "later"})
    assert rows_of(rule_catalogue.read(spark, out)) == before == rows_of(rule_catalogue.read(spark, out, "later"))


def test_feed_takes_only_what_is_new(spark, table, tmp_path, caplog):
    out = str(tmp_path / "feed")
    run = lambda: clause_feed.run(spark, table, out, clause_feed.DEFAULTS)
    assert run() == {"batches": 1, "rows": 5}
    first = clause_feed.changes(spark, out)
    assert {r["change"] for r in first.collect()} == {"added"} and first.count() == 5
    assert run() == {"batches": 0, "rows": 0} and clause_feed.changes(spark, out).count() == 5
    # Document 1 comes again with another article 2, without article 5; document 6 is new; document 2 is as it was.
    write(spark, table, [(1, LAW.replace("mức 5", "mức 6").split("\nĐiều 5")[0], None), (6, "Điều 1. Mới", None), (2, "no clause", None)])
    with caplog.at_level(logging.INFO):
        assert run() == {"batches": 1, "rows": 3}
    assert "batch 1: read 3 documents; wrote 3 changes" in caplog.text
    second = clause_feed.changes(spark, out).where("batch = 1")
    assert sorted((r["document_id"], r["citation"], r["change"], r["version"]) for r in second.collect()) == [(1, "Điều 2", "changed", 2), (1, "Điều 5", "removed", 1), (6, "Điều 1", "added", 1)]
    now = {(r["document_id"], r["citation"]): r["version"] for r in clause_feed.read(spark, out).collect()}
    assert now == {(1, "Điều 1"): 1, (1, "Khoản 1 Điều 1"): 1, (1, "Điều 2"): 2, (1, "Khoản 1 Điều 2"): 1, (6, "Điều 1"): 1}
    # It comes back: added again, as its second version.
    write(spark, table, [(1, LAW.replace("mức 5", "mức 6"), None)])
    run()
    third = clause_feed.changes(spark, out).where("batch = 2").collect()
    assert [(r["citation"], r["change"], r["version"]) for r in third] == [("Điều 5", "added", 2)]


def test_growing_table_ends_like_the_whole(spark, tmp_path, sf_dir):
    """Half the documents, then the rest: the clauses of one run over all of them."""
    settings = {**clause_feed.DEFAULTS, "headers": True, "files_a_batch": 2, "parts": 4}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    growing = str(tmp_path / "grows")
    docs.where("doc_id % 2 = 0").repartition(3).write.parquet(growing)
    clause_feed.run(spark, growing, str(tmp_path / "a"), settings)
    docs.where("doc_id % 2 = 1").repartition(3).write.mode("append").parquet(growing)
    assert clause_feed.run(spark, growing, str(tmp_path / "a"), settings)["batches"] == 2
    clause_feed.run(spark, f"{sf_dir}/documents.parquet", str(tmp_path / "b"), settings)
    assert rows_of(clause_feed.read(spark, str(tmp_path / "a"))) == rows_of(clause_feed.read(spark, str(tmp_path / "b")))


def test_a_batch_that_failed_is_done_again(spark, table, tmp_path):
    """What a stopped batch had written is replaced by the same batch."""
    out = str(tmp_path / "feed")
    settings = clause_feed.DEFAULTS
    docs = spark.read.parquet(table).select("doc_id", "text")
    clause_feed.step(docs.where("doc_id = 1").withColumn("text", F.lit("Điều 9. Halb")), 0, out, settings)
    clause_feed.run(spark, table, out, settings)
    assert clause_feed.read(spark, out).where("citation = 'Điều 9'").count() == 0
    again = rows_of(clause_feed.changes(spark, out))
    clause_feed.step(docs, 0, out, settings)
    assert rows_of(clause_feed.changes(spark, out)) == again


def test_settings(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"parts": 8}, indent=1))
    assert _common.settings(spark, str(path), clause_feed.DEFAULTS)["parts"] == 8
    assert _common.settings(spark, None, clause_feed.DEFAULTS) == clause_feed.DEFAULTS
    path.write_text('{"part": 8}')
    with pytest.raises(ValueError, match="unknown settings"):
        _common.settings(spark, str(path), clause_feed.DEFAULTS)
    for job in (rule_catalogue, clause_feed):
        shipped = job.__file__.replace(".py", ".json")
        assert _common.settings(spark, shipped, job.DEFAULTS) == job.DEFAULTS


def test_command_line(spark, table, tmp_path):
    """The job in a process of its own, with the settings that it ships with; its tables and its log."""
    folder = Path(rule_catalogue.__file__).parent
    asked = [sys.executable, "-m", "jobs.clause_feed", table, str(tmp_path / "feed"), "--config", str(folder / "clause_feed.json")]
    done = subprocess.run(asked, cwd=folder.parent, capture_output=True, text=True, timeout=300, check=False)
    assert done.returncode == 0 and "took 5 new rows" in done.stderr
    assert clause_feed.read(spark, str(tmp_path / "feed")).count() == 5


def test_the_catalogue_writes_texts_of_clauses_once(spark, tmp_path, monkeypatch):
    """Parsed and stored clauses are one table, which is read without moving clauses, and cards are read, not made again."""
    columns, plans, held = [], [], rule_catalogue.held
    monkeypatch.setattr(rule_catalogue, "held", lambda *dfs: columns.extend(df.columns for df in dfs) or plans.extend(df._jdf.queryExecution().executedPlan().toString() for df in dfs) or held(*dfs))
    text = "Điều 1. Hộ kinh doanh khai thuế\nKhoản 1. theo khoản 2 Điều 12\nĐiều 1. lại\nĐiều 3. phạt tiền từ 1 triệu"
    docs = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "in"))
    rule_catalogue.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), rule_catalogue.DEFAULTS)
    assert sum("body" in c for c in columns) == 1
    assert [p for c, p in zip(columns, plans, strict=True) if "error" in c and "Exchange" in p] == []
    assert rule_catalogue.read(spark, str(tmp_path / "out")).count() == 4
    parsed = spark.createDataFrame([(1, 1, "dieu", "1", "Điều 1", "1", None), (1, 2, "dieu", "1", "Điều 1", "1", None)], "document_id long, ord int, kind string, number string, citation string, dieu string, khoan string")
    assert clauses.kept(clauses.ranked(parsed)).collect() == clauses.stored(parsed).collect()
