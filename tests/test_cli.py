from clausemill.cli import main


def test_from_import_to_cards(spark, tmp_path, capsys):
    run = lambda *a: main(["--db", str(tmp_path / "db"), *a], spark)
    assert run("register", "luat.pdf", "--title", "Luật") == 0
    assert run("structure", "9") == 2
    from clausemill.sources.store import Store

    books = Store(spark, str(tmp_path / "db"))
    books.write("pages", spark.createDataFrame([(1, 1, "p1.png"), (1, 2, "p2.png")], "document_id long, page_ordinal int, image_path string"))
    bad = tmp_path / "bad.md"
    bad.write_text("nothing")
    assert run("ocr-import", "1", str(bad)) == 2
    good = tmp_path / "good.md"
    good.write_text("<!-- page 1-2 -->\n<PAGE>Điều 1. Tổ chức lập hóa đơn; xong\n<PAGE>Điều 2. Cá nhân")
    assert run("ocr-import", "1", str(good)) == 0
    out = str(tmp_path / "out")
    assert run("structure", "1", "--out", out) == 0 and run("invariants", "1") == 0 and run("cards", "1", "--out", out) == 0 and run("embed", "1", "--dim", "32") == 0
    assert (tmp_path / "out/structure/doc1/clauses.json").is_dir() and (tmp_path / "out/cards/doc1/cards.json").is_dir()
    assert '"refs_internal": 0' in capsys.readouterr().out
    assert run("retrieve", "lập hóa đơn", "--topic", "hóa đơn", "--dim", "32") == 0
    assert "Điều 1" in capsys.readouterr().out
    assert run("list") == 0
    capsys.readouterr()
    assert run() == 0 and capsys.readouterr().out == "inserted doc_id=2; total docs=2\n"
