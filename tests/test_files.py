import json

from ragset.sources.files import list_documents, load_results, read_chunks, read_markdown, save_results


def test_markdown_and_documents(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a_ref.md").write_text("# A\n\nx")
    (tmp_path / "sub" / "b.md").write_text("y")
    (tmp_path / "c.txt").write_text("no")
    (tmp_path / "big.pdf").write_bytes(b"x" * 90)
    (tmp_path / "sub" / "small.HTML").write_bytes(b"x")
    assert sorted((r.file_name, r.text) for r in read_markdown(spark, str(tmp_path)).collect()) == [("a_ref", "# A\n\nx"), ("b", "y")]
    assert [(r.file_name, r.length) for r in list_documents(spark, str(tmp_path)).collect()] == [("small", 1), ("big", 90)]
    done = spark.createDataFrame([("small",)], "file_name string")
    assert [r.file_name for r in list_documents(spark, str(tmp_path), done, 5).collect()] == ["big"]


def test_chunks_and_results(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps([{"file_name": "f", "chunk_id": "1", "more": 3}, {"content": "x\ny"}]))
    assert sorted((r.file_name or "", r.content or "") for r in read_chunks(spark, str(tmp_path / "c.json")).collect()) == [("", "x\ny"), ("f", "")]
    rows = [{"question": "q", "answer": "a", "hop_count": 2}, {"question": "p"}]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    (tmp_path / "l.json").write_text("\n".join(map(json.dumps, rows)))
    (tmp_path / "w.json").write_text(json.dumps({"qa_pairs": rows, "stats": {}}))
    for name, form in (("a", "array"), ("l", "lines"), ("w", "wrapped")):
        got = load_results(spark, str(tmp_path / f"{name}.json"), form)
        assert sorted((r.question, r.answer, r.hop_count) for r in got.collect()) == [("p", None, None), ("q", "a", 2)]
    for form in ("jsonl", "csv", "parquet"):
        save_results(got, str(tmp_path / form), form)
    assert load_results(spark, str(tmp_path / "jsonl"), "lines").count() == 2
