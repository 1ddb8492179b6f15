import json
import zipfile

from pyspark.sql import functions as F

from corpusloom.operators.clean import CleanOptions
from corpusloom.sources import readers, writers
from corpusloom.streaming import clean as streaming


def test_jsonl_round_trip(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.jsonl").write_text('{"id":"1","text":"甲"}\n\nbad line\n{"id":"2","text":null}\n', encoding="utf-8")
    (src / "b.jsonl").write_text('{"id":"3","text":"乙"}\n', encoding="utf-8")
    df = readers.read_jsonl(spark, str(src))
    assert sorted((r.id, r.text, r.src_file) for r in df.collect()) == [("1", "甲", "a.jsonl"), ("2", None, "a.jsonl"), ("3", "乙", "b.jsonl")]
    writers.write_by_source(df.select("id", "text", "src_file"), str(tmp_path / "out"))
    back = spark.read.json(str(tmp_path / "out"))
    assert back.count() == 3 and set(back.columns) == {"id", "text", "src_file"}


def test_markdown_tree(spark, tmp_path):
    (tmp_path / "x y").mkdir()
    (tmp_path / "x y/a.md").write_text("　 hi \n", encoding="utf-8")
    (tmp_path / "b.md").write_text(" \n", encoding="utf-8")
    rows = readers.read_markdown(spark, str(tmp_path)).collect()
    assert [(r.md_path, r.text) for r in rows] == [(str(tmp_path / "x y/a.md"), "hi")]


def test_listings(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.7 x")
    (tmp_path / "b.pdf").write_bytes(b"nope")
    (tmp_path / "c.PNG").write_bytes(b"x")
    (tmp_path / "d.png").write_bytes(b"x")
    assert {r.path.rsplit("/", 1)[1]: r.valid for r in readers.list_pdfs(spark, str(tmp_path)).collect()} == {"a.pdf": True, "b.pdf": False}
    assert [r.extension for r in readers.list_images(spark, str(tmp_path)).collect()] == [".png"]
    assert readers.list_files(spark, str(tmp_path)).count() == 4


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("docs/题.txt", "x")
    (tmp_path / "b.zip").write_bytes(b"broken")
    (tmp_path / "c.rar").write_bytes(b"Rar!")
    (tmp_path / "._d.zip").write_bytes(b"")
    rows = readers.expand_archives(spark, str(tmp_path)).collect()
    assert sorted((r.archive.rsplit("/", 1)[1], r.status, r.member) for r in rows) == [("a.zip", "success", "docs/题.txt"), ("b.zip", "failed", None), ("c.rar", "failed", None)]


def test_docx(spark, tmp_path):
    ns = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    body = f'<w:document {ns}><w:body><w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>题</w:t></w:r></w:p><w:p><w:r><w:t>文</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>1</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>'
    with zipfile.ZipFile(tmp_path / "a.DOCX", "w") as z:
        z.writestr("word/document.xml", body)
    (tmp_path / "b.docx").write_bytes(b"x")
    rows = {r.path.rsplit("/", 1)[1]: r for r in readers.read_docx(spark, str(tmp_path)).collect()}
    assert rows["a.DOCX"].text == "# 题\n\n文\n\n| 1 |"
    assert rows["b.docx"].text is None and rows["b.docx"].error


def test_vocabulary(spark, tmp_path):
    (tmp_path / "v").write_text("甲\n\n 乙 \n甲", encoding="utf-8")
    assert sorted(r.term for r in readers.read_vocabulary(spark, str(tmp_path / "v")).collect()) == ["乙", "甲"]


def test_append_once(spark, tmp_path):
    out = str(tmp_path / "done")
    first = spark.createDataFrame([("1", "a"), ("1", "a"), ("", "x"), (None, "y")], "id string, v string")
    assert writers.append_new(first, out) == 1
    assert writers.append_new(first.unionByName(spark.createDataFrame([("2", "b")], "id string, v string")), out) == 1
    assert spark.read.parquet(out).count() == 2


def test_shards_on_disk(spark, tmp_path):
    writers.write_shards(spark.range(25), str(tmp_path / "s"), ["id"], 10)
    assert [r["count"] for r in spark.read.json(str(tmp_path / "s")).groupBy("shard").count().orderBy("shard").collect()] == [10, 10, 5]


def test_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for k in range(3):
        (src / f"{k}.jsonl").write_text("\n".join(json.dumps({"id": str(i), "text": "b@c.dd " + "a" * 100}) for i in (k, k + 1)))
    cleaned = streaming.clean_stream(streaming.stream_jsonl(spark, str(src), "id string, text string", 1), CleanOptions(email=True))
    for _ in range(2):  # a second start finds nothing new
        streaming.start(cleaned, str(tmp_path / "out"), str(tmp_path / "cp"), once=True).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.id for r in out.collect()) == ["0", "1", "2", "3"]
    assert out.where(F.col("text") != "a" * 100).count() == 0
