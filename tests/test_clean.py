import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators.clean import CleanOptions, clean, drop_answer_sheets, keep_long
from corpusloom.plans import catalogue

CASES = [
    ("markdown", "A ![img](http://a.com/x.png) B [go](https://b.io) C ![broken]", "A  B  C"),
    ("markdown", "[a](u v)", "[a](u v)"),
    ("markdown", "[x]()", ""),
    ("markdown", "[x](f(y))", "[x](f(y))"),
    ("email", "Contact me at a.b+z@test.COM! Or at foo_bar@sub.example.org.", "Contact me at ! Or at ."),
    ("email", "a b@c.d e", "a  e"),
    ("email", "a@b.c1@d.e", ""),
    ("link", "See https://example.com and ftp://host/file and http://a/b?c=d", "See  and host/file and a/b?c=d"),
    ("link", "go https://example.com/a?b=1 end", "go  end"),
    ("link", "https://x.com?q=1", "?q=1"),
    ("link", "http://localhost:8000/t", ""),
    ("link", "invalid://example.com", "invalid://example.com"),
    ("link", "看http://a.com", "看http://a.com"),
    ("ip", "ip 192.168.0.1; ok", "ip ; ok"),
    ("ip", "999.1.1.1", "999.1.1.1"),
    ("ip", "ipv4=192.168.0.1; ipv6=fe80::1ff:fe23:4567:890a; ok", "ipv4=; ipv6=1ff:fe23:4567:890a; ok"),
    ("ip", "2001:0db8:85a3:0000:0000:8a2e:0370:7334", ""),
    ("ip", "2001:db8:85a3::8a2e:370:7334", "8a2e:370:7334"),
    ("ip", "::1", "::1"),
    ("ip", "2001:db8::", "2001:db8::"),
    ("control_char", "ok\nbad\x00good\x01", "ok\nbadgood"),
    ("control_char", "a\tb\rc", "abc"),
    ("repeat_space", "a  b\t\tc\n\nd", "a b\tc\nd"),
    ("repeat_space", "x \n y", "x\ny"),
    ("repeat_space", "a\t b", "a\nb"),
    ("punctuation_clip", "Hello world.", "Hello world."),
    ("punctuation_clip", "中文句子。", "中文句子。"),
    ("punctuation_clip", "Hi! still running", "Hi!"),
    ("punctuation_clip", "没有终止符号与句点", ""),
    ("text_circled", "Step $ \\textcircled{1} $ then $ \\textcircled{ 2 } $ done.", "Step 1. then 2. done."),
    ("text_circled", "Bad $ \\textcircled{ A } $ ignored.", "Bad  ignored."),
    ("text_circled", "$\\textcircled{①}$", "①."),
    ("filename", "see report.pdf) and pic.jpg", "see  and "),
    ("filename", "a.docx", "x"),
    ("filename", "audio.wav", "audio.wav"),
    ("filename", "archive.tar.gz", ".gz"),
    ("repeat_char", "a!!!!!!!!b", "ab"),
    ("repeat_char", "a!!!!!!!b", "a!!!!!!!b"),
    ("repeat_char", "a ======== b", "ab"),
    ("repeat_char", "a-------- b", "a-------- b"),
    ("repeat_char", "a********(b", "a********(b"),
    ("html", "<div>Hello</div><p>World</p><span>!</span>", "HelloWorld!"),
    ("html", "<div class='x'><br/><B><b>", "<div class='x'><br/><B><b>"),
    ("html", "</ p >", ""),
    ("html", "<<p>div>", ""),
]


def test_cleaners_on_cases(spark):
    rows = spark.createDataFrame([(k, n, x) for k, (n, x, _) in enumerate(CASES)], "k int, name string, text string")
    for name, cleaner in T.CLEANERS.items():
        for r in rows.where(F.col("name") == name).select("k", cleaner(F.col("text")).alias("got")).collect():
            assert r.got == CASES[r.k][2], CASES[r.k]


def test_cleaners_keep_null_and_empty(spark):
    df = spark.createDataFrame([(None,), ("",)], "text string")
    for cleaner in T.CLEANERS.values():
        assert [r[0] for r in df.select(cleaner(F.col("text"))).collect()] == [None, ""]


@pytest.mark.parametrize("name", ["email", "control_char", "repeat_space", "punctuation_clip"])
def test_cleaners_are_idempotent(spark, data, name):
    cleaner = T.CLEANERS[name]
    once = spark.read.parquet(f"{data}/md_info.parquet").select(cleaner(F.col("text")).alias("t"))
    assert once.where(cleaner(F.col("t")) != F.col("t")).count() == 0


def test_long_runs_are_linear(spark):
    df = spark.createDataFrame([("x" * 60_000 + "@",), ("!" * 60_000,)], "text string")
    assert clean(df, CleanOptions.everything(min_text_length=0)).count() == 2


def test_strip_takes_wide_spaces(spark):
    df = spark.createDataFrame([("　\x1c a b \n",)], "t string")
    assert df.select(T.strip(F.col("t"))).head()[0] == "a b"


def test_letters_and_length_filter(spark):
    df = spark.createDataFrame([("Hello, 世界123",), ("a" * 100,), ("a" * 99 + "1",), (None,)], "text string")
    assert df.select(T.letter_count(F.col("text"))).head()[0] == 7
    assert [r.text for r in keep_long(df).collect()] == ["a" * 100]


def test_filter_looks_at_raw_text(spark):
    df = spark.createDataFrame([("a" * 120,)], "text string")
    assert clean(df, CleanOptions(punctuation_clip=True)).collect()[0].text == ""


def test_answer_sheets(spark):
    paths = ["x/答题卡.pdf", "x/解答卷1.pdf", "答题卡/x.pdf", None, "答卷.doc"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    assert [r.path for r in drop_answer_sheets(df).collect()] == ["x/解答卷1.pdf", "答题卡/x.pdf", None]


def test_other_columns_pass(spark):
    df = spark.createDataFrame([("b@c.dd " + "a" * 100, 7, "k")], "text string, t1 int, path string")
    row = clean(df, CleanOptions(email=True)).head()
    assert (row.text, row.t1, row.path) == ("a" * 100, 7, "k")


def test_symbol_runs_of_whole_texts(spark, tmp_path):
    texts = ["字" * 1000 + "=" * 9 + "end" * 200, "ab!" * 300, None]
    spark.createDataFrame([(str(k), t, None) for k, t in enumerate(texts)], "id string, text string, ingested_at timestamp").write.parquet(str(tmp_path / "md_info.parquet"))
    got = {r.id: r.text for r in catalogue.queries()["clean_symbol_runs_whole"](spark, str(tmp_path)).collect()}
    assert got == {"0": "字" * 1000 + "end" * 200 + got["2"], "1": "ab!" * 300 + got["2"], "2": got["2"]}
