from pyspark.sql import functions as F

from corpusloom.functions import text as T


def one(spark, column):
    return spark.range(1).select(column.alias("x")).head().x


def test_human_size(spark):
    want = {0: "0.00 B", 1023: "1023.00 B", 1024: "1.00 KB", 1152: "1.12 KB", 1048576: "1.00 MB", 3 * 1024**4: "3.00 TB", 2048 * 1024**4: "2048.00 TB"}
    for size, shown in want.items():
        assert one(spark, T.human_size(F.lit(size).cast("bigint"))) == shown


def test_chunks(spark):
    text = "字" * 4001
    assert [len(x) for x in one(spark, T.chunks(F.lit(text), 4000))] == [4000, 1]
    assert one(spark, T.chunks(F.lit(""), 4000)) == []


def test_paths(spark):
    p = F.lit("/a/b.c/Name.Tar.GZ")
    assert one(spark, T.base_name(p)) == "Name.Tar.GZ"
    assert one(spark, T.extension(p)) == ".gz"
    assert one(spark, T.stem(p)) == "Name.Tar"
    assert one(spark, T.parent(p)) == "/a/b.c"
    assert one(spark, T.extension(F.lit("/a/.hidden"))) == ""


def test_replies(spark):
    reply = F.lit('<think>{x}</think> ok {"reason":"r","label":1} tail')
    assert one(spark, F.get_json_object(T.outer_object(T.strip_reasoning(reply)), "$.label")) == "1"
    assert one(spark, T.outer_object(F.lit("no object"))) is None
    assert one(spark, T.labelled_value(F.lit("学科：英语\n文件类型：教案"), "学科")) == "英语"
    assert one(spark, T.labelled_value(F.lit("学科：英语"), "子类别")) == "其他"
    assert one(spark, T.normalise_keywords(F.lit("函数; 几何 ;;概率"))) == "函数; 几何; 概率"
    assert [one(spark, T.approved(F.lit(x))) for x in ("合理", "不合理", "合理，但不合理")] == [True, False, False]
    turns = one(spark, T.parse_qa_lines(F.lit('{"q":"Q1","a":"A1"}\n\noops\n{"q":"","a":"x"}')))
    assert [(t.role, t.content) for t in turns] == [("user", "Q1"), ("assistant", "A1")]


def test_python_str(spark):
    df = spark.createDataFrame([(True, 2, 1.5, None)], "b boolean, i int, d double, s string")
    got = df.select(*(T.python_str(df[c], k).alias(c) for c, k in df.dtypes)).head()
    assert tuple(got) == ("True", "2", "1.5", "")
