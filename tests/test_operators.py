import pytest
from pyspark.sql import functions as F

from corpusloom.operators import assets, dialogue, privacy, providers, quality, records
from corpusloom.plans import catalogue


def test_conditions(spark):
    df = spark.createDataFrame([("1", "x"), ("1", "x"), (None, "x")], "a string, b string")
    assert records.count_by_conditions(df, [{"field": "a", "value": 1}, {"field": "b", "value": "x"}]).head()[0] == 2
    assert records.count_by_conditions(df, [{"field": "a", "value": ""}, {"odd": 1}]).head()[0] == 1
    for bad in ([], [{"field": "a"}]):
        with pytest.raises(ValueError):
            records.count_by_conditions(df, bad)


def test_ids_joins_and_resuming(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (1, "d")], "id int, v string")
    assert [r.id for r in records.extract_ids(df, "v", "a").collect()] == ["1"]
    ids = spark.createDataFrame([("1",), ("1",)], "id string")
    assert sorted(r.v for r in records.semi_join_by_id(df, ids).collect()) == ["a", "d"]
    assert [r.v for r in records.resume(df, ids).collect()] == ["b"]
    assert sorted(r.v for r in records.append_once(df, order_by="v").collect()) == ["a", "b"]


def test_file_classes(spark):
    names = ["A.MP4", "b.flac", "c.HEIC", "d.pdf", "e.docx", "f.doc"]
    df = spark.createDataFrame([(n,) for n in names], "p string")
    assert [r[0] for r in df.select(assets.file_class(F.col("p"))).collect()] == ["video", "audio", "image", "pdf", "docx", None]
    zips = spark.createDataFrame([("._a.zip",), ("a.7z",), ("x_unzip",)], "p string")
    assert [r[0] for r in zips.select(assets.is_archive_name(F.col("p"))).collect()] == [False, True, True]


def test_rehome_last_wins(spark):
    recs = spark.createDataFrame([("s",), ("t",)], "stem string")
    src = spark.createDataFrame([("s", "d1", "a"), ("s", "d2", "b")], "st string, dir string, path string")
    moved, unmatched = assets.rehome_by_stem(recs, src, "stem", "st", "dir", "path")
    assert [(r.stem, r.target_dir) for r in moved.collect()] == [("s", "d2")]
    assert [r.stem for r in unmatched.collect()] == ["t"]


def test_copies(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x")
    plan = spark.createDataFrame([(str(tmp_path / "a.txt"), str(tmp_path / "o/a.txt")), (str(tmp_path / "no"), str(tmp_path / "o/no"))], "src string, dst string")
    assert sorted(r.status for r in assets.execute_copies(plan).collect()) == ["copied", "missing"]
    assert sorted(r.status for r in assets.execute_copies(plan).collect()) == ["exists", "missing"]


def turns(*roles):
    return [(r, r[0]) for r in roles]


def test_pairing_and_shards(spark):
    schema = "id int, qa_pairs array<struct<role: string, content: string>>"
    rows = [(1, turns("user", "assistant", "user")), (2, turns("system", "user", "assistant", "user", "assistant")), (3, []), (4, None), (5, turns("user", "assistant") * 4)]
    flat = dialogue.flatten_pairs(spark.createDataFrame(rows, schema), ["id"])
    assert sorted((r.id, r.pair_pos) for r in flat.collect()) == [(1, 0), (5, 0), (5, 1), (5, 2), (5, 3)]
    sizes = [r["count"] for r in dialogue.shard(flat, ["id", "pair_pos"], 2).groupBy("shard").count().orderBy("shard").collect()]
    assert sizes == [2, 2, 1]
    with pytest.raises(ValueError):
        dialogue.shard(flat, ["id"], 0)


def test_numbering_is_global(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    rows = dialogue.number_rows(df, ["k"], 7).collect()
    assert all(r.k == r.row_no for r in rows) and len(rows) == 1000


def test_pseudonyms(spark):
    df = spark.createDataFrame([("王小明和王小",), (None,)], "text string")
    names = spark.createDataFrame([("王小",), ("王小明",)], "real string")
    mapping = privacy.build_mapping(names, privacy.fake_person_names(spark, 10))
    assert [r.text for r in privacy.pseudonymise(df, mapping).collect()] == ["张一和张二", None]
    for make, n in ((privacy.fake_person_names, 2201), (privacy.fake_school_names, 81)):
        with pytest.raises(ValueError):
            make(spark, n)
    assert privacy.fake_person_names(spark, 2200).select("fake").distinct().count() == 2200


def test_more_entities_than_names(spark):
    names = spark.range(23_500).selectExpr("concat('n', id) AS real")
    rows = privacy.build_mapping(names, privacy.fake_person_names(spark, 2200), privacy.longer_person_names).collect()
    assert len({r.real for r in rows}) == len({r.fake for r in rows}) == 23_500
    with pytest.raises(Exception, match="more entities than names"):
        privacy.build_mapping(names.limit(12), privacy.fake_person_names(spark, 10)).collect()


def test_more_places_than_names(spark, tmp_path):
    chars = [chr(0x4E00 + k) for k in range(50)]
    places = [a + b + "镇" for a in chars for b in chars][:2300]
    spark.createDataFrame([(k, f"在{p}。") for k, p in enumerate(places)], "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert catalogue.queries()["pseudonym_mapping"](spark, str(tmp_path)).count() == 2300
    got = [r.text for r in catalogue.queries()["pseudonymise"](spark, str(tmp_path)).collect()]
    assert len(got) == len(set(got)) == 2300 and not any("镇" in t for t in got)


def test_quality(spark):
    df = spark.createDataFrame([(k, k % 2, (k // 2) % 2) for k in range(40)], "id int, label int, p int")
    assert quality.sample_k(df, 100, "id").count() == 40
    assert quality.sample_k(df, 7, "id").count() == 7
    parts = {r.part: r["count"] for r in quality.split_sets(df, "id").groupBy("part").count().collect()}
    assert parts == {"train": 28, "validation": 6, "test": 6}
    m = quality.weighted_metrics(df, "label", "p").head()
    assert m.accuracy == 0.5 and m.weighted_recall == 0.5
    empty = quality.retention(df.limit(0), F.col("label") == 1).head()
    assert (empty.total, empty.retained, empty.retained_pct) == (0, 0, 0.0)
    with pytest.raises(ValueError):
        quality.split_sets(df, "id", 0.9, 0.1)


def test_learned_filter(spark):
    good, bad = "the answer explains the method", "zzz qqq"
    lines = spark.createDataFrame([(good + f" {k}", 1) for k in range(20)] + [(bad + f" {k}", 0) for k in range(20)], "line string, label int")
    model = quality.train_filter(lines, features=1 << 10)
    assert {r.label for r in quality.apply_filter(model, lines).collect()} == {1}


def test_providers(spark):
    class Echo:
        def reply(self, inputs):
            return [x.upper() for x in inputs]

    df = spark.createDataFrame([("a",), (None,)], "q string")
    assert [r.reply for r in providers.ask(df, Echo, "q").collect()] == ["A", ""]

    class Broken:
        def reply(self, inputs):
            raise OSError

    robin = providers.RoundRobin([Broken(), Echo()], pause=0)
    assert robin.reply(["x"]) == ["X"]
    assert providers.RoundRobin([Broken()], tries=2, pause=0).reply(["x"]) == [None]
    year = providers.school_year_from_path(F.lit("a/2023学年/b"))
    assert spark.range(1).select(year).head()[0] == "2023-2024学年"
    assert spark.range(1).select(providers.school_year_from_path(F.lit("2003学年"))).head()[0] == "无"
    names = providers.ask(spark.createDataFrame([("姓名：李四",)], "q string"), providers.RuleNames, "q")
    assert names.select(providers.entities_from_reply(F.col("reply"))).head()[0] == ["李四"]
