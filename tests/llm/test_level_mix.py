import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import level, mix


def test_passages_are_placed_in_their_band(spark, data):
    anchors = spark.read.parquet(f"{data}/level_anchors.parquet")
    # held out: half of the passages grade the other half
    odd, even = anchors.where("anchor_id % 2 = 1"), anchors.where("anchor_id % 2 = 0")
    got = level.reading_levels(even, odd, "anchor_id").join(anchors.select("anchor_id", F.col("band").alias("want")), "anchor_id").toPandas()
    assert len(got) == even.count() and (got["band"] == got["want"]).mean() >= 0.9


def test_level_edges(spark, data):
    anchors = spark.read.parquet(f"{data}/level_anchors.parquet")
    df = spark.createDataFrame([("a", None, 1), ("b", " \n　", 1), ("c", "好", 1), ("d", "12 34", 1), ("e", "word " * 30_000, 1), ("c", "好", 1)], "id string, text string, band int")
    rows = level.reading_levels(df, anchors).collect()
    assert sorted(r.id for r in rows) == ["c", "c", "d", "e"] and all(1 <= r.band <= 4 for r in rows)
    assert level.reading_levels(df.limit(0), anchors).count() == 0
    with pytest.raises(ValueError):
        level.reading_levels(df, anchors.limit(0))


def test_mixture_meets_its_shares(spark):
    rows = [(k, "alpha beta gamma " * (k % 5 + 1), "ab"[k % 2] if k % 10 else "c") for k in range(2000)] + [(9001, None, "a"), (9002, "", "b"), (9003, "other text", "zz")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.3, 1), ("c", 0.15, 3), ("none", 0.05, 4)], "source string, target_share double, max_repeats int")
    mixed = mix.mixture(docs, targets)
    got = {r.source: r for r in mix.reached_shares(mixed, targets).collect()}
    for s, share in (("a", 0.5), ("b", 0.3), ("c", 0.15)):
        assert abs(got[s].share - share / 0.95) < 0.01 and got[s].most_copies <= got[s].max_repeats
    assert got["none"].tokens == 0
    ids = {r.doc_id for r in mixed.collect()}
    assert not ids & {9001, 9002, 9003}
    assert mix.mixture(docs.limit(0), targets).count() == 0


def test_unnamed_documents_join_by_their_text(spark):
    rows = [(k, "数学题目与解答 " * 5, "m") for k in range(50)] + [(100 + k, "english reading text " * 5, "e") for k in range(50)] + [(500, "数学题目与解答 " * 5, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("m", 0.5, 1), ("e", 0.5, 1)], "source string, target_share double, max_repeats int")
    shares = {r.source: r.share for r in mix.reached_shares(mix.mixture(docs, targets).where("source IS NOT NULL"), targets).collect()}
    assert abs(shares["m"] - 0.5) < 0.1
    model = mix.train_classifier(docs, ["e", "m"], "text", "source")
    p = mix.posteriors(mix._features(["数学题目与解答 " * 5])[0], model)
    assert p[1] > 0.9


def test_texts_of_named_documents_move_their_rates(spark):
    maths, english = "数学题目与解答 " * 5, "english reading text " * 5
    rows = [(k, maths if k % 2 else english, "a") for k in range(800)] + [(1000 + k, english, "b") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], "source string, target_share double, max_repeats int")
    mixed = mix.mixture(docs, targets)
    got = {r.source: r for r in mix.reached_shares(mixed, targets).collect()}
    assert abs(got["a"].share - 0.5) < 0.01 and abs(got["b"].share - 0.5) < 0.01 and got["b"].documents == 400
    # half of a reads like b: only its other half brings a's tokens by text to their share
    maths_tokens = sum(r.tokens for r in mixed.where("source = 'a' AND doc_id % 2 = 1").collect()) / got["a"].tokens
    assert got["a"].most_copies == 1 and maths_tokens > 0.9


def test_targets_are_checked(spark):
    bad = spark.createDataFrame([("a", 0.0, 1)], "source string, target_share double, max_repeats int")
    with pytest.raises(ValueError):
        mix.read_targets(bad)
    assert isinstance(mix.read_targets(bad.union(spark.createDataFrame([("b", 2.0, 1)], bad.schema))), pd.DataFrame)
