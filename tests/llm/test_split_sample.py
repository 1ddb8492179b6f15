import random
from collections import Counter

import numpy as np
import pytest

from corpusloom.llm import sample, split

TEXTS = [
    "一句话。另一句！" * 300,
    "No marks at all just words " * 200,
    "无标点" * 900,
    "a\r\n\r\nb. C d.\n\n" * 200,
    "👩‍🏫🇫🇷👍🏽e\u0301" * 150,
    "x" * 5000,
    "",
    "short",
]


@pytest.mark.parametrize("limit,overlap", [(400, 0), (400, 40), (100, 99), (1, 0), (1000, 100)])
def test_pieces_give_the_whole_text(limit, overlap):
    for text in TEXTS:
        made = split.pieces(text, limit, overlap)
        assert "".join(text[c:e] for _, c, e in made) == text
        assert all(e - s <= limit for s, _, e in made)
        for (s, c, _), (_, _, before) in zip(made[1:], made):
            assert c == before and s == max(0, c - overlap)
        assert len(made) == 1 or len(text) > limit


def test_cuts_are_natural():
    text = "甲乙丙丁戊己庚。" * 200
    assert all(e == len(text) or text[e - 1] == "。" for _, _, e in split.pieces(text, 100, 0))
    words = "word " * 400
    assert all(e == len(words) or words[e - 1] == " " for _, _, e in split.pieces(words, 103, 0))
    paragraphs = ("Some text here. More of it, too.\n\n") * 50
    assert all(paragraphs[e - 2 : e] == "\n\n" for _, _, e in split.pieces(paragraphs, 300, 0))
    flags = "🇫🇷" * 300
    assert all(e % 2 == 0 for _, _, e in split.pieces(flags, 101, 0))


def test_split_texts_rows(spark):
    df = spark.createDataFrame([("a", "x" * 30, 1), ("b", None, 1), ("c", "", 1), ("a", "x" * 30, 1)], "id string, text string, piece_no int")
    rows = split.split_texts(df, [(1, 10, 0), (2, 50, 5)]).collect()
    assert Counter((r.setting_id, r.id) for r in rows) == {(1, "a"): 8, (2, "a"): 2, (1, "c"): 1, (2, "c"): 1}
    assert split.split_texts(df.limit(0), [(1, 10, 0)]).count() == 0
    with pytest.raises(ValueError):
        split.split_texts(df, [(1, 10, 10)])


def test_bad_limits():
    for limit, overlap in ((0, 0), (5, 5), (5, -1)):
        with pytest.raises(ValueError):
            split.pieces("abc", limit, overlap)


def test_sample_size_and_duplicates(spark):
    df = spark.createDataFrame([(k % 500, "x", k) for k in range(1500)] + [(None, "x", 0)], "qa_id bigint, key string, coin int")
    got = [r.qa_id for r in sample.sample_keys(df, "qa_id", 50).collect()]
    assert len(got) == len(set(got)) == 50
    assert sample.sample_keys(df, "qa_id", 5000).count() == 500
    assert sample.sample_keys(df, "qa_id", 0).count() == 0
    assert sample.sample_keys(df.limit(0), "qa_id", 5).count() == 0
    rows = sample.sample_rows(df, "qa_id", 50, order_by="coin").collect()
    assert len(rows) == 50 and all(r.coin < 500 for r in rows)
    assert {r.qa_id for r in rows} == set(got)
    with pytest.raises(ValueError):
        sample.sample_keys(df, "qa_id", -1)


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(20_000).withColumnRenamed("id", "k")
    sets = [{r.k for r in sample.sample_keys(df.repartition(n), "k", 100).collect()} for n in (1, 9, 130)]
    assert sets[0] == sets[1] == sets[2]


def test_sample_just_above_the_capacity_is_whole(spark):
    df = spark.range(6001).withColumnRenamed("id", "k")
    for seed in range(4):
        sets = [{r.k for r in sample.sample_keys(df.repartition(n), "k", 3000, seed=seed).collect()} for n in (1, 5)]
        assert len(sets[0]) == 3000 and sets[0] == sets[1]


def test_sample_is_uniform(spark):
    df = spark.range(200).withColumnRenamed("id", "k")
    hits = Counter(r.k for s in range(60) for r in sample.sample_keys(df, "k", 20, seed=s).collect())
    counts = np.array([hits[k] for k in range(200)])
    # each key is drawn 6 times on average; chi-square with 199 degrees of freedom
    assert ((counts - 6) ** 2 / 6 / 0.9).sum() < 270


def test_buffer_halves_and_thins():
    import pandas as pd

    rng = np.random.default_rng(1)
    buffer = sample.AdaptiveBernoulli(100)
    for _ in range(30):
        n = random.randint(1, 400)
        buffer.add(pd.DataFrame({"key": rng.integers(0, 10**12, n), "coin": rng.integers(-(2**63), 2**63 - 1, n), "draw": rng.integers(-(2**63), 2**63 - 1, n)}))
    assert 0 < len(buffer.rows()) <= 100 and buffer.level > 3
