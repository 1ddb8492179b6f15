import base64
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import encode

tiktoken = pytest.importorskip("tiktoken")


def reference(name):
    path = encode.default_vocabulary(name)
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=encode.default_pattern(), mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("name", ["byte_bpe_50k", "byte_bpe_multi_50k"])
def test_ids_are_exact(data, name):
    import pandas as pd

    own, other = encode.ByteBpe(encode.default_vocabulary(name), encode.default_pattern()), reference(name)
    random.seed(1)
    bits = ["ab", "the", "😀", "한", "の", "中", "é", " ", "  ", "\n", "1", "ing", "ʳ", "́", "<|endoftext|>"]
    made = ["".join(random.choices(bits, k=random.randint(0, 60))) for _ in range(500)]
    made += ["".join(random.choices("abcdefghij", k=random.randint(1, 80))) for _ in range(500)]
    for text in [*made, *pd.read_parquet(f"{data}/documents.parquet").text.dropna()]:
        assert own.encode(text) == other.encode_ordinary(text)


def test_one_word_of_any_length():
    own, other = encode.ByteBpe(encode.default_vocabulary(), encode.default_pattern()), reference("byte_bpe_50k")
    word = "ab" * 40_000
    assert own.encode(word) == other.encode_ordinary(word)


def test_null_empty_repeated_and_extra_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (2, "", "x"), (None, "a b", "x")], "doc_id bigint, text string, ids string")
    rows = encode.encode_corpus(df, "doc_id").collect()
    assert sorted((r.doc_id or 0, r.ids) for r in rows)[0][1] != [] and [r.ids for r in rows[:3]] == [[], [], []]
    assert rows[0].asDict().keys() == {"doc_id", "ids"}
    assert encode.encode_corpus(df.limit(0), "doc_id").count() == 0
    counts = encode.encode_corpus(df, "doc_id", count_only=True).agg(F.sum("ids")).head()[0]
    assert counts == 2
