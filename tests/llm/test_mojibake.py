import numpy as np
import pandas as pd
import pytest

from corpusloom.llm import mojibake as M


@pytest.fixture(scope="module")
def repairer(data):
    texts = pd.read_parquet(data.replace("0.001", "0.01") + "/documents.parquet").text.dropna()
    codes = M.code_points("\0".join(texts))
    keep = (codes[:-1] > 127) | (codes[1:] > 127)
    return M.Repairer(M.pair_costs(np.bincount(M.pair_hash(codes)[keep], minlength=1 << M.SKETCH_BITS)))


ZH = "上节课我们学过物理实验，今天继续讨论重力势能。"
WEST = "Les élèves étudient la géométrie à l’école depuis 1960."


@pytest.mark.parametrize("wrong,right", [("cp1252", "utf-8"), ("latin-1", "utf-8"), ("cp437", "utf-8"), ("mac_roman", "utf-8"), ("gb18030", "utf-8"), ("latin-1", "gb18030"), ("cp1251", "gb18030")])
def test_whole_texts_come_back(repairer, wrong, right):
    image = M.byte_image(wrong) if wrong != "gb18030" else None
    raw = ZH.encode(right)
    garbled = "".join(image[b] for b in raw) if image else raw.decode(wrong, "replace")
    new, layers, _, lost = repairer.repair(garbled)
    assert layers >= 1 or lost
    if image:
        assert new == ZH


def test_two_layers_and_parts(repairer):
    once = WEST.encode("utf-8").decode("cp1252")
    twice = once.encode("utf-8").decode("cp1252", "replace") if all(c not in once for c in "\x81\x8d\x8f\x90\x9d") else None
    assert repairer.repair("Vorher. " + once)[0] == "Vorher. " + WEST
    if twice and "�" not in twice:
        assert repairer.repair(twice)[0] == WEST


def test_right_text_stays(repairer):
    for text in (ZH, WEST, "naïve façade ½ litre at 20 °C ± 1, €33", "日语例句：これは本です。", "Это книга.", "┌──┬──┐│甲│乙│└──┴──┘", "今天很有趣😀👍🏽✅", "müssen größere Aufgaben gelöst", "", None):
        new, layers, _, lost = repairer.repair(text)
        assert new == text and not layers and not lost, text


def test_lost_text_is_found(repairer):
    assert repairer.repair("估计偏锟斤拷锟斤拷但")[3] and repairer.repair("abc � d")[3]


def test_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "plain", "x"), (4, "a � b", "x")], "doc_id bigint, text string, restored string")
    assert [r.doc_id for r in M.repair_texts(df).collect()] == [4]
    assert M.repair_texts(df.limit(0)).count() == 0
