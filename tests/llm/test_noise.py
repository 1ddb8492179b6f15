import pytest

from corpusloom.llm import noise as N

ZH = "通过这个过程，大家对力学实验有了新的认识。上节课我们学过重力势能，今天继续讨论摩擦力。"
EN = "The teacher asked the class to measure the timeline, and they soon found a good method for the question. "


def page(text, width=20, mark=""):
    out = [text[k : k + width] for k in range(0, len(text), width)]
    return (mark + "\n").join(out)


def test_keys_agree():
    import numpy as np

    for gram in ("中文", "a中b", "四个汉字"):
        codes = np.array([ord(c) for c in gram], np.uint64)
        assert N._gram_key(gram) == int(N._gram_keys(codes, len(gram)).view(np.int64)[0])


@pytest.mark.parametrize("line", ["第179页", "- 43 -", "— 202 —", "·73·", "第 127 页 共 150 页", "33/56", "〔206〕", "p. 126", "Page 71", "Page 164 of 187", "第l21页", "第六十三页"])
def test_page_numbers(line):
    text = page(ZH * 2) + f"\n{line}\n" + page(ZH * 2)
    lines, found = N.layout(text)
    assert [lines[k] for k, v in found.items() if v == "page_no"] == [line]


def test_bare_numbers_count_on():
    text = page(ZH) + "\n97\n" + page(ZH) + "\n31\n\n55\n" + page(ZH) + "\n98\n" + page(ZH)
    lines, found = N.layout(text)
    assert [lines[k] for k, v in sorted(found.items()) if v == "page_no"] == ["97", "98"]


def test_a_bare_number_parts_a_sentence():
    text = page(ZH[:40]) + "\n\n55\n\n" + page(ZH[40:] + ZH)
    lines, found = N.layout(text)
    assert [lines[k] for k in found] == ["55"]


def test_running_titles():
    text = "热传 导复习提纲\n" + page(ZH) + "\n- 3 -\n热传导复习提纲\n" + page(ZH) + "\n- 4 -\n5   热传导复习提纲\n" + page(ZH)
    lines, found = N.layout(text)
    assert sum(v == "header" for v in found.values()) == 3


def test_running_titles_in_turn():
    body = "".join(chr(0x4E00 + 97 * k % 8000) for k in range(2000))
    parts = [page(body[k : k + 200] + "，") for k in range(0, 2000, 200)]
    # a body line that recurs out of step is no title
    parts[2], parts[5] = parts[2].replace("\n", "\n课堂小结与反思\n", 2), "课堂小结与反思\n" + parts[5]
    text = "\n".join(("热传导复习提纲", "第五单元 勾股关系")[k % 2] + "\n" + p for k, p in enumerate(parts))
    lines, found = N.layout(text)
    assert sorted(lines[k] for k in found) == ["热传导复习提纲"] * 5 + ["第五单元 勾股关系"] * 5


def test_unscanned_text_has_none():
    assert N.layout((ZH + "\n\n") * 5) is None
    assert N.layout("- a b c d e f g\n- h\n\n| 1 | 2 |\n|---|---|") is None


def test_words():
    assert "question" in {N.skeleton(e) for e in N.expansions("quesfion")} or N.skeleton("question") == N.skeleton("quesfion")
    assert N.skeleton("student5") == N.skeleton("students") and "student5" in N.expansions("stiident5")
    assert N.skeleton("timeline") in {N.skeleton(e) for e in N.expansions("timelme")}


def test_noise_of_a_small_corpus(spark):
    clean = [(f"c{k}", (ZH + EN) * 3 + "Keep it up-to-date in a hard-cover book.") for k in range(30)]
    dirty = page((ZH * 3).replace("过程", "过稈", 1)) + "\n— 12 —\n" + page(ZH)
    west = "The teacher asked the class to measure the time-\nline, and they soon found a good mcthod for the\nquestion. Keep it up-to-\ndate in a hard-cover book. The teacher asked the\nclass to measure the timeline."
    soft = "The teacher asked the class to mea\xad\nsure the timeline, and they soon found a good\nmethod for the question."
    df = spark.createDataFrame([*clean, ("d", dirty), ("w", west), ("s", soft), ("d", dirty), ("n", None), ("e", ""), (None, ZH)], "id string, text string").selectExpr("*", "1 AS line_no", "'x' AS noise")
    got = {(r.id, r.line_no, r.noise) for r in N.page_noise(df).collect()}
    pages = dirty.split("\n")
    assert ("d", pages.index("— 12 —") + 1, "page_no") in got
    assert {n for i, n, k in got if (i, k) == ("d", "misread")} == {k + 1 for k, x in enumerate(pages) if "稈" in x}
    assert {(n, k) for i, n, k in got if i == "w"} == {(1, "hyphen"), (2, "misread")}
    assert {(n, k) for i, n, k in got if i == "s"} == {(1, "hyphen")}
    assert not any((i or "c").startswith(("c", "n", "e")) for i, _, _ in got)
    assert N.page_noise(df.limit(0)).count() == 0


def test_very_long_runs(spark):
    long = "x" * 60_000
    texts = [f"{long} -\n{long}-\nabc {long}\n" * 2, long, ("ab " * 9 + "\n") * 3000, "字" * 60_000 + "\n" + "己" * 3000]
    df = spark.createDataFrame([(str(k), t) for k, t in enumerate(texts)], "id string, text string")
    assert N.page_noise(df).count() >= 0
    assert N.word_at_end("in a hard-") == (5, "hard", "-") and N.word_at_end("no mark") is None


def test_repair(spark):
    clean = [(f"c{k}", (ZH + EN) * 3) for k in range(30)]
    dirty = "热传导复习提纲\n" + page((ZH * 2).replace("过程", "过稈", 1)[:60]) + "\n— 12 —\n\n热传导复习提纲\n" + page((ZH * 2)[60:] + ZH)
    west = "The teacher asked the class to measure the time-\nline, and they soon found a good mcthod for the\nquestion.\n   The teacher asked the\nclass to measure the timeline."
    df = spark.createDataFrame([*clean, ("d", dirty), ("w", west), ("n", None)], "id string, text string")
    got = {r.id: r for r in N.repair_pages(df).collect()}
    assert got["d"].scanned and got["d"].repaired == ZH * 3
    assert got["w"].repaired == "The teacher asked the class to measure the timeline, and they soon found a good method for the question.\n\nThe teacher asked the class to measure the timeline."
    assert got["c0"].repaired == clean[0][1] and not got["c0"].scanned and "n" not in got
