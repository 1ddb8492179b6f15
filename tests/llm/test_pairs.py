import pytest

from corpusloom.llm import pairs as P

SCHEMA = "qa_id bigint, qa_pairs array<struct<role: string, content: string>>, defect string"


@pytest.mark.parametrize("answer", [None, "", "  \n", "。", "——", "...", "答案：", "Answer:", "（略）", "无", "N/A", "null", "\u200b"])
def test_empty(answer):
    assert P.defect_of("What is it?", answer, True) == "empty"


@pytest.mark.parametrize("answer", ["D", "A", "选B", "C、D", "530", "Option C", "结果是888。", "对。"])
def test_short_answers_are_no_defect(answer):
    assert P.defect_of("下列说法正确的是（　）\nA. 甲\nB. 乙", answer, True) is None


QUESTION = "学习价值判断时，以下哪个判断合理？\nA. 可以用直尺直接测出\nB. 结果一定相同"


@pytest.mark.parametrize("answer", [QUESTION, "问题：" + QUESTION, "学习价值判断时,以下哪个判断合理?", "你的问题是：学习价值判断时，以下哪个判断合理？学习价值判断时，以下哪个判断合理？"])
def test_copies(answer):
    assert P.defect_of(QUESTION, answer, True) == "copies_question"


def test_question_then_answer_is_no_copy():
    q = "How would you teach the difference between bar charts and ratio problems?"
    assert P.defect_of(q, q + " Here is one way to see it: start with the labels, then sort the numbers.", True) is None
    assert P.defect_of(q, "You asked: " + q.lower(), True) == "copies_question"


@pytest.mark.parametrize("answer", ["抱歉，我无法回答这个问题。", "本系统恐怕难以解答该问题，建议咨询老师。", "出于安全方面的考虑，此类请求不予处理。", "Sorry, I cannot help with that request.", "I must decline to answer this request.", "It would not be appropriate for me to respond to that.", "As an AI language model, I am not able to provide an answer to this."])
def test_refusals(answer):
    assert P.defect_of("请简要说明价值判断。" if ord(answer[0]) > 500 else "Why is it so?", answer, True) == "refusal"


@pytest.mark.parametrize("answer", ["上节课我们学过比例关系。对不起他人的时候要主动道歉。", "A judgement about word stress cannot rest on a single observation; several stages have to be considered."])
def test_words_of_refusal_in_answers(answer):
    assert P.defect_of("请简要说明比例关系。" if ord(answer[0]) > 500 else "Explain word stress.", answer, True) is None


def test_languages():
    zh, en, fr = "把温度计放在桌面上，每隔五分钟检查一次。", "Place the ruler on the desk and check it every five minutes.", "Les élèves étudient la géométrie à l’école depuis des années."
    assert P.defect_of("请简要说明。", en, True) == "other_language"
    assert P.defect_of("Why do the students measure it?", zh, True) == "other_language"
    assert P.defect_of("Why do the students measure it?", "Answer: C\n" + fr, True) == "other_language"
    assert P.defect_of("请将这句话翻译为英文：“小猫睡着了。”", en, True) is None
    assert P.defect_of("请将这句话翻译为英文：“小猫睡着了。”", fr, True) == "other_language"
    assert P.defect_of("请简要说明。", zh, True) is None


def test_truncation_over_a_corpus(spark):
    sentence = "当其他条件相同时，电解过程的数值约为3.92，误差主要来自学习单的读数。"
    whole = [(k, [("user", "请说明。"), ("assistant", sentence * 2)], "x") for k in range(40)]
    cut = [(100 + k, [("user", "请说明。"), ("assistant", sentence + sentence[:n])], "x") for k, n in enumerate((6, 12, 20, 27))]
    choice = [(200 + k, [("user", "请说明。"), ("assistant", sentence + "故选C")], "x") for k in range(10)]
    code = [(300, [("user", "请说明。"), ("assistant", "如下：\n```\nx = 1\n")], "x")]
    dots = [(400, [("user", "请说明。"), ("assistant", sentence + "例如")], "x")]
    df = spark.createDataFrame(whole + cut + choice + code + dots, SCHEMA)
    got = {(r.qa_id, r.defect) for r in P.defective_pairs(df).collect()}
    assert got == {(i, "truncated") for i in (100, 101, 102, 103, 300, 400)}


def test_numbers_and_odd_arrays(spark):
    rows = [
        (1, None, "x"),
        (2, [], "x"),
        (3, [("user", "甲是什么？")], "x"),
        (4, [("user", "甲是什么？"), ("assistant", None), None, ("user", None), ("assistant", "乙。")], "x"),
        (4, [("user", "甲是什么？"), ("assistant", None), None, ("user", None), ("assistant", "乙。")], "x"),
        (None, [("assistant", "x"), ("user", "q"), ("user", "q"), ("assistant", "这里写了内容。")], "x"),
        (6, [("user", "长" * 100_000), ("assistant", "好。" * 100_000)], "x"),
    ]
    got = sorted((r.qa_id or 0, r.pair_no, r.defect) for r in P.defective_pairs(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(0, 1, "empty"), (3, 1, "empty"), (4, 1, "empty")]
    assert P.defective_pairs(spark.createDataFrame([], SCHEMA)).count() == 0
