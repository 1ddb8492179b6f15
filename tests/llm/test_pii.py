import pytest

from corpusloom.llm import pii


def found(text, kind):
    return {text[a:b] for a, b, k, p in pii.structured(text) if k == kind and p > 0.5}


@pytest.mark.parametrize(
    "text,kind,want",
    [
        ("邮箱：luo.xs05@edu.example.net，请", "email", "luo.xs05@edu.example.net"), ("写信至wx_lin66＠mail.songling.example。", "email", "wx_lin66＠mail.songling.example"), ("发到line33(at)example(dot)org。", "email", "line33(at)example(dot)org"),
        ("to luo.xs58 [at] example [dot] org.", "email", "luo.xs58 [at] example [dot] org"), ("我的邮箱是luo艾特harrow-academy点example 好", "email", "luo艾特harrow-academy点example"), ("my mail is tz at songling dot example the girl", "email", "tz at songling dot example"),
        ("电话：（0571）83070990，", "phone", "（0571）83070990"), ("拨打+86 18071787598咨询", "phone", "+86 18071787598"), ("call (258) 555-0120 now", "phone", "(258) 555-0120"), ("打幺三八七二零六三二九三找我", "phone", "幺三八七二零六三二九三"), ("on five five five zero one six nine any", "phone", "five five five zero one six nine"), ("，１８８０２９２２０６０，", "phone", "１８８０２９２２０６０"), ("ring 01632 960285.", "phone", "01632 960285"),
        ("身份证号为119975199311033198，", "id_number", "119975199311033198"), ("编号E29010274已", "id_number", "E29010274"), ("号QQ 05 70 10 A okay", "id_number", "QQ 05 70 10 A"), ("G519967196301043780，请", "id_number", "G519967196301043780"), ("card is 987-65-4306 okay", "id_number", "987-65-4306"), ("码三幺九九二七幺九八二幺零幺四零四零四别", "id_number", "三幺九九二七幺九八二幺零幺四零四零四"),
        ("家庭住址是松溪市竹岭区松岭路209号2栋241室。", "address", "松溪市竹岭区松岭路209号2栋241室"), ("家住临川湾区松岭路十二号的同学", "address", "临川湾区松岭路十二号"), ("lives at 286 Winterholt Avenue, Mossaby and can", "address", "286 Winterholt Avenue, Mossaby"), ("meet at forty eight St Ebba's Terrace tomorrow", "address", "forty eight St Ebba's Terrace"), ("to Flat 25, 126 Tarnside Road, every", "address", "Flat 25, 126 Tarnside Road"),
    ],
)
def test_forms(text, kind, want):
    assert want in found(text, kind)


@pytest.mark.parametrize("text", ["样品编号310199202113450127只用于登记。", "书号978-0-00-73156-2仅供参考", "Sample no. 4471-0098-9512 was", "程序版本为10.2.14.3，", "圆周率取3.14159265358979。", "user@domain on", "用户名@域名", "@全体成员", "The l@st ch@nge. These", "1999-2003年"])
def test_look_alikes(text):
    assert not any(found(text, k) for k in pii.PLACEHOLDERS)


def corpus():
    people = ["俞思星", "蒋越听", "欧阳安予", "卞砚遥", "贺野秋", "颜星知"]
    rows = [("md_info", f"z{k}", f"联系人：{p}，请提前预约。这份材料由{p}老师整理。小红和妈妈看见了小兔子。样品编号310199202113450127只用于登记。") for k, p in enumerate(people)]
    names = ["Corwin Kestrelby", "Petra Brandreth", "Saskia Lindqvarn", "Theron Fairlamb"]
    rows += [("md_info", f"e{k}", f"Teacher: {n}. Contact {n} (a{k}@b.example) or ring 01632 96028{k}. The Sound Waves Workbook.") for k, n in enumerate(names)]
    rows += [("all_transcripts", "t1", "um ask petra kestrelby or call five five five zero one six nine the rabbit ran home"), ("all_transcripts", "t2", None), ("md_info", "n", ""), ("md_info", "z0", rows[0][2])]
    return rows


def test_people_by_patterns(spark):
    texts = spark.createDataFrame(corpus(), "tbl string, id string, text string")
    items = pii.personal_items(texts)
    people = {(r.id, r.pii_text) for r in items.where("kind = 'person'").collect()}
    assert {("z0", "俞思星"), ("z2", "欧阳安予"), ("e1", "Petra Brandreth"), ("t1", "petra kestrelby")} <= people
    assert not any("小" in p or "Sound" in p for _, p in people)
    redacted = {r.id: r.redacted for r in pii.redact(texts.dropDuplicates(["tbl", "id"]), items).collect()}
    assert redacted["z0"].startswith("联系人：[PERSON]，请提前预约。这份材料由[PERSON]老师整理。小红")
    assert redacted["t1"] == "um ask [PERSON] or call [PHONE] the rabbit ran home"
    assert redacted["t2"] is None and redacted["n"] == ""


def grown(times):
    """The corpus with ``times`` as many people, each met once, and a look-alike that stands now and then in their best context."""
    family, given = "俞蒋卞贺颜骆", "星听予遥秋知"
    people = [f"{family[k % 6]}{given[k // 6 % 6]}{given[k // 36 % 6]}" for k in range(20 * times)]
    rows = [("md_info", f"p{k}", f"联系人：{p}，请提前预约。下午联系{p}老师整理。") for k, p in enumerate(people)]
    rows += [("md_info", f"w{k}", f"{a}那么老师就讲下一题。") for k, a in enumerate(["下午联系", "按这个方法", "先看答案", "要是一样", "会了，", "有问题"] * 5)]
    return people, rows


@pytest.mark.parametrize("times", [1, 10])
def test_look_alikes_stay_out_however_large_the_corpus(spark, times):
    people, rows = grown(times)
    got = {r.pii_text for r in pii.personal_items(spark.createDataFrame(rows, "tbl string, id string, text string")).collect()}
    assert got == set(people)


def test_empty_table(spark):
    texts = spark.createDataFrame([], "tbl string, id string, text string")
    assert pii.personal_items(texts).count() == 0


def test_very_long_texts(spark):
    rows = [("md_info", str(k), t) for k, t in enumerate(["a" * 100_000 + "@", "1" * 100_000, "王" * 50_000 + "号", "five " * 20_000, "Aa " * 20_000])]
    items = pii.personal_items(spark.createDataFrame(rows, "tbl string, id string, text string"))
    assert items.where("kind IN ('email', 'id_number')").count() == 0
