import pytest

from corpusloom.llm import markup as M


def families(text):
    return {f for _, _, f, _ in M.marks_of(text)}


@pytest.mark.parametrize(
    "text,want",
    [
        ("<p class='x'>a</p>", {"html"}), ("a<br/>b", {"html"}), ("a &nbsp; b", {"html"}), ("<!-- page 3 -->", {"html"}), ("<pre><code># x **y**</code></pre>", {"html"}),
        ("a **b** c", {"markdown"}), ("在*杠杆*平衡", {"markdown"}), ("```js\n<ul> $x_1$ [[y]]\n```", {"markdown"}), ("| a | b |\n|---|:-:|\n| 1 | 2 |", {"markdown"}), ("[t](http://a.b/c)", {"markdown"}), ("x[^3]", {"markdown"}), ("> quoted", {"markdown"}), ("- item", {"markdown"}), ("Title\n=====\n", {"markdown"}),
        ("== h ==", {"wiki"}), ("a '''b''' c", {"wiki"}), ("[[page|name]]", {"wiki"}), ("{{cite|title=x}}", {"wiki"}), ("{| class=\"wikitable\"\n! a !! b\n|-\n| 1 || 2\n|}", {"wiki"}), ("[http://a.b/c name]", {"wiki"}), (";term\n:its meaning", {"wiki"}),
        ("\\section{x}", {"latex"}), ("$x^{2}+1$", {"latex"}), ("\\begin{itemize}\n\\item a\n\\end{itemize}", {"latex"}), ("\\(a\\in b\\)", {"latex"}), ("误差96\\%", {"latex"}), ("\\begin{equation}\n\\mathrm{H}_{1}\\mathrm{O}_{2}\n\\end{equation}", {"latex"}),
        ("# heading", {"shared"}), ("* item", {"shared"}), ("x\\_1", {"either"}),
    ],
)
def test_marks(text, want):
    assert families(text) == want


@pytest.mark.parametrize(
    "text",
    ["5*3=15与4*6=24", "a<b且c>d", "We know that a<b and c>d in every case.", "costs $5 and a pen costs $2.", "每本定价$5，共买3本。", "C#是一种语言", "room #3.", "names x_1 and x_2 stand", "集合{1,2,3}和参数[2]", "- 43 -", "[128]", "user@domain", "x ** 2; y ** 3", "坐标(1, 2)", "1. only one numbered line", "", "第 3 页"],
)
def test_ordinary_signs(text):
    assert families(text) == set()


def test_alignment():
    a, b = ("m", "#", "n"), ("m", "#", "k", "#", "n")
    w = M.align(a, b)
    assert M.parses(w, a) and M.parses(w, b) and not M.parses(w, ("n", "m"))
    assert M.fold(("a", "#", "a", "#", "a", "#")) == ("(a #)+",)
    many = [tuple("abcdefg"[(i * j) % 7] for j in range(1 + i % 40)) for i in range(40)]
    w = M._infer(many)
    assert len(w) <= M.MAX_WRAPPER + 7 and all(M.parses(w, x) for x in many)


def test_families_by_record(spark):
    rows = [
        ("1", "h", "# a\n# [[b]]"), ("2", "h", "# a\ntext"), ("3", None, "x\\_1 and $a^2$"), ("4", "h", "x\\_1"), ("5", "h", None), ("6", "h", ""), ("7", "h", "plain"), ("1", "h", "# a\n# [[b]]"), ("8", "g", "<b>x</b> **y** '''z''' \\emph{w}"), (None, "g", "<b>x</b>"),
    ]
    df = spark.createDataFrame(rows, "id string, archive_name string, text string")
    got = sorted((r.id or "", r.markup) for r in M.markup_families(df.selectExpr("*", "'x' AS form", "'y' AS opener")).collect())
    assert got == [("", "html"), ("1", "wiki"), ("2", "markdown"), ("3", "latex"), ("4", "markdown"), ("8", "html"), ("8", "latex"), ("8", "markdown"), ("8", "wiki")]
    assert M.markup_families(df.limit(0)).count() == 0


def test_clean_text_keeps_structure():
    assert M.clean_markup("<h2>题</h2>\n<ul><li>a</li><li>b</li></ul>") == "## 题\n\n- a\n- b"
    assert M.clean_markup("a **b** [c](http://d.e) `f`") == "a b c f"
    assert M.clean_markup("== 标题 ==\n'''x''' [[p|q]]") == "## 标题\nx q"
    assert "$x^{2}$" in M.clean_markup("\\section{章}\n$x^{2}$ 为\\textbf{真}，96\\%")
    assert M.clean_markup("\\section{章}\n\\emph{a}") == "# 章\na"
    assert M.clean_markup("```py\nx = '**y**'\n```") == "```\nx = '**y**'\n```"
    assert M.clean_markup("\\begin{align*}\na_1 \\\\\nb_2\n\\end{align*}") == "$$\na_1 \\\\\nb_2\n$$"
    assert M.clean_markup("\\begin{equation}\nx^2\n\\end{equation}") == "$x^2$"
    assert M.clean_markup("5*3=15, a<b, $5") == "5*3=15, a<b, $5"
    assert M.clean_markup("") == ""


def test_shared_marks_follow_the_family():
    assert M.clean_markup("text.\n# [[a]]\n## b\n\nmore ''c''") == "text.\n- a\n  - b\n\nmore c"
    assert M.clean_markup("# a\n## **b**") == "# a\n## b"
    assert M.clean_markup("# a", {"wiki"}) == "- a"


def test_shared_marks_of_records(spark):
    df = spark.createDataFrame([("1", "h", "# [[a]]\n# b"), ("2", "h", "# a\n\n**b**")], "id string, archive_name string, text string")
    assert {r.id: r.clean_text for r in M.clean_records(df).collect()} == {"1": "- a\n- b", "2": "# a\n\nb"}


def test_very_many_marks(spark):
    rows = [("1", "h", "<b>x</b>$a^2$" * 5000), ("2", "h", "".join(f"<{t}>" for t in ("b", "i", "u", "p") * 3000)), ("3", "h", "*" * 50_000), ("4", "h", "```\nopen to the end"), ("5", "h", "[" * 20_000)]
    df = spark.createDataFrame(rows, "id string, archive_name string, text string")
    assert sorted((r.id, r.markup) for r in M.markup_families(df).collect() if r.id != "3") == [("1", "html"), ("1", "latex"), ("2", "html"), ("4", "markdown")]
