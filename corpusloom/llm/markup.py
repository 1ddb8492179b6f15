"""Problem 2: markup residue in text: which families a record carries, and clean text.

Method: union-free regular-expression inference. Each block of a record becomes a
stream of tokens: marks (constants) and stretches of text. Streams of one host
(the archive a record came from) that open with the same mark are aligned one
after another. Where two streams differ, differing text becomes a text slot,
a mark that only one has becomes optional, and a stretch that recurs becomes a
repeated group; the union-free expression that results is the host's wrapper for
such blocks. A block's marks are markup where its host's wrapper takes the block
apart. The clean text goes by the marks and the families of the record itself, not
by wrappers; headings, items, cells, code and formulas stay recognisable.

What may be a constant at all is told by the grammars of the four families; they
leave arithmetic, comparisons, prices, page numbers and code contents alone.

Streams are reduced to distinct forms within each task, wrappers are joined in
rounds of bounded fan-in, so a host with a third of all records is never gathered.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Wrappers of one host and opening mark that one task joins at a time.
SALTS = 16
#: Longest wrapper in tokens; a longer one is folded into repeated groups of its marks.
MAX_WRAPPER = 60

# Names of HTML elements.
_HTML_NAMES = (
    "html head title base link meta style script body h1 h2 h3 h4 h5 h6 nav header footer main section article aside p br hr blockquote pre code a ul ol li dl dt dd table thead tbody tfoot tr th td caption "
    "colgroup col form input textarea button select option optgroup label fieldset legend div span img audio video source track canvas svg math template noscript b i u s em strong small big sub sup font center "
    "del ins mark kbd samp var cite q abbr tt strike figure figcaption iframe object embed param ruby rt rp address time details summary map area"
).split()
_ATTRIBUTES = r"(?:\s+[a-zA-Z_:][\w:.-]*\s*=\s*(?:\"[^\"<>]*\"|'[^'<>]*'|[^\s\"'<>=]+))*"
# A formula between dollars: it has a command, an index or an operator, and no two words of prose.
_FORMULA = r"(?![^$]*[A-Za-z]{2,} [a-z]+ [a-z]+)(?=[^$]*(?:\\[a-zA-Z,]|[\^_]|[A-Za-z]\s*[=+<>-]\s*[\w\\(]|[\d)]\s*[=+*/-]\s*[A-Za-z\\(])|\s*[A-Za-z]\s*\$)[^$\n]{1,300}?"

#: (family, kind, pattern); ``shared`` marks belong to markdown or wiki, ``either`` to markdown or latex.
_GRAMMAR = (
    ("markdown", "fence", r"^[ \t]{0,3}(?P<f>```+|~~~+)[^`\n]*(?:\n(?:.*\n)*?[ \t]{0,3}(?P=f)[ \t]*$|(?s:.*)\Z)"),
    ("html", "code", r"(?i:<pre\b[^<>]*>)(?s:.*?)(?i:</pre\s*>)|(?i:<code\b[^<>]*>)(?s:.*?)(?i:</code\s*>)"),
    ("latex", "code", r"\\begin\{(?P<v>verbatim|lstlisting|minted)\*?\}(?s:.*?)\\end\{(?P=v)\*?\}"),
    ("markdown", "inline_code", r"(?P<t>`+)(?!`)[^`\n]+?(?<!`)(?P=t)(?!`)"),
    ("html", "comment", r"<!--(?s:.*?)-->|<!(?i:doctype)[^<>]*>"),
    ("html", "tag", rf"(?i:</?(?:{'|'.join(sorted(_HTML_NAMES, key=len, reverse=True))})(?![\w-]){_ATTRIBUTES}\s*/?>)"),
    ("html", "reference", r"&(?:[a-zA-Z][a-zA-Z0-9]{1,30}|#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6});"),
    ("markdown", "autolink", r"<https?://[^<>\s]+>"),
    ("latex", "display", r"\\begin\{(?P<m>equation|align|gather|math|displaymath|eqnarray|multline)\*?\}(?s:.*?)\\end\{(?P=m)\*?\}"),
    ("latex", "display", r"\$\$(?=[^$]*\S)[^$]{1,2000}?\$\$|\\\[(?s:.{1,2000}?)\\\]|\\\((?s:.{1,600}?)\\\)"),
    ("latex", "formula", rf"(?<![\\$])\$(?!\$){_FORMULA}(?<!\\)\$"),
    ("latex", "environment", r"\\(?:begin|end)\{[a-zA-Z]+\*?\}"),
    ("latex", "item", r"^[ \t]*\\item\b"),
    ("latex", "heading", r"\\(?:part|chapter|(?:sub){0,2}section|(?:sub)?paragraph)\*?\{"),
    ("latex", "command", r"(?<![A-Za-z0-9\\:])\\[a-zA-Z]{2,}\*?|(?<=~)\\[a-zA-Z]+|\\\\[ \t]*$|\\[%&,;]"),
    ("either", "escape", r"\\[_#${}]"),
    ("wiki", "link", r"\[\[[^\[\]\n]+\]\]"),
    ("wiki", "template", r"\{\{[^{}\n]+\}\}"),
    ("wiki", "table", r"^[ \t]*\{\|.*$|^[ \t]*\|\}[ \t]*$"),
    ("wiki", "heading", r"^[ \t]*(?P<h>={2,6})(?!=)[^=\n][^\n]*?(?P=h)[ \t]*$"),
    ("wiki", "emphasis", r"(?<!')(?P<e>'{5}|'{2,3})(?!')[^'\n]+?(?P=e)(?!')"),
    ("wiki", "external", r"(?<!\])\[https?://[^\s\]]+(?:[ \t][^\]\n]*)?\](?!\()"),
    ("wiki", "definition", r"^;[^\n;]+\n:(?=\S)|^;[^\n:;]+ : "),
    ("wiki", "magic", r"__(?:NO)?(?:TOC|EDITSECTION|FORCETOC|INDEX)__|</?nowiki/?>|</?ref(?:\s[^<>]*)?/?>|<references\s*/>"),
    ("markdown", "link", r"!?\[[^\[\]\n]*\]\([^()\s]*(?:\s+(?:\"[^\"\n]*\"|'[^'\n]*'))?\)|(?<=\S)\[[^\[\]\n]+\]\[[^\[\]\n]*\]"),
    ("markdown", "footnote", r"\[\^[\w-]{1,30}\]:?"),
    ("markdown", "reference", r"^[ \t]{0,3}\[[^\[\]\n]+\]:[ \t]+\S+"),
    ("markdown", "table", r"^[ \t]*\|?[ \t]*:?-+:?[ \t]*(?:\|[ \t]*:?-+:?[ \t]*)+\|?[ \t]*$"),
    ("markdown", "strong", r"(?<![*\\])(?P<s>\*{3}|\*{2})(?![\s*])[^*\n]{0,300}?(?<![\s*])(?P=s)(?!\*)|(?<![A-Za-z0-9_\\])(?P<w>___?)(?![\s_])[^_\n]{1,300}?(?<![\s_])(?P=w)(?![A-Za-z0-9_])|(?<!~)~~(?![\s~])[^~\n]{1,300}?(?<!\s)~~(?!~)"),
    ("markdown", "emphasis", r"(?<![A-Za-z0-9*\\])\*(?![\s*\d=])[^*\n]{1,200}?(?<![\s*=])\*(?![*\dA-Za-z])|(?<![A-Za-z0-9_\\}])_(?![\s_\d{])[^_\n]{1,200}?(?<![\s_])_(?![A-Za-z0-9_])"),
    ("shared", "heading", r"^[ \t]{0,3}#{1,6}(?![#\d!])[ \t]*(?=\S)"),
    ("markdown", "underline", r"(?<=\S\n)[ \t]{0,3}(?:={3,}|-{3,})[ \t]*$"),
    ("shared", "rule", r"^[ \t]{0,3}-{4,}[ \t]*$"),
    ("markdown", "rule", r"^[ \t]{0,3}(?:(?:\*[ \t]*){3,}|(?:_[ \t]*){3,}|(?:- ){2,}-|---)[ \t]*$"),
    ("shared", "item", r"^[ \t]*\*{1,4}[ \t]+(?=[^\s*])"),
    ("markdown", "item", r"^[ \t]*[-+][ \t]+(?!\S{1,5}[ \t]*[-–—][ \t]*$)(?![-+=\d.\s]*$)(?=\S)"),
    ("markdown", "number", r"^[ \t]{0,3}\d{1,3}[.)][ \t]+(?=[^\s\d])"),
    ("markdown", "quote", r"^[ \t]{0,3}>(?:[ \t]?>)*[ \t]?(?=[^\s\d=>])"),
)
_INNER = {"f", "v", "m", "t", "h", "e", "s", "w"}
_KINDS = {f"k{n}": (family, kind) for n, (family, kind, _) in enumerate(_GRAMMAR)}


def _alternatives(chars: str | None) -> re.Pattern | None:
    """The patterns that can begin with one of ``chars``; None stands for those of line starts."""
    own = [(n, p) for n, (_, _, p) in enumerate(_GRAMMAR) if (p.startswith("^") or "\\n)[ " in p) == (chars is None)]
    if chars is not None:
        own = [(n, p) for n, p in own if chars in _BEGINS[n]]
    return re.compile("|".join(f"(?P<k{n}>{p})" for n, p in own), re.M) if own else None


# the characters that each inline pattern can begin with
_BEGINS = {n: {"fence": "", "code": "<\\", "inline_code": "`", "comment": "<", "tag": "<", "reference": "&", "autolink": "<", "display": "$\\", "formula": "$", "environment": "\\", "heading": "\\", "command": "\\", "escape": "\\", "template": "{", "magic": "_<", "external": "[", "footnote": "[", "link": "![", "strong": "*_~", "emphasis": "'*_"}.get(kind, "") for n, (_, kind, _) in enumerate(_GRAMMAR)}
_INLINE = {c: _alternatives(c) for c in "<&`$\\{*_~[!'"}
_LINE = _alternatives(None)
#: Where a mark can begin: at the first sign of a line, or at a sign inside one.
_TRIGGER = re.compile(r"(?:\A|\n)(?=[ \t]*(?:[-+*>#;!|=_{`~\\\[]|\d{1,3}[.)]))|[<&`$\\{*_~]|!?\[|''")


def marks_of(text: str) -> list[tuple[int, int, str, str]]:
    """``(start, end, family, kind)`` of all marks, in order."""
    out = []
    at = 0
    search = _TRIGGER.search
    while (t := search(text, at)) is not None:
        here, sign = t.start(), t.group()
        if sign in ("", "\n"):
            m = _LINE.match(text, t.end())
            if m is None:
                # the line's first sign may still begin an inline mark
                m = t = _FIRST.match(text, t.end())
                here, sign = t.start(1), t.group(1)
                if sign not in _INLINE or (sign == "!" and text[here + 1 : here + 2] != "["):
                    at = here + 1 if sign not in "'" else here
                    continue
                m = _INLINE[sign].match(text, here)
        else:
            m = _INLINE[sign[0]].match(text, here)
        if m is None or m.end() == here:
            at = here + 1
            continue
        name = m.lastgroup
        if name in _INNER:
            name = next(k for k, v in m.groupdict().items() if v is not None and k not in _INNER)
        family, kind = _KINDS[name]
        out.append((m.start(), m.end(), family, kind))
        at = max(m.end(), here + 1)
        # a mark that ends with its line lets the next line start
        if at > here and text[at - 1 : at] == "\n":
            at -= 1
    # a single numbered line is no list
    if sum(k == "number" for *_, k in out) == 1:
        out = [x for x in out if x[3] != "number"]
    return out


_FIRST = re.compile(r"[ \t]*(\S)")


def blocks_of(text: str) -> list[tuple[str, tuple[str, ...]]]:
    """Opening mark and token stream of each block (a line, with what its marks span) that has marks.

    Tokens are ``family.kind`` for marks and ``#`` for text.
    """
    out: list[tuple[str, tuple[str, ...]]] = []
    stream: list[str] = []
    last, at = 0, 0
    for start, end, family, kind in marks_of(text):
        between = text[at:start]
        if "\n" in between:
            if stream:
                if text[at : text.index("\n", at)].strip():
                    stream.append("#")
                out.append((next(t for t in stream if t != "#"), tuple(stream)))
            stream = []
            between = between[between.rindex("\n") + 1 :]
        if between.strip():
            stream.append("#")
        stream.append(f"{family}.{kind}")
        at = end
    if stream:
        if text[at:].split("\n", 1)[0].strip():
            stream.append("#")
        out.append((next(t for t in stream if t != "#"), tuple(stream)))
    return out


def fold(stream: tuple[str, ...]) -> tuple[str, ...]:
    """Stretches that recur side by side as one repeated group, shortest first."""
    tokens = list(stream)
    for size in range(1, 5):
        out: list[str] = []
        at = 0
        while at < len(tokens):
            unit = tokens[at : at + size]
            n = 1
            while len(unit) == size and tokens[at + n * size : at + (n + 1) * size] == unit:
                n += 1
            if n > 1 and any(t != "#" for t in unit):
                body = " ".join(t for t in unit)
                out.append(body if size == 1 and body.endswith("+") else f"({body})+".replace("((", "(").replace(")+)+", ")+"))
                at += n * size
            else:
                out += unit[:1]
                at += 1
        tokens = out
    # a block of very many marks is known by its kinds alone
    return tuple(tokens) if len(tokens) <= MAX_WRAPPER else tuple(dict.fromkeys(x for t in tokens for x in t.rstrip("?+").strip("()").split(" ")))


def align(a: tuple[str, ...], b: tuple[str, ...]) -> tuple[str, ...]:
    """The union-free generalisation of two streams or wrappers.

    A longest common subsequence keeps the constants; what only one side has becomes
    optional; side by side optional copies become a repeated group.
    """
    if a == b:
        return a
    bare = [[t.rstrip("?+").strip("()") for t in x] for x in (a, b)]
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if bare[0][i] == bare[1][j] else max(best[i + 1][j], best[i][j + 1])
    out: list[str] = []
    i = j = 0
    while i < n or j < m:
        if i < n and j < m and bare[0][i] == bare[1][j]:
            s, t = a[i], b[j]
            repeated, optional = s.endswith("+") or t.endswith("+"), s.endswith("?") or t.endswith("?")
            out.append(f"({bare[0][i]})+" if repeated and not optional else f"{bare[0][i]}?" if optional and not repeated else f"({bare[0][i]})+?" if repeated else s)
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append(a[i] if a[i].endswith("?") else f"{a[i]}?")
            i += 1
        else:
            out.append(b[j] if b[j].endswith("?") else f"{b[j]}?")
            j += 1
    merged: list[str] = []
    for t in out:
        if merged and merged[-1].rstrip("?+").strip("()") == t.rstrip("?+").strip("()"):
            merged[-1] = f"({t.rstrip('?+').strip('()')})+" + ("?" if t.endswith("?") and merged[-1].endswith("?") else "")
        else:
            merged.append(t)
    if len(merged) > MAX_WRAPPER:
        kinds = list(dict.fromkeys(t.rstrip("?+").strip("()") for t in merged))
        merged = [f"({k})+?" for k in kinds]
    return tuple(merged)


def parses(wrapper: tuple[str, ...], stream: tuple[str, ...]) -> bool:
    """Whether the wrapper takes the folded stream apart (in order, repeated and optional parts allowed)."""
    reach = {0}
    for t in stream:
        token, after = t.rstrip("?+").strip("()"), set()
        for at in reach:
            k = at
            while k < len(wrapper):
                w = wrapper[k]
                if w.rstrip("?+").strip("()") == token:
                    after.add(k if w.rstrip("?").endswith("+") else k + 1)
                    after.add(k + 1)
                if not w.endswith("?"):
                    break
                k += 1
        # a group of all kinds may repeat as a whole
        if not after and all(w.endswith("+?") for w in wrapper):
            after = {k for k, w in enumerate(wrapper) if w.rstrip("?+").strip("()") == token}
        if not after:
            return False
        reach = after
    return True


def _infer(forms: list[tuple[str, ...]]) -> tuple[str, ...]:
    return reduce(align, sorted(set(forms), key=lambda f: (len(f), f)))


def block_forms(df: DataFrame, id_column: str, host_column: str, text_column: str) -> DataFrame:
    """Distinct ``(id, host, opener, form)`` of the blocks with marks of all records."""
    source = df.select(df[id_column].alias("id"), F.coalesce(df[host_column].cast("string"), F.lit("")).alias("host"), df[text_column].alias("t")).where(F.col("t").isNotNull())
    kind = source.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, openers, forms = [], [], []
            for k, text in enumerate(batch.column(2).to_pylist()):
                for opener, form in dict.fromkeys((o, fold(s)) for o, s in blocks_of(text)):
                    at.append(k)
                    openers.append(opener)
                    forms.append("\t".join(form))
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(openers, pa.string()), pa.array(forms, pa.string())], names=["id", "host", "opener", "form"])

    return source.mapInArrow(run, f"id {kind}, host string, opener string, form string")


def infer_wrappers(forms: DataFrame) -> DataFrame:
    """``(host, opener, wrapper)``: one union-free expression per host and opening mark."""

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        wrapper = _infer([tuple(f.split("\t")) for f in pdf["form"]])
        return pd.DataFrame({"host": [pdf["host"].iloc[0]], "opener": [pdf["opener"].iloc[0]], "form": ["\t".join(wrapper)]})

    distinct = forms.select("host", "opener", "form").distinct()
    schema = "host string, opener string, form string"
    part = distinct.groupBy("host", "opener", F.pmod(F.hash("form"), F.lit(SALTS))).applyInPandas(lambda pdf: join(pdf), schema)
    return part.groupBy("host", "opener").applyInPandas(lambda pdf: join(pdf), schema).withColumnRenamed("form", "wrapper")


def markup_families(df: DataFrame, id_column: str = "id", host_column: str = "archive_name", text_column: str = "text") -> DataFrame:
    """Distinct ``(id, markup)``: html, markdown, wiki or latex, for each family with a mark in the text.

    A mark of two families counts for the family of the record's other marks, else for
    markdown. Null and empty texts give no row; a null host is a host of its own; repeated
    rows count once; other columns are not read. One scan; token streams, not texts, are shuffled.
    """
    forms = block_forms(df, id_column, host_column, text_column)
    wrappers = infer_wrappers(forms)
    kind = forms.schema[0].dataType.simpleString()

    def accept(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            known: dict[tuple[str, str], bool] = {}
            rows = []
            for id_, form, wrapper in zip(pdf["id"], pdf["form"], pdf["wrapper"]):
                ok = known.get((form, wrapper))
                if ok is None:
                    ok = known[form, wrapper] = parses(tuple(wrapper.split("\t")), tuple(form.split("\t")))
                if ok:
                    rows += [(id_, f) for f in {t.split(".")[0] for t in re.findall(r"[a-z]+\.[a-z_]+", form)}]
            yield pd.DataFrame(rows, columns=["id", "family"])

    found = forms.join(wrappers, ["host", "opener"]).select("id", "form", "wrapper").mapInPandas(accept, f"id {kind}, family string")
    sets = found.groupBy("id").agg(F.collect_set("family").alias("f"))
    has = lambda x: F.array_contains("f", x)
    markdown = has("markdown") | (has("shared") & ~has("wiki")) | (has("either") & ~has("latex"))
    families = F.array_compact(F.array(*(F.when(has(x), F.lit(x)) for x in ("html", "wiki", "latex")), F.when(markdown, F.lit("markdown"))))
    return sets.select(F.col("id").alias(id_column), F.explode(families).alias("markup"))


_TAG_NAME = re.compile(r"</?\s*([a-zA-Z0-9]+)")
_BLANK_LINES = re.compile(r"\n{3,}")


def _html_tag(tag: str) -> str:
    name = _TAG_NAME.match(tag).group(1).lower()
    closing = tag.startswith("</")
    if name == "br":
        return "\n"
    if name == "li":
        return "" if closing else "\n- "
    if name in ("td", "th"):
        return " | " if closing else ""
    if name[0] == "h" and name[1:].isdigit():
        return "\n" if closing else "\n" + "#" * int(name[1:]) + " "
    if name in ("p", "div", "section", "article", "ul", "ol", "table", "tr", "blockquote", "hr", "dl", "dd", "dt", "thead", "tbody", "caption"):
        return "\n"
    return ""


def clean_markup(text: str, families: set[str] | None = None) -> str:
    """Text without marks; headings, items, tables, code and formulas stay recognisable.

    A mark of two families is read by ``families``, those of the text's own marks if not given:
    lines with ``#`` are items in wiki text, else headings. Headings start with ``#`` signs, items with ``-``, cells are parted by ``|``, code stays
    between lines of three backquotes and formulas between dollars. Everything else is unchanged.
    """
    out, at = [], 0
    in_table = False
    marks = marks_of(text)
    if families is None:
        families = {family for _, _, family, _ in marks}
    for start, end, family, kind in marks:
        out.append(text[at:start])
        mark = text[start:end]
        new = mark
        if kind == "code":
            body = html.unescape(re.sub(r"^(?:\s*<(?:pre|code)\b[^<>]*>|\\begin\{\w+\*?\})+|(?:</(?:pre|code)\s*>\s*|\\end\{\w+\*?\})+$", "", mark, flags=re.I)).strip("\n")
            new = f"\n```\n{body}\n```\n" if "\n" in body or mark.lower().startswith("<pre") else body
        elif kind == "fence":
            new = re.sub(r"^[ \t]*(```+|~~~+)[^\n]*", "```", mark)
            new = re.sub(r"\n[ \t]*(?:```+|~~~+)[ \t]*$", "\n```", new)
        elif kind == "inline_code":
            new = mark.strip("`")
        elif kind == "comment" or kind == "magic":
            new = ""
        elif kind == "tag":
            new = _html_tag(mark)
        elif kind == "reference" and mark.startswith("&"):
            new = html.unescape(mark)
        elif kind == "reference" or kind == "footnote":
            new = ""
        elif kind == "autolink":
            new = mark[1:-1]
        elif kind == "display":
            body = re.sub(r"^\\begin\{\w+\*?\}|\\end\{\w+\*?\}$", "", mark) if mark.startswith("\\begin") else mark[2:-2]
            body = re.sub(r"\s*\\\\\s*\Z", "", body) if "\n" not in body.strip() else body
            new = f"$${body}$$" if "\n" in body.strip() else f"${body.strip()}$"
        elif kind == "environment":
            inner = re.match(r"\\(begin|end)\{([a-zA-Z]+)", mark)
            new = "$" if inner.group(2) in ("equation", "align", "gather", "math", "displaymath", "eqnarray") else ""
        elif kind == "heading" and mark.startswith("\\"):
            new = "# \x00"
        elif kind == "heading" and "=" in mark:
            level = len(mark.strip()) - len(mark.strip().lstrip("="))
            new = "#" * level + " " + mark.strip().strip("=").strip()
        elif kind == "heading" and family == "shared" and "wiki" in families:
            # signs beyond the first are deeper levels
            new = "  " * (mark.strip().count("#") - 1) + "- "
        elif kind == "heading":
            new = mark.strip() + " "
        elif kind == "command":
            new = mark[1:] if mark in ("\\%", "\\&") else "\n" if mark.startswith("\\\\") else "" if mark in ("\\,", "\\;") else "\x00" if text[end : end + 1] == "{" else " " if mark == "\\quad" else ""
        elif kind == "escape":
            new = mark[1:]
        elif kind == "link" and mark.startswith("[["):
            new = mark[2:-2].split("|")[-1]
        elif kind == "link":
            new = re.match(r"!?\[([^\]]*)\]", mark).group(1)
        elif kind == "external":
            new = mark[1:-1].partition(" ")[2]
        elif kind == "template":
            new = mark[2:-2].split("|")[-1].split("=")[-1]
        elif kind in ("strong", "emphasis"):
            new = mark.strip("*_~'") if kind != "emphasis" or not mark.startswith("'") else mark.strip("'")
        elif kind == "definition":
            new = mark.replace("\n:", ": ")[1:] if "\n" in mark else mark[1:]
        elif kind == "item":
            new = "- "
        elif kind == "number":
            new = mark.lstrip()
        elif kind in ("rule", "underline", "quote"):
            new = ""
        elif kind == "table":
            in_table = mark.lstrip().startswith("{|")
            new = "" if "{|" in mark or "|}" in mark else mark
        out.append(new)
        at = end
    out.append(text[at:])
    text = "".join(out)
    # the braces of a command's argument go with the command
    while True:
        new = re.sub(r"\x00\{?([^{}\x00]*)\}", r"\1", text, count=0)
        if new == text:
            break
        text = new
    text = text.replace("\x00", "")
    if in_table or "|-" in text:
        text = re.sub(r"^\|-[^\n]*\n?", "", text, flags=re.M)
        text = re.sub(r"^!\s*(.*)$", lambda m: m.group(1).replace("!!", "|"), text, flags=re.M)
        text = text.replace("||", "|")
    return _BLANK_LINES.sub("\n\n", text).strip("\n")


def clean_records(df: DataFrame, id_column: str = "id", host_column: str = "archive_name", text_column: str = "text") -> DataFrame:
    """One row per row with a text: the id, clean_text, and the number of marks taken out.

    Null texts have no row, empty ones stay empty; repeated rows stay repeated; other columns
    are not read. Map-only.
    """
    source = df.select(df[id_column], df[text_column].alias("__text")).where(F.col("__text").isNotNull())
    kind = source.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([clean_markup(t) for t in texts], pa.string()), pa.array([len(marks_of(t)) for t in texts], pa.int32())], names=[id_column, "clean_text", "marks"]
            )

    return source.mapInArrow(run, f"`{id_column}` {kind}, clean_text string, marks int")
