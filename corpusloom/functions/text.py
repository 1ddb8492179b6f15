"""Cleaners and other text functions as Spark columns. All stay inside the JVM; null gives null."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions import patterns as P

def _drop(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, F.lit(pattern), F.lit(""))


def strip(text: Column) -> Column:
    """Without Unicode white space at either end (a wider set than ``trim``)."""
    return F.btrim(text, F.lit(P.STRIP_CHARS))


def letter_count(text: Column) -> Column:
    """Number of Unicode letters."""
    return F.length(_drop(text, P.NOT_LETTER.java)).cast("bigint")


def clean_markdown(text: Column) -> Column:
    """Images, links with their anchor text, and broken images deleted; stripped."""
    cleaned = text
    for p in (P.IMAGE, P.ANCHOR, P.BROKEN_IMAGE):
        cleaned = _drop(cleaned, p.java)
    return strip(F.when(F.contains(text, F.lit("[")), cleaned).otherwise(text))


def clean_email(text: Column) -> Column:
    """Mail addresses deleted; stripped. Texts without an at sign skip the pattern."""
    return strip(F.when(F.contains(text, F.lit("@")), _drop(text, P.EMAIL.java)).otherwise(text))


def clean_links(text: Column) -> Column:
    """Web and ftp links deleted; stripped."""
    return strip(F.when(F.contains(text, F.lit("://")), _drop(text, P.LINK.java)).otherwise(text))


def clean_ipv4(text: Column) -> Column:
    return _drop(text, P.IPV4.java)


def clean_ips(text: Column) -> Column:
    """IPv4, then IPv6 addresses deleted; stripped."""
    # cheap tests first: three dots between digits, two colons side by side or seven groups
    v4 = F.when(text.rlike(r"[0-9]\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]"), _drop(text, P.IPV4.java)).otherwise(text)
    grouped = F.contains(text, F.lit("::")) | (F.contains(text, F.lit(":")) & text.rlike(":(?:[0-9a-fA-F]{1,4}:){6}"))
    return strip(F.when(grouped, _drop(v4, P.IPV6.java)).otherwise(v4))


def clean_control(text: Column) -> Column:
    """Control characters other than line feeds deleted."""
    return _drop(text, P.CONTROL.java)


def clean_spaces(text: Column) -> Column:
    """Runs of spaces, of tabs, and mixed runs become one space, tab and line feed; stripped."""
    for p, to in ((P.SPACES, " "), (P.TABS, "\t")):
        text = F.when(F.contains(text, F.lit(to * 2)), F.regexp_replace(text, F.lit(p.java), F.lit(to))).otherwise(text)
    return strip(F.regexp_replace(text, F.lit(P.MIXED.java), F.lit("\n")))


def clip_to_end_mark(text: Column) -> Column:
    """Text up to its last end mark; empty without one."""
    return F.regexp_extract(text, P.TO_END_MARK.java, 1)


def clean_circled(text: Column) -> Column:
    """Circled digits become ``N.``, other circled contents are deleted."""
    return _drop(F.regexp_replace(text, F.lit(P.CIRCLED_DIGIT.java), F.lit("$1.")), P.CIRCLED.java)


def clean_file_names(text: Column) -> Column:
    return _drop(text, P.FILE_NAME.java)


def clean_symbol_runs(text: Column) -> Column:
    """Runs of eight or more signs deleted, unless a protecting sign follows."""
    return _drop(text, P.SYMBOL_RUN.java)


def clean_html(text: Column) -> Column:
    """Bare tags deleted, name after name.

    One alternation deletes them in a single pass. Only where that leaves a tag (one was
    put together by a deletion) the names are gone through one by one, from the start.
    """
    once = _drop(text, P.HTML.java)
    one_by_one = reduce(lambda t, tag: _drop(t, P.html_tag(tag)), P.HTML_TAGS, text)
    return F.when(once.rlike(P.HTML.java), one_by_one).otherwise(once)


#: Cleaners by option name, in their fixed order.
CLEANERS = {
    "markdown": clean_markdown,
    "email": clean_email,
    "link": clean_links,
    "ip": clean_ips,
    "control_char": clean_control,
    "repeat_space": clean_spaces,
    "punctuation_clip": clip_to_end_mark,
    "text_circled": clean_circled,
    "filename": clean_file_names,
    "repeat_char": clean_symbol_runs,
    "html": clean_html,
}


def truncate(text: Column, width: int) -> Column:
    """The first ``width`` code points."""
    return F.substring(text, 1, width)


def chunks(text: Column, width: int) -> Column:
    """Pieces of ``width`` code points; an empty text has none."""
    n = F.ceil(F.length(text) / width).cast("int")
    return F.when(F.length(text) > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(text, i * width + 1, F.lit(width)))).otherwise(F.array().cast("array<string>"))


def path_id(path: Column) -> Column:
    """Hex SHA-256 of a path."""
    return F.sha2(path, 256)


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)\z", 1)


def extension(path: Column) -> Column:
    """Lower-case suffix with its dot; a name that begins with its only dot has none."""
    return F.lower(F.regexp_extract(base_name(path), r"(?s)[^.].*?(\.[^.]+)\z", 1))


def stem(path: Column) -> Column:
    """Base name without its last suffix."""
    return F.regexp_replace(base_name(path), r"(?s)(?<=[^.])\.[^.]+\z", "")


def parent(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*\z", "")


def human_size(size: Column) -> Column:
    """Bytes in steps of 1024 with two decimals, ties to even."""
    out = None
    for k, unit in enumerate(("B", "KB", "MB", "GB", "TB")):
        value = F.concat(F.bround(size.cast("decimal(38,18)") / F.lit(1024**k).cast("decimal(20,0)"), 2).cast("decimal(38,2)").cast("string"), F.lit(f" {unit}"))
        fits = size < 1024 ** (k + 1)
        out = F.when(fits, value) if out is None else out.when(fits, value) if k < 4 else out.otherwise(value)
    return out


def python_str(value: Column, kind: str) -> Column:
    """A typed value as record queries compare it; null is the empty string."""
    if kind == "boolean":
        value = F.when(value, F.lit("True")).when(~value, F.lit("False"))
    return F.coalesce(value.cast("string"), F.lit(""))


def strip_reasoning(reply: Column) -> Column:
    """A model reply without its reasoning block; null is empty."""
    return _drop(F.coalesce(reply, F.lit("")), P.REASONING.java)


def outer_object(reply: Column) -> Column:
    """From the first opening to the last closing brace; null if that is no JSON object."""
    raw = F.regexp_extract(reply, P.OUTER_OBJECT.java, 1)
    return F.when(F.try_parse_json(raw).isNotNull() & (raw != ""), raw)


def labelled_value(reply: Column, label: str, default: str = "其他") -> Column:
    """Value of the last line ``label：value``."""
    found = F.regexp_extract_all(reply, F.lit(rf"(?m)^[ \t]*{label}：(.*)$"), F.lit(1))
    return F.coalesce(strip(F.try_element_at(found, F.lit(-1))), F.lit(default))


def normalise_keywords(text: Column, nothing: str = "无") -> Column:
    """Items between semicolons, trimmed, without empty ones; the word for nothing passes."""
    items = F.filter(F.transform(F.split(text, ";"), lambda x: strip(x)), lambda x: x != "")
    return F.when(strip(text) == nothing, F.lit(nothing)).otherwise(F.array_join(items, "; "))


def parse_qa_lines(reply: Column) -> Column:
    """Dialogue from lines of JSON objects with ``q`` and ``a``; lines without both are passed over."""
    parsed = F.transform(F.filter(F.split(reply, "\n"), lambda x: strip(x) != ""), lambda x: F.from_json(x, "q string, a string"))
    whole = F.filter(parsed, lambda p: (F.length(strip(p["q"])) > 0) & (F.length(strip(p["a"])) > 0))
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), strip(content).alias("content"))
    return F.flatten(F.transform(whole, lambda p: F.array(turn("user", p["q"]), turn("assistant", p["a"]))))


def approved(reply: Column) -> Column:
    """The reply says the pair is reasonable and does not say it is not."""
    return F.contains(reply, F.lit("合理")) & ~F.contains(reply, F.lit("不合理"))


def fill_prompt(template: str, **values: Column) -> Column:
    """A template with its ``{name}`` places filled."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value, F.lit("")))
    return out


def qa_line(question: Column, answer: Column) -> Column:
    return F.concat(F.lit("Question: "), question, F.lit("\nAnswer: "), answer)


def replace_in_order(text: Column, mapping: Column) -> Column:
    """Every ``(real, fake)`` of an array of structs replaced literally, one after another."""
    return F.aggregate(mapping, text, lambda t, m: F.replace(t, m["real"], m["fake"]))
