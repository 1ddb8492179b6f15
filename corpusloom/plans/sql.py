"""Pieces of SQL for DuckDB that mirror the column functions."""

from __future__ import annotations

from corpusloom.functions import patterns as P


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def drop(x: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {lit(to)}, 'g')"


def strip(x: str) -> str:
    codes = "||".join(f"chr({ord(c)})" for c in P.STRIP_CHARS)
    return f"trim({x}, {codes})"


def letter_count(x: str) -> str:
    return f"length({drop(x, P.NOT_LETTER.re2)})"


def clean_markdown(x: str) -> str:
    for p in (P.IMAGE, P.ANCHOR, P.BROKEN_IMAGE):
        x = drop(x, p.re2)
    return strip(x)


def clean_email(x: str) -> str:
    return strip(drop(x, P.EMAIL.re2))


def clean_links(x: str) -> str:
    return strip(drop(x, P.LINK.re2, r"\1"))


def clean_ipv4(x: str) -> str:
    return drop(x, P.IPV4.re2, r"\1\2")


def clean_control(x: str) -> str:
    return drop(x, P.CONTROL.re2)


def clean_spaces(x: str) -> str:
    for p, to in ((P.SPACES, " "), (P.TABS, "\t"), (P.MIXED, "\n")):
        x = drop(x, p.re2, to)
    return strip(x)


def clip_to_end_mark(x: str) -> str:
    return f"regexp_extract({x}, {lit(P.TO_END_MARK.re2)}, 1)"


def clean_circled(x: str) -> str:
    return drop(drop(x, P.CIRCLED_DIGIT.re2, r"\1."), P.CIRCLED.re2)


def clean_file_names(x: str) -> str:
    return drop(x, P.FILE_NAME.re2)


def clean_symbol_runs(x: str) -> str:
    """RE2 cannot look ahead: every sign is tagged, tags before a protecting sign go (twice, as matches overlap), then runs of tagged signs."""
    tagged = f"regexp_replace({x}, {lit('(' + P.SYMBOL + ')')}, chr(1) || '\\1', 'g')"
    for _ in range(2):
        tagged = drop(tagged, rf"(?s)\x01([^\x01])(\x01?[{P.PROTECTED}])", r"\1\2")
    return f"replace(regexp_replace({tagged}, '(?s)(\\x01.){{8,}}', '', 'g'), chr(1), '')"


def clean_html(x: str) -> str:
    for tag in P.HTML_TAGS:
        x = drop(x, P.html_tag(tag))
    return x


def base_name(x: str) -> str:
    return f"regexp_extract({x}, '([^/]*)$', 1)"


def extension(x: str) -> str:
    return f"lower(regexp_extract({base_name(x)}, '(?s)[^.].*?(\\.[^.]+)$', 1))"


def human_size(x: str) -> str:
    """Two decimals with ties to even, by integer arithmetic in hundredths."""
    parts = []
    for k, unit in enumerate(("B", "KB", "MB", "GB", "TB")):
        d = 1024**k
        floor = f"(({x}::HUGEINT * 100) // {d})"
        rest = f"(({x}::HUGEINT * 100) % {d})"
        up = f"CASE WHEN {rest} * 2 > {d} OR ({rest} * 2 = {d} AND {floor} % 2 = 1) THEN 1 ELSE 0 END"
        number = f"({floor} + {up})"
        shown = f"({number} // 100)::VARCHAR || '.' || lpad(({number} % 100)::VARCHAR, 2, '0') || ' {unit}'"
        parts.append(f"WHEN {x} < {1024 ** (k + 1)} THEN {shown}" if k < 4 else f"WHEN {x} IS NOT NULL THEN {shown}")
    return "CASE " + " ".join(parts) + " END"


def in_list(words) -> str:
    return "(" + ", ".join(lit(w) for w in words) + ")"
