"""Patterns of the cleaners, for Spark (Java) and for DuckDB (RE2), kept side by side."""

from __future__ import annotations

from dataclasses import dataclass

# What counts as white space when text is stripped, and inside patterns.
STRIP_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0                　"
_SPACE = r"\t\n\x0b\f\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_WORD = r"\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}"

# HTML tag names whose bare tags are deleted, in order of deletion.
HTML_TAGS = (
    "html head title base link meta style script "
    "body h1 h2 h3 h4 h5 h6 nav header footer "
    "main section article aside p br hr blockquote "
    "pre code a ul ol li dl dt dd table thead "
    "tbody tfoot tr th td caption colgroup col form "
    "input textarea button select option optgroup label "
    "fieldset legend div span img audio video source "
    "track canvas svg math template noscript"
).split()

# File suffixes in order of trial; some carry a dot of their own.
FILE_SUFFIXES = (
    "jpg jpeg png bmp tiff webp svg mp4 avi mov "
    "wmv flv mkv webm mpeg mpg mp3 .wav .aac .flac "
    ".ogg .m4a .wma .alac doc docx pdf txt md rtf "
    "odt csv xls xlsx ods ppt pptx odp zip rar "
    "7z tar gz bz2"
).split()

# Characters a text is cut back to, and signs that protect what stands before them.
END_MARKS = "。！？.?!"
PROTECTING_SIGNS = r"\{}$&%#^_~<>():;@[]-|"


@dataclass(frozen=True)
class Pattern:
    """One pattern in both dialects."""

    java: str
    re2: str


_OCTET = r"(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)"
_HEX = r"[0-9a-fA-F]{1,4}"


def _ipv6_forms() -> list[str]:
    """Full form, trailing gap, then gaps with one to six groups behind, then leading gaps; tried in this order."""
    forms = [rf"(?:{_HEX}:){{7}}{_HEX}", rf"(?:{_HEX}:){{1,7}}:", rf"(?:{_HEX}:){{1,6}}:{_HEX}"]
    forms += [rf"(?:{_HEX}:){{1,{7 - n}}}(?::{_HEX}){{1,{n}}}" for n in range(2, 6)]
    return [*forms, rf"{_HEX}:(?:(?::{_HEX}){{1,6}})", rf":(?:(?::{_HEX}){{1,7}})"]


def _bounded(body: str) -> Pattern:
    """``body`` between word boundaries; RE2 knows only ASCII ones, so there the neighbours are captured."""
    return Pattern(rf"(?U)\b{body}\b", rf"(^|[^{_WORD}])(?:{body})($|[^{_WORD}])")


_LOCAL = r"A-Za-z0-9.\-+_ſ\x{212a}"
_DOMAIN = r"(?:[A-Za-z0-9.\-+_ſ\x{212a}]+\.[A-Za-zſ\x{212a}]+)"
_LINK = rf"[hH][tT][tT][pP][sSſ]?://|[fF][tT][pP]://"
_TARGET = rf"(?:[{_WORD}\-]+(?:\.[{_WORD}\-]+)+|[lL][oO][cC][aA][lL][hH][oO][sSſ][tT]|(?:/[^{_SPACE}]*)?)(?::[0-9]+)?(?:/[^{_SPACE}]*)?"
_NAME = r"a-zA-Z0-9\[\]!@#$%^&*()_<>/?,+\-="
_SUFFIX = "|".join(s.replace(".", r"\.") for s in FILE_SUFFIXES)
_DIGITS = r"\p{Nd}²³¹⁰⁴-⁹₀-₉①-⑨⑴-⑼⒈-⒐⓪⓵-⓽⓿❶-❾➀-➈➊-➒"
_CIRCLED = rf"\$[{_SPACE}]*\\textcircled[{_SPACE}]*\{{[{_SPACE}]*"
_CIRCLED_END = rf"[{_SPACE}]*\}}[{_SPACE}]*\$"

IMAGE = Pattern(rf"!\[[^\n\r]*?\]\((?:[^(){_SPACE}]+)?\)", rf"!\[[^\n\r]*?\]\((?:[^(){_SPACE}]+)?\)")
ANCHOR = Pattern(IMAGE.java[1:], IMAGE.re2[1:])
BROKEN_IMAGE = Pattern(r"!\[[^\n\r]*?\]", r"!\[[^\n\r]*?\]")
# the start of a run, or right behind the last match: long runs without a sign are passed once
EMAIL = Pattern(rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@{_DOMAIN}", rf"[{_LOCAL}]+@{_DOMAIN}")
LINK = Pattern(rf"(?<![{_WORD}])(?:{_LINK}){_TARGET}", rf"(^|[^{_WORD}])(?:{_LINK}){_TARGET}")
IPV4 = _bounded(r"\.".join([_OCTET] * 4))
IPV6 = Pattern("(?U)" + "|".join(rf"\b{f}\b" for f in _ipv6_forms()), "")
CONTROL = Pattern(r"[\x00-\x09\x0b-\x1f\x7f-\x9f]", r"[\x{00}-\x{09}\x{0b}-\x{1f}\x{7f}-\x{9f}]")
SPACES, TABS, MIXED = Pattern(" {2,}", " {2,}"), Pattern("\t{2,}", "\t{2,}"), Pattern("[ \t\n]{2,}", "[ \t\n]{2,}")
TO_END_MARK = Pattern(rf"(?s)^(.*[{END_MARKS}])", rf"(?s)^(.*[{END_MARKS}])")
CIRCLED_DIGIT = Pattern(rf"{_CIRCLED}([{_DIGITS}]+){_CIRCLED_END}", rf"{_CIRCLED}([{_DIGITS}]+){_CIRCLED_END}")
CIRCLED = Pattern(rf"{_CIRCLED}[^}}]*\}}[{_SPACE}]*\$", rf"{_CIRCLED}[^}}]*\}}[{_SPACE}]*\$")
FILE_NAME = Pattern(rf"[{_NAME}]++\.(?:{_SUFFIX})\)?", rf"[{_NAME}]+\.(?:{_SUFFIX})\)?")
_PROTECT = "".join("\\" + c for c in PROTECTING_SIGNS)
SYMBOL = rf"[^\p{{L}}\p{{N}}]"
SYMBOL_RUN = Pattern(rf"(?:{SYMBOL}(?![{_PROTECT}])){{8,}}", "")
PROTECTED = _PROTECT
HTML = Pattern(rf"</?[{_SPACE}]*(?:{'|'.join(HTML_TAGS)})[{_SPACE}]*>", rf"</?[{_SPACE}]*(?:{'|'.join(HTML_TAGS)})[{_SPACE}]*>")
NOT_LETTER = Pattern(r"[^\p{L}]", r"[^\p{L}]")
REASONING = Pattern(r"(?s)<think>.*?</think>", r"(?s)<think>.*?</think>")
OUTER_OBJECT = Pattern(r"(?s)(\{.*\})", r"(?s)(\{.*\})")


def html_tag(tag: str) -> str:
    """One tag's pattern, the same in both dialects."""
    return rf"</?[{_SPACE}]*{tag}[{_SPACE}]*>"
