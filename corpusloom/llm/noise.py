"""Problem 1: noise of scanned pages, found line by line and repaired.

Method. Words are counted over the whole corpus. A rare word is linked to frequent
neighbours that plausible glyph edits turn it into (a key that confusable glyphs
share, plus expansions of glyphs that stand for two). Skip-gram vectors decide in
context: the vector of a word sums signed random projections of the words around
it, weighted by their rarity (the closed form of skip-gram training factorises
the same counts), and an occurrence is a misreading if its surroundings agree with
the vector of the frequent word. Where words are not parted by spaces, the word is
a character with its neighbours: the rare triple is linked to the frequent triple
in which a confusable character stands instead.

Furniture is told by layout: page numbers by their form and by counting on from
page to page, running titles by recurring between pages or next to a page break.
A line-end hyphen splits a word if the joined word is met in the corpus more often
than the compound. The repaired text drops furniture, joins split words, corrects
misread ones and reflows lines into paragraphs.

All counts cover all documents. Words and contexts to look up are announced by bit
maps of fixed size and joined exactly; no vocabulary passes through the driver.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.runtime import cut_lineage, union_all

MAP_BITS = 22
VECTOR = 32
#: A frequent neighbour must be met this many times as often as the rare word, and this often at all.
RATIO, FREQUENT = 10, 5
#: For characters in context, which scans misread in the same way again and again.
RATIO_CHARACTERS = 4
#: Least agreement of an occurrence with the frequent word's vector at the least odds.
AGREEMENT = 0.05

# Glyphs that are taken for one another, one class a group; the first stands for all.
_CLASSES = ("ce", "o0", "a@", "li1!|", "s5", "tfſ", "hb", "g9")
# Glyph runs that are read as one another (as read, as printed).
_RUNS = (("ii", "u"), ("rn", "m"), ("m", "in"), ("m", "rn"), ("cl", "d"), ("vv", "w"), ("h", "li"), ("li", "h"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ni", "m"), ("ri", "n"))
# Chinese characters as read and as printed.
_READ = (
    "己已 犬大 村材 朋明 明朋 比化 现规 次欢 万方 找我 拢找 呆果 仵件 椐据 稈程 埋理 冋同 冗究 硏研 佔估 彭影 庇应 吋时 恃持 囗口 囚因 帅师 曰日 髙高 朿束 旱早 字学 折析 现观 比此 买实 拼并 未末 末未 土士 士土 人入 入人 天夭 干千 千干 牛午 午牛 "
    "贝见 王玉 由田 甲由 木本 本木 术木 鸟乌 乌鸟 刀力 力刀 白自 自白 目日 日目 间问 问间 住往 往住 休体 体休 今令 令今 侯候 候侯 拔拨 拨拔 晴睛 睛晴 请清 清请 处外 各名 名各 免兔 遣遗 遗遣 治冶 冶治 准谁 具真 厉历 幼幻 凤风 杨扬 "
    "场扬 枪抢 抢枪 转传 传转 域城 城域 惑感 栽裁 根很 很根 太大 大太 丸九 九丸 儿几 几儿 厂广 巳已 夫失 失夫 申由 且目 洒酒 茶荼 壬王 采来 来采 亳毫 茄茹 祟崇 戊成 戍成 析折 弟第 竟竞 竞竟 暧暖 段假 徽微 微徽 汨汩 籍藉 "
    "赢嬴 脑恼 底低 低底 代伐 侍待 待侍 钓钩 卯卵 孤狐 沽活 估佑 彼波 披被 复夏 夏复 旦且 刺剌 壮状 状壮 便使 使便 晓哓 淮准 胀涨 胜性 性姓 特持 持特 提堤 摸模 模摸 稍梢 植值 值植 铃玲 洁浩 贷货 货贷 帐账 诉拆 拆折 炎灸 抓爪 挡档"
).split()
_PAIRS = ("白勺的", "力口加", "禾口和", "女子好", "木目相", "日月明", "木木林", "王见现", "文寸对", "又寸对", "门日间", "车专转", "讠兑说", "木几机", "禾中种", "糸工红", "土也地")
_ZH_READ: dict[str, str] = {}
for _a, _b in (x for x in _READ):
    _ZH_READ[_a] = _ZH_READ.get(_a, "") + _b
_ZH_TWO = {x[:2]: x[2] for x in _PAIRS}
_SUSPECT = re.compile("|".join(_ZH_TWO) + "|[" + "".join(_ZH_READ) + "丶丨]")

_NUM = r"[0-9lIOo|]{1,4}"
_ROMAN = r"[ivxlcIVXLC]{1,7}"
_ZH_NUM = r"[零〇一二三四五六七八九十百]{1,6}"
_PAGE_MARKED = re.compile(
    rf"第\s*(?:{_NUM}|{_ZH_NUM})\s*页(?:\s*[,，/]?\s*共\s*(?:{_NUM}|{_ZH_NUM})\s*页)?|共\s*{_NUM}\s*页\s*第\s*{_NUM}\s*页|[-–—~·•.]{{1,2}}\s*(?:{_NUM}|{_ROMAN})\s*[-–—~·•.]{{1,2}}"
    rf"|{_NUM}\s*/\s*{_NUM}|[〔【\[（(<《|]\s*(?:{_NUM}|{_ROMAN})\s*[〕】\]）)>》|]|[pP]\s?[.．]?\s*{_NUM}|[pP][a@]g[ec]\s*{_NUM}(?:\s*of\s*{_NUM})?|页\s*{_NUM}",
)
_PAGE_BARE = re.compile(rf"(?:{_NUM}|{_ROMAN})")
_DIGITS = str.maketrans("lIO|o", "11010")
_PRINTED_DIGITS = str.maketrans("lIOoZSbq", "11002569")
_STRUCTURE = re.compile(r"^\s*(?:[#>|*+\\<`~={!;:$]|-\s|\d{1,3}[.、)](?!\d)|[（(]\d{1,3}[)）]|\[\^)")
_END_SIGNS = frozenset("。！？.!?：:；;”」』）)】…")
_WIDE_RUN = re.compile("[⺀-鿿豈-﫿＀-｠]+")
_WIDE = re.compile("[⺀-鿿豈-﫿＀-｠]")
_LETTERS = re.compile(r"[^\W\d_]")
_THREE = re.compile("[A-Za-z]{3}")
_ANY_WIDE = re.compile("[一-鿿]{2}")
_TOKEN = re.compile(r"[a-zſﬁﬂ0-9@]+(?:[!|]+[a-zſﬁﬂ0-9@]+)*")
_WORD_AT_END = re.compile(r"(?<![A-Za-zſﬁﬂ0-9@!|])((?=[0-9!|]*[A-Za-zſﬁﬂ@])[A-Za-zſﬁﬂ0-9@!|]+(?:[-‐][A-Za-z]+)*)([-‐¬\xad])$")
#: Longest word; a longer run of letters is data, not spelling.
LONGEST_WORD = 48
_HYPHENS = frozenset("-‐¬\xad")
_WORD_AT_START = re.compile(r"\s*([a-zſﬁﬂ0-9@!|]*[a-zſﬁﬂ@!][a-zſﬁﬂ0-9@!|]*)")
_NEAR_DIGIT = re.compile("[0-9.][lOZSbq]|[lOZSbq][0-9]")
#: Signs that sentences have and titles have not.
_PROSE = re.compile("[，。！？；、“”（）,.;!?%＝=]|^[\u3000 ]{2,}")
_NUMBER_MISREAD = re.compile(r"(?<![A-Za-z0-9_.])(?:\d+[lO][\dlO]*|[lO][lO]?\d[\dlO]*)(?:\.\d+)?(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])\d+\.[\dlO]*[lO][\dlO]*(?![A-Za-z0-9_])|(?<![A-Za-z0-9_.-])\d{1,3}(?:\.\d*)?[ZSbq](?![A-Za-z0-9_-])|(?<![A-Za-z0-9_.-])[ZSbq]\d{1,3}(?:\.\d+)?(?![A-Za-z0-9_-])")


def width(line: str) -> int:
    return len(line) if line.isascii() else len(line) + sum(map(len, _WIDE_RUN.findall(line)))


def ended(line: str) -> bool:
    """The line ends with a sentence or an announcement."""
    return line.rstrip()[-1:] in _END_SIGNS


def is_scanned(lines: list[str]) -> bool:
    """Whether sentences run over line ends, as they do on a page."""
    broken = whole = 0
    for a, b in zip(lines, lines[1:]):
        if len(a) < 12 or _STRUCTURE.match(a):
            continue
        if b.strip() and not ended(a) and not _STRUCTURE.match(b):
            broken += 1
        elif len(a) > 90 and width(a) > 110:
            whole += 1
    return broken >= 2 and broken > 2 * whole or broken == 1 and whole == 0 and len(lines) >= 3 and len(lines[0]) < 60


def _page_value(text: str) -> int | None:
    digits = re.findall(r"[0-9lIOo|]+", text)
    s = digits[0].translate(_DIGITS) if digits else ""
    return int(s) if s.isdigit() else None


_ROMAN_VALUES = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}


def _roman_value(text: str) -> int | None:
    total = 0
    s = text.lower()
    for a, b in zip(s, s[1:] + " "):
        v = _ROMAN_VALUES.get(a)
        if v is None:
            return None
        total += -v if _ROMAN_VALUES.get(b, 0) > v else v
    return total


def _title_key(line: str) -> str:
    """Letters of a possible running title, with confusable glyphs as one."""
    s = re.sub(r"^\s*[0-9lIOo|]{1,4}(?=\s{2,})|(?<=\s{2})[0-9lIOo|]{1,4}\s*$", "", line)
    return skeleton("".join(_LETTERS.findall(s)).lower())


def _is_title(key: str) -> bool:
    wide = len(_WIDE.findall(key))
    return wide >= 4 or len(key) - wide >= 9


def _alike(a: str, b: str) -> bool:
    """Whether two titles differ in a few glyphs only."""
    if abs(len(a) - len(b)) > 3:
        return False
    if len(a) == len(b):
        return 4 * sum(x != y for x, y in zip(a, b)) <= len(a)
    x, y = {a[i : i + 2] for i in range(len(a) - 1)}, {b[i : i + 2] for i in range(len(b) - 1)}
    return 2 * len(x & y) >= max(len(x), len(y))


def _in_step(known: list[int], more: list[int]) -> bool:
    """Whether lines recur at page distance among known titles: all steps are about one page or whole pages."""
    at = sorted(known + more)
    steps = [b - a for a, b in zip(at, at[1:])]
    apart = sorted(b - a for a, b in zip(known, known[1:]))
    page = min(steps)
    if page < 8 or page < 0.3 * apart[len(apart) // 2]:
        return False
    return all(abs(step - round(step / page) * page) <= max(2.0, 0.12 * page) * round(step / page) for step in steps)


def layout(text: str) -> tuple[list[str], dict[int, str]] | None:
    """Lines and the furniture among them (index: ``page_no`` or ``header``); None if not scanned."""
    lines = text.split("\n")
    if not is_scanned(lines):
        return None
    noise: dict[int, str] = {}
    marked, bare = [], []
    full = sorted(width(x) for x in lines if len(x) > 8)
    span = full[int(0.9 * (len(full) - 1))] if full else 40
    for k, line in enumerate(lines):
        s = line.strip()
        if not s or len(s) > 24:
            continue
        if _PAGE_MARKED.fullmatch(s):
            marked.append(k)
        elif _PAGE_BARE.fullmatch(s):
            bare.append(k)
    # titles: short lines without an end mark that recur, also misread or with a page number
    short = []
    for k, line in enumerate(lines):
        s = line.strip()
        if s and len(s) <= 70 and not _PROSE.search(s) and width(s) <= 0.85 * span + 6 and k not in marked and k not in bare and s[-1] not in "：:-‐¬\xad":
            key = _title_key(s)
            if _is_title(key):
                short.append((k, key))
    groups: list[tuple[str, list[int]]] = []
    for k, key in short:
        for known, members in groups:
            if known == key or _alike(known, key):
                members.append(k)
                break
        else:
            groups.append((key, [k]))
    best = max((g for g in groups), key=lambda g: (len(g[1]), -g[1][0]), default=None)
    headers: list[int] = []
    if best and len(best[1]) >= 2:
        headers = list(best[1])
        # pages may bear titles in turn: further groups that fall into the step of the pages
        for _, members in sorted((g for g in groups if g is not best and len(g[1]) >= 2), key=lambda g: (-len(g[1]), g[1][0])):
            if 2 * len(members) + 1 >= len(best[1]) and _in_step(headers, members):
                headers = sorted(headers + members)
    # decorated page numbers: the record's commonest form; forms met once may be list numbers
    forms = Counter(re.sub(r"[0-9lIOo|]+", "0", lines[k].strip()) for k in marked)
    if forms:
        form = forms.most_common(1)[0][0]
        square = [k for k in marked if re.sub(r"[0-9lIOo|]+", "0", lines[k].strip()) == form or "页" in lines[k] or "age" in lines[k]]
        for k in square:
            noise[k] = "page_no"
    if not noise and bare:
        values = []
        for k in bare:
            s = lines[k].strip()
            v = _page_value(s) if re.search(r"\d", s) else _roman_value(s)
            if v is not None:
                values.append((k, v))
        # the longest run that counts on from page to page
        chain: dict[int, list[int]] = {}
        for i, (k, v) in enumerate(values):
            before = [chain[j] for j in range(i) if v - values[j][1] == 1 and k - values[j][0] >= 4 and j in chain]
            chain[i] = [*max(before, key=len, default=[]), k]
        run = max(chain.values(), key=len, default=[])
        # a number that parts a sentence is no datum
        filled = [k for k, line in enumerate(lines) if line.strip()]
        place = {k: i for i, k in enumerate(filled)}
        apart = []
        for k, _ in values:
            i = place[k]
            if 0 < i < len(filled) - 1:
                above, below = lines[filled[i - 1]].strip(), lines[filled[i + 1]].strip()
                if width(above) >= 0.7 * span and not ended(above) and not _PAGE_BARE.fullmatch(below) and filled[i - 1] not in {h for h, _ in short if h in headers}:
                    apart.append(k)
        if len(run) >= 2 or apart:
            for k in {*(run if len(run) >= 2 else ()), *apart}:
                noise[k] = "page_no"
        else:
            filled = [k for k, line in enumerate(lines) if line.strip()]
            single = {k for k, _ in values}
            for k, _ in values:
                at = filled.index(k)
                near = {*filled[max(0, at - 1) : at], *filled[at + 1 : at + 2]} & single
                last = at == len(filled) - 1
                beside = any(h in (filled[at + 1 : at + 2] + filled[max(0, at - 1) : at]) for h in headers)
                roman = not re.search(r"\d", lines[k])
                if not near and (last or at == 0 or beside or roman) and len(values) <= 3:
                    noise[k] = "page_no"
                    break
    if not headers:
        # a title met once stands first, or beside a page number at a page break
        filled = [k for k, line in enumerate(lines) if line.strip()]
        titles = {k for k, _ in short}
        first = filled[0] if filled else -1
        if filled and noise.get(first) == "page_no" and len(filled) > 1:
            first = filled[1]
        if first in titles and width(lines[first].strip()) <= 0.7 * span + 8:
            headers = [first]
    # pages may bear two titles in turn: what stands next to a page number where a sentence runs on
    filled = [k for k, line in enumerate(lines) if line.strip()]
    titles = {k for k, _ in short}
    for at, k in enumerate(filled[:-1]):
        if noise.get(k) == "page_no" and filled[at + 1] in titles and at and width(lines[filled[at + 1]].strip()) <= 0.7 * span + 8:
            headers.append(filled[at + 1])
    for k in headers:
        # a line as wide as the body must stand at a page's edge or bear its number
        at = filled.index(k)
        edge = at == 0 or noise.get(filled[at - 1]) == "page_no" or noise.get(filled[at + 1] if at + 1 < len(filled) else -1) == "page_no"
        if width(lines[k].strip()) <= 0.72 * span or edge or re.search(r"^\s*[0-9lIOo|]{1,4}\s{2,}|\s{2,}[0-9lIOo|]{1,4}\s*$", lines[k]):
            noise.setdefault(k, "header")
    return lines, noise


def skeleton(word: str) -> str:
    """A word with confusable glyphs as one."""
    return word.translate(_SKELETON)


_SKELETON = str.maketrans({c: group[0] for group in _CLASSES for c in group[1:]})


def expansions(word: str) -> list[str]:
    """The word as read and with up to two glyph runs undone."""
    out = {word}
    for _ in range(2):
        more = set()
        for w in out:
            for read, printed in _RUNS:
                at = w.find(read)
                while at >= 0:
                    more.add(w[:at] + printed + w[at + len(read) :])
                    at = w.find(read, at + 1)
        out |= more
        if len(out) > 60:
            break
    return list(out)


def tokens_of(text: str) -> list[str]:
    """Words in lower case; signs count as glyphs only inside a word."""
    return [w for w in _TOKEN.findall(text.lower()) if not w.isdecimal()] if _THREE.search(text) else []


def word_at_end(line: str) -> tuple[int, str, str] | None:
    """Start, word and mark of what a line breaks off with; only the last word is looked at."""
    s = line.rstrip()
    if s[-1:] not in _HYPHENS:
        return None
    low = max(0, len(s) - 2 * LONGEST_WORD)
    m = _WORD_AT_END.search(s, low)
    return (m.start(), m.group(1), m.group(2)) if m else None


def body_words(lines: list[str], noise: dict[int, str]) -> Iterator[tuple[int, str]]:
    """``(line index, word)`` of the body; a word split at a line end comes whole, once for each of its lines."""
    body = [k for k, line in enumerate(lines) if k not in noise and line.strip()]
    if not any(_THREE.search(lines[k]) for k in body):
        return
    carried: dict[int, str] = {}
    for k, after in zip(body, [*body[1:], None]):
        line = lines[k]
        if k in carried:
            line = _WORD_AT_START.sub(" ", line, count=1)
        end = word_at_end(line)
        start = _WORD_AT_START.match(lines[after]) if end and after is not None else None
        if end and start:
            whole = (end[1] + start.group(1)).lower()
            yield k, whole
            carried[after] = whole
            line = line[: end[0]]
        for w in tokens_of(line):
            yield k, w


def _bit(word: str) -> int:
    return zlib.crc32(word.encode()) >> (32 - MAP_BITS)


def _first_printed(m: re.Match) -> str:
    return _ZH_TWO.get(m.group()) or _ZH_READ.get(m.group(), m.group())[0]


def _contexts_zh(s: str, at: int, size: int) -> tuple[list[str], list[list[str]]]:
    """Contexts of the ``size`` characters at ``at`` as read, and the same as each printed form would give.

    Windows of three characters that hold the place, for a pair also those of two; where
    a neighbour is suspect itself, once more with the neighbours as they may be printed.
    """
    read = s[at : at + size]
    printed = _ZH_TWO[read] if size == 2 else _ZH_READ[read]
    left, right = s[max(0, at - 2) : at], s[at + size : at + size + 2]
    sides = [(left, right)]
    other = (_SUSPECT.sub(_first_printed, s[max(0, at - 3) : at])[-2:], _SUSPECT.sub(_first_printed, s[at + size : at + size + 3])[:2])
    if other != sides[0]:
        sides.append(other)
    forms: dict[str, list[str]] = {}
    for a, b in sides:
        windows = [(a, b[:0]), (a[-1:], b[:1]), ("", b)] + ([(a[-1:], ""), ("", b[:1])] if size == 2 else [])
        for x, y in windows:
            if len(x) + len(y) == 2 or (size == 2 and len(x) + len(y) == 1):
                first, last = (left[len(left) - len(x) :], right[: len(y)])
                forms.setdefault(first + read + last, []).extend(x + p + y for p in printed)
    return list(forms), list(forms.values())


def suspects_zh(lines: list[str], noise: dict[int, str]) -> Iterator[tuple[int, str]]:
    """Line index and window of each character that may be a misreading.

    A window has the characters before the place, two line feeds around it, and those behind.
    """
    body = [k for k, line in enumerate(lines) if k not in noise and line.strip()]
    stripped = [lines[k].strip() for k in body]
    for i, k in enumerate(body):
        s = stripped[i]
        before = stripped[i - 1][-3:] if i and not ended(stripped[i - 1]) else ""
        after = stripped[i + 1][:3] if i + 1 < len(body) and not ended(s) else ""
        whole = before + s + after
        low, high = len(before), len(before) + len(s)
        for m in _SUSPECT.finditer(whole, low, min(len(whole), high + 1)):
            a, b = m.span()
            if a < high and whole[a] not in "丶丨":
                yield k, f"{whole[max(0, a - 3) : a]}\n{whole[a:b]}\n{whole[b : b + 3]}"


def window_keys(window: str) -> tuple[list[int], list[list[int]]]:
    """Keys of the contexts of a window as read and as printed."""
    left, read, right = window.split("\n")
    keep, other = _contexts_zh(left + read + right, len(left), len(read))
    return [_gram_key(g) for g in keep], [[_gram_key(g) for g in o] for o in other]


_KEYS = {n: np.uint64(0x9E3779B97F4A7C15 + 2 * n) for n in (2, 3, 4)}
_WHOLE = (1 << 64) - 1
_grams: dict[str, int] = {}


def _gram_key(gram: str) -> int:
    """Signed 64-bit key of a context, as ``_gram_keys`` gives it."""
    key = _grams.get(gram)
    if key is None:
        if len(_grams) > 300_000:
            _grams.clear()
        h = 0
        for c in gram:
            h = (h * 0x100000001B3 + ord(c)) & _WHOLE
        h ^= h >> 29
        h = h * int(_KEYS[len(gram)]) & _WHOLE if len(gram) in _KEYS else 0
        key = _grams[gram] = h - (1 << 64) if h >> 63 else h
    return key


def _gram_keys(codes: np.ndarray, size: int) -> np.ndarray:
    n = len(codes) - size + 1
    h = np.zeros(max(0, n), np.uint64)
    for j in range(size if n > 0 else 0):
        h = h * np.uint64(0x100000001B3) + codes[j : j + n]
    h = h ^ h >> np.uint64(29)
    return h * _KEYS[size]


def _hyphens(lines: list[str], noise: dict[int, str]) -> Iterator[tuple[int, str, str, str]]:
    """Line index, mark, joined word and compound of each word that a line end may split."""
    body = [k for k, line in enumerate(lines) if k not in noise and line.strip()]
    for k, after in zip(body, [*body[1:], None]):
        end = word_at_end(lines[k])
        if not end:
            continue
        _, head, mark = end
        if after is None:
            # the text breaks off; only marks that compounds never have speak for themselves
            if mark in "¬\xad":
                yield k, mark, "", ""
            continue
        start = _WORD_AT_START.match(lines[after])
        if start:
            head, tail = head.lower(), start.group(1).strip("!|").lower()
            yield k, mark, re.split("[-‐]", head)[-1] + tail, f"{head.replace('‐', '-')}-{tail}"
        elif mark in "¬\xad":
            yield k, mark, "", ""


_COMPOUND = re.compile(r"[A-Za-z]+(?:[-‐][A-Za-z]+)+")


def compounds_of(text: str) -> list[str]:
    """Words with hyphens of their own, in lower case."""
    return [w.lower().replace("‐", "-") for x in text.split() if "-" in x or "‐" in x for w in _COMPOUND.findall(x)]


def first_pass(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Rows of kinds f (found noise), h (hyphens to settle), z (contexts to settle) and w (word counts)."""
    source = df.select(df[id_column].cast("string").alias("id"), df[text_column].alias("t")).where(F.length("t") > 0)
    schema = "kind string, id string, line_no bigint, a string, b string, n bigint, keys array<bigint>, others array<array<bigint>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        windows: set[str] = set()

        def emit(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows)) or [[]] * 8
            types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["kind", "id", "line_no", "a", "b", "n", "keys", "others"])

        for batch in batches:
            rows = []
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                page = layout(text)
                if page is None:
                    counts.update(tokens_of(text))
                    counts.update(compounds_of(text))
                    continue
                lines, noise = page
                rows += [("f", id_, k + 1, kind, None, None, None, None) for k, kind in noise.items()]
                misread = {k for k, line in enumerate(lines) if k not in noise and _NEAR_DIGIT.search(line) and _NUMBER_MISREAD.search(line)}
                rows += [("f", id_, k + 1, "misread", None, None, None, None) for k in misread]
                for k, mark, joined, compound in _hyphens(lines, noise):
                    rows.append(("f", id_, k + 1, "hyphen", None, None, None, None) if mark in "¬\xad" else ("h", id_, k + 1, joined, compound, None, None, None))
                counts.update(w for _, w in body_words(lines, noise))
                for k, line in enumerate(lines):
                    if k not in noise and ("-" in line or "‐" in line):
                        counts.update(compounds_of(line))
                for k, window in suspects_zh(lines, noise):
                    rows.append(("z", id_, k + 1, window, None, None, None, None))
                    if window not in windows:
                        windows.add(window)
                        rows.append(("y", None, None, window, None, None, *window_keys(window)))
            if len(windows) > 300_000:
                windows.clear()
            if len(counts) > 300_000:
                rows += [("w", None, None, w, None, n, None, None) for w, n in counts.items()]
                counts.clear()
            yield emit(rows)
        yield emit([("w", None, None, w, None, n, None, None) for w, n in counts.items()])

    return source.mapInArrow(run, schema)


def _bit_map(df: DataFrame, column: str) -> np.ndarray:
    """Bit map of fixed size of the hashed values of a string or bigint column."""
    numeric = dict(df.dtypes)[column] == "bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = np.zeros(1 << MAP_BITS, bool)
        for batch in batches:
            if numeric:
                have[batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - MAP_BITS)] = True
            else:
                have[[_bit(w) for w in batch.column(0).to_pylist()]] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(have).astype(np.int32))], names=["bit"])

    have = np.zeros(1 << MAP_BITS, bool)
    have[df.select(column).mapInArrow(run, "bit int").distinct().toArrow().column("bit").to_numpy()] = True
    return have


def link_words(words: DataFrame) -> DataFrame:
    """``(word, printed, odds)``: rare words and the frequent neighbour that glyph edits lead to."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w, n, k, own = [], [], [], []
            for word, count in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                base = skeleton(word)
                for x in {skeleton(e) for e in expansions(word)} if len(word) > 2 else {base}:
                    w.append(word)
                    n.append(count)
                    k.append(x)
                    own.append(x == base)
            yield pa.RecordBatch.from_arrays([pa.array(w, pa.string()), pa.array(n, pa.int64()), pa.array(k, pa.string()), pa.array(own, pa.bool_())], names=["word", "n", "key", "own"])

    shape = "word string, n bigint, key string, own boolean"
    words = words.where(F.length("word") <= LONGEST_WORD)
    plain = words.where(F.col("n") >= FREQUENT).where(F.col("word").rlike("^[a-z]+$"))
    frequent = plain.mapInArrow(keys, shape).where("own").select(F.col("word").alias("printed"), F.col("n").alias("often"), "key")
    rare = words.where(~F.col("word").contains("-")).mapInArrow(keys, shape).select("word", "n", "key").distinct()
    joined = rare.join(frequent, "key").where((F.col("word") != F.col("printed")) & (F.col("often") >= RATIO * F.col("n")))
    return joined.groupBy("word").agg(F.max_by(F.struct("printed", (F.col("often") / F.col("n")).alias("odds")), F.struct("often", "printed")).alias("best")).select("word", "best.*")


def second_pass(df: DataFrame, id_column: str, text_column: str, words: np.ndarray, printed: np.ndarray, grams: np.ndarray) -> DataFrame:
    """Rows of kinds o (an occurrence of a rare word with its surroundings), v (skip-gram vectors) and g (context counts)."""
    source = df.select(df[id_column].cast("string").alias("id"), df[text_column].alias("t")).where(F.length("t") > 0)
    shared = df.sparkSession.sparkContext.broadcast((np.packbits(words), np.packbits(printed), np.packbits(grams)))
    schema = "kind string, id string, line_no bigint, word string, key bigint, n bigint, v array<float>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, printed, grams = (np.unpackbits(x).astype(bool) for x in shared.value)
        # the words of this task: number, projection, whether rare or a frequent neighbour, sum of surroundings
        vocabulary: dict[str, int] = {"": 0}
        signs = np.zeros((1, VECTOR), np.float32)
        rare, often = np.zeros(1, bool), np.zeros(1, bool)
        sums = np.zeros((1, VECTOR), np.float32)

        def emit(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows)) or [[]] * 7
            types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.float32())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["kind", "id", "line_no", "word", "key", "n", "v"])

        def learn() -> None:
            """Rows of the tables for words met since."""
            nonlocal signs, rare, often, sums
            new = list(vocabulary)[len(signs) :]
            if not new:
                return
            bits = np.array([zlib.crc32(w.encode()) for w in new], np.uint32)
            sign = ((bits[:, None] >> np.arange(VECTOR, dtype=np.uint32)) & 1).astype(np.float32) * 2 - 1
            sign[[len(w) <= 3 for w in new]] = 0
            at = (bits >> np.uint32(32 - MAP_BITS)).astype(np.int64)
            signs, sums = np.vstack([signs, sign]), np.vstack([sums, np.zeros_like(sign)])
            rare, often = np.r_[rare, words[at]], np.r_[often, printed[at]]

        def part(ids: list, texts: list[str]) -> list[tuple]:
            rows = []
            codes = np.frombuffer("\0\0\0".join(t for t in texts if _ANY_WIDE.search(t)).encode("utf-32-le", "surrogatepass"), np.uint32)
            # a line end inside a sentence is no border between characters
            wide = codes > 0x2E80
            inner = (codes == 10) & np.r_[False, wide[:-1]] & np.r_[wide[1:], False]
            codes = codes[~inner].astype(np.uint64)
            for size in _KEYS:
                keys = _gram_keys(codes, size)
                hit = grams[keys >> np.uint64(64 - MAP_BITS)]
                key, n = np.unique(keys[hit].view(np.int64), return_counts=True)
                rows += [("g", None, None, None, int(k), int(m), None) for k, m in zip(key.tolist(), n.tolist())]
            stream: list[str] = []
            places: list[tuple[int, int, int]] = []
            for j, text in enumerate(texts):
                if not _THREE.search(text):
                    continue
                page = layout(text)
                if page is None:
                    stream += tokens_of(text)
                else:
                    for k, w in body_words(*page):
                        places.append((len(stream), j, k + 1))
                        stream.append(w)
                stream += ("", "", "")
            if not stream:
                return rows
            number = np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in stream), np.int64, len(stream))
            learn()
            v = signs[number]
            around = np.zeros_like(v)
            for o in (1, 2, 3):
                around[o:] += v[:-o]
                around[:-o] += v[o:]
            at = np.flatnonzero(often[number])
            if len(at):
                order = at[np.argsort(number[at], kind="stable")]
                first = np.flatnonzero(np.r_[True, np.diff(number[order]) > 0])
                sums[number[order][first]] += np.add.reduceat(around[order], first)
            for t, j, line in places:
                if rare[number[t]]:
                    rows.append(("o", ids[j], line, stream[t], None, 1, around[t].tolist()))
            return rows

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for k in range(0, len(texts), 400):
                yield emit(part(ids[k : k + 400], texts[k : k + 400]))
        used = np.flatnonzero(np.abs(sums).sum(1) > 0)
        names = list(vocabulary)
        yield emit([("v", None, None, names[k], None, 1, sums[k].tolist()) for k in used])

    return source.mapInArrow(run, schema)


def _analyse(df: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Found noise (id, line_no, noise), misread words (id, line_no, word, printed) and characters (id, line_no, window, printed)."""
    first = cut_lineage(first_pass(df, id_column, text_column))
    words = cut_lineage(first.where("kind = 'w'").groupBy(F.col("a").alias("word")).agg(F.sum("n").alias("n")))
    links = cut_lineage(link_words(words))
    windows = cut_lineage(first.where("kind = 'y'").groupBy(F.col("a").alias("window")).agg(F.first("keys").alias("keys"), F.first("others").alias("others")))
    asked = windows.select(F.explode("keys").alias("key")).unionByName(windows.select(F.explode(F.flatten("others")).alias("key"))).distinct()
    second = cut_lineage(second_pass(df, id_column, text_column, _bit_map(links, "word"), _bit_map(links, "printed"), _bit_map(asked, "key")))
    # hyphens: the joined word against the compound
    hyphens = first.where("kind = 'h'").select("id", "line_no", F.col("a").alias("joined"), F.col("b").alias("compound"))
    parts = hyphens.withColumn("tail", F.element_at(F.split("compound", "-"), -1)).withColumn("head", F.element_at(F.split("compound", "-"), -2))

    def counted(frame: DataFrame, column: str, to: str) -> DataFrame:
        return frame.join(words.select(F.col("word").alias(column), F.col("n").alias(to)), column, "left").na.fill(0, [to])

    for column in ("joined", "compound", "head", "tail"):
        parts = counted(parts, column, f"n_{column}")
    # neither form met: two known words make a compound
    split = parts.where((F.col("n_joined") > F.col("n_compound")) | ((F.col("n_compound") == 0) & (F.col("n_joined") == 0) & ((F.col("n_head") < FREQUENT) | (F.col("n_tail") < FREQUENT))))
    # misread words: linked, and at home in the frequent word's surroundings
    vectors = second.where("kind = 'v'").groupBy(F.col("word").alias("printed")).agg(*(F.sum(F.get("v", F.lit(j))).alias(f"v{j}") for j in range(VECTOR)))
    home = vectors.select("printed", F.array(*(f"v{j}" for j in range(VECTOR))).alias("home"))
    seen = second.where("kind = 'o'").select("id", "line_no", "word", F.col("v").cast("array<double>").alias("v")).join(links, "word").join(home, "printed", "left")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    agree = F.try_divide(dot(F.col("v"), F.col("home")), F.sqrt(dot(F.col("v"), F.col("v")) * dot(F.col("home"), F.col("home"))))
    # signs inside a word are no spelling; the better the odds, the less the surroundings have to say
    letters = F.col("word").rlike("^[a-zſﬁﬂ]+$")
    enough = F.coalesce(agree, F.lit(1.0)) >= AGREEMENT - 0.15 * F.log10(F.col("odds") / RATIO)
    misread = seen.where(enough | ~letters).select("id", "line_no", "word", "printed")
    # misread characters: the triple as printed is far more frequent than as read
    grams = second.where("kind = 'g'").groupBy("key").agg(F.sum("n").alias("n"))
    long = windows.select("window", F.posexplode("keys").alias("form", "key")).select("window", "form", F.lit(-1).alias("way"), "key").unionByName(
        windows.select("window", F.posexplode("others").alias("form", "o")).select("window", "form", F.posexplode("o").alias("way", "key"))
    )
    known = long.join(grams, "key", "left").na.fill(0, ["n"])
    other = F.col("way") >= 0
    scored = known.groupBy("window", "form").agg(F.max(F.when(~other, F.col("n"))).alias("read"), F.max(F.when(other, F.col("n"))).alias("printed"), F.max_by("way", F.when(other, F.col("n"))).alias("way"))
    speaks_for = (F.col("printed") >= FREQUENT) & (F.col("printed") >= RATIO_CHARACTERS * F.col("read"))
    speaks_against = (F.col("read") >= RATIO * FREQUENT) & (F.col("read") >= RATIO * F.col("printed"))
    way = F.max_by("way", F.when(speaks_for, F.col("printed")))
    wrong = scored.groupBy("window").agg(F.max(speaks_for.cast("int")).alias("ok"), F.max(speaks_against.cast("int")).alias("no"), way.alias("way")).where("ok = 1 AND no = 0")
    characters = first.where("kind = 'z'").select("id", "line_no", F.col("a").alias("window")).join(wrong.select("window", "way"), "window")
    found = union_all([
        first.where("kind = 'f'").select("id", "line_no", F.col("a").alias("noise")),
        split.select("id", "line_no", F.lit("hyphen").alias("noise")),
        misread.select("id", "line_no", F.lit("misread").alias("noise")),
        characters.select("id", "line_no", F.lit("misread").alias("noise")),
    ])
    return found.distinct(), misread, characters


def page_noise(df: DataFrame, id_column: str = "id", text_column: str = "text") -> DataFrame:
    """Distinct ``(id, line_no, noise)``; lines are split at line feeds and counted from 1.

    Null and empty texts have none; repeated rows count once; an empty table gives no rows;
    other columns are not read. Three scans; words, keys and counts are shuffled, texts are not.
    """
    return _analyse(df, id_column, text_column)[0].withColumnRenamed("id", id_column)


def repair_text(text: str, noise: dict[int, set[str]], words: dict[str, str], windows: dict[str, int]) -> str:
    """Text without furniture, split words joined, misread ones corrected, lines reflowed into paragraphs.

    ``noise`` has the kinds found per line number, ``words`` corrections of words, ``windows`` the
    chosen printed form of each window of a misread character. Lines that are no running text
    (numbers, headings, items) stay lines of their own.
    """
    out: list[str] = []
    open_ended = False
    blank = hyphen = False
    lines = text.split("\n")
    for no, line in enumerate(lines, 1):
        kinds = noise.get(no, set())
        if kinds & {"page_no", "header"}:
            continue
        s = line.rstrip().rstrip("\u3000")
        if not s:
            blank = True
            continue
        indented = s[0] in "\u3000 " and s[:2].strip(" \u3000") == ""
        body = s.strip(" \u3000")
        short = width(body) < 24 and not ended(body) and not _PROSE.search(re.sub(r"\d+\.\d+", "0", body))
        after = lines[no] if no < len(lines) else ""
        own = bool(_STRUCTURE.match(body)) or (short and (bool(re.search(r"\d", body)) or not after.strip() or after[:1] in "\u3000 "))
        # a sentence that runs on ignores the page break between
        goes_on = open_ended and not indented and not (own and blank)
        if out and goes_on:
            before = out[-1]
            if hyphen:
                out[-1] = before[:-1] + body
            elif before[-1:] in "-‐" and body[:1].islower():
                out[-1] = before + body
            elif _WIDE.match(before[-1]) or _WIDE.match(body[0]):
                out[-1] = before + body
            else:
                out[-1] = f"{before} {body}"
        elif out and not blank and not indented and not own and ended(out[-1]) and not _STRUCTURE.match(out[-1]):
            joint = "" if _WIDE.match(out[-1][-1]) else " "
            out[-1] = out[-1] + joint + body
        else:
            out.append(body)
        blank = False
        hyphen = "hyphen" in kinds
        open_ended = hyphen or not (ended(body) or own)
    whole = "\n\n".join(out)
    for window, way in windows.items():
        left, read, right = window.split("\n")
        printed = _ZH_TWO[read] if len(read) == 2 else _ZH_READ[read]
        whole = whole.replace(left + read + right, left + printed[way % len(printed)] + right)

    def correct(m: re.Match) -> str:
        got = words.get(m.group().lower())
        if got is None:
            return m.group()
        return got.upper() if m.group().isupper() else got.capitalize() if m.group()[0].isupper() else got

    whole = _NUMBER_MISREAD.sub(lambda m: m.group().translate(_PRINTED_DIGITS), whole)
    return re.sub(_TOKEN.pattern, correct, whole, flags=re.I) if words else whole


def repair_pages(df: DataFrame, id_column: str = "id", text_column: str = "text") -> DataFrame:
    """One row per row with a text: the id, the repaired text, and whether it came from scanned pages.

    Texts that are not scanned stay as they are; null texts have no row; repeated rows stay repeated.
    """
    found, words, characters = _analyse(df, id_column, text_column)
    lines = found.groupBy("id").agg(F.collect_list(F.struct("line_no", "noise")).alias("lines"))
    fixes = words.select("id", "word", "printed").distinct().groupBy("id").agg(F.collect_list(F.struct("word", "printed")).alias("words"))
    glyphs = characters.select("id", "window", "way").distinct().groupBy("id").agg(F.collect_list(F.struct("window", "way")).alias("windows"))
    source = df.select(df[id_column].cast("string").alias("id"), df[text_column].alias("t")).where(F.col("t").isNotNull())
    joined = source.join(lines, "id", "left").join(fixes, "id", "left").join(glyphs, "id", "left").select("id", "t", "lines", "words", "windows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, scanned = [], []
            for text, lines, words, windows in zip(*(batch.column(k).to_pylist() for k in range(1, 5))):
                noise: dict[int, set[str]] = {}
                for x in lines or ():
                    noise.setdefault(x["line_no"], set()).add(x["noise"])
                is_page = layout(text) is not None
                made.append(repair_text(text, noise, {x["word"]: x["printed"] for x in words or ()}, {x["window"]: x["way"] for x in windows or ()}) if is_page else text)
                scanned.append(is_page)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string()), pa.array(scanned, pa.bool_())], names=["id", "repaired", "scanned"])

    return joined.mapInArrow(run, "id string, repaired string, scanned boolean").withColumnRenamed("id", id_column)
