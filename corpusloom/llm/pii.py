"""Problem 6: personal data in free text, found and replaced by typed placeholders.

Method: bootstrapped contextual extraction. Recognisers propose candidates of each
kind with a prior from their inner form (a valid date in an identity number, a
well-formed address, a family name). Seeds are candidates that stand behind an
explicit label or whose form leaves no doubt. They induce lexical patterns: the
text just before and just after. Spark scores the graph of patterns and instances
in rounds: a pattern is as good as its instances, an instance as good as its
prior and all its patterns, both by the number of records, so that a score rests
on shares and not on the size of the corpus. Patterns that score well carry
candidates whose form alone would not do; patterns of look-alikes (sample and book
numbers) sink theirs.
Names learn an inventory of name parts from the seeds; parts met again in other
places, also in lower case, give new candidates and with them new patterns.

The inventory of parts travels as a bit map of fixed size; patterns and instances
stay distributed and are joined.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.runtime import cut_lineage, union_all

PART_BITS = 22
ROUNDS = 2
#: Score from which on an instance counts as found.
ACCEPT = 0.5

# Chinese family names, compound ones first.
COMPOUND_NAMES = "欧阳 上官 司马 诸葛 慕容 夏侯 尉迟 公孙 令狐 司徒 长孙 宇文 皇甫 东方 南宫 端木 独孤 轩辕 百里 呼延 闻人 澹台 公冶 宗政 濮阳 淳于 单于 太叔 申屠 仲孙 钟离 鲜于 闾丘".split()
FAMILY_NAMES = (
    "赵钱孙李周吴郑王冯陈褚卫蒋沈韩杨朱秦尤许何吕施张孔曹严华金魏陶姜戚谢邹喻柏水窦章云苏潘葛奚范彭郎鲁韦昌马苗凤花方俞任袁柳酆鲍史唐费廉岑薛雷贺倪汤滕殷罗毕郝邬安常乐于时傅皮卞齐康伍余元卜顾孟平黄和穆萧尹姚邵湛汪祁毛禹狄米贝明臧计伏成戴谈宋茅庞熊纪舒屈项祝董梁杜阮蓝闵席季麻强贾路娄危江童颜郭梅盛林刁钟徐邱骆高夏蔡田樊胡凌霍"
    "虞万支柯昝管卢莫经房裘缪干解应宗丁宣邓郁单杭洪包诸左石崔吉钮龚程嵇邢裴陆荣翁荀羊惠甄曲家封芮储靳汲邴糜松井段富巫乌焦巴弓牧隗山谷车侯宓蓬全郗班仰秋仲伊宫宁仇栾暴甘厉戎祖武符刘景詹束龙叶幸司韶黎蓟薄印宿白怀蒲邰鄂索籍赖卓蔺屠蒙池乔阴胥闻莘党翟谭贡劳姬申扶堵冉宰郦雍璩桑桂濮牛寿通边扈燕冀浦尚农温别庄晏柴瞿阎充慕连茹习宦艾鱼容向古易慎戈廖庾终暨居衡步都耿满弘匡国文寇广禄阙东欧沃利蔚越夔隆师巩厍聂晁勾敖融冷辛阚那简饶空曾沙乜养鞠须丰关蒯相查后荆红游竺权逯盖益桓公涂覃佟楚闫"
)
_NAME_ZH = rf"(?:{'|'.join(COMPOUND_NAMES)}|[{FAMILY_NAMES}])[一-鿿]{{1,2}}"
# What stands before and after Chinese full names.
_LABEL_ZH = r"(?:联系人|负责人|教师|老师|姓名|学生|作者|家长|班主任|监护人|执笔|校对|审核|审校|校验|撰稿|供稿|编者|编辑|编写|主讲|讲师|主编|签名|签字|学员|教员|校长|主任|制表|填表人|收件人|记录人|经办人|报名人|同学)"
_TITLE_ZH = r"(?:老师|同学|先生|女士|校长|主任|教授|医生|家长|主编|博士|师傅)"
_DIGIT_ZH = "零〇幺一二三四五六七八九两"
_NUMBER_ZH = "零〇一二三四五六七八九十百两"
# Number words, street words and labels of English text.
_WORD_DIGIT = r"(?:zero|oh|one|two|three|four|five|six|seven|eight|nine)"
_WORD_NUMBER = r"(?:one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|thirteen|fourteen|fifteen|sixteen|seventeen|eighteen|nineteen|twenty|thirty|forty|fifty|sixty|seventy|eighty|ninety|hundred)"
_STREET = r"(?:Street|St|Road|Rd|Lane|Ln|Avenue|Ave|Drive|Dr|Close|Way|Terrace|Court|Ct|Place|Pl|Square|Crescent|Boulevard|Blvd|Gardens|Grove|Row|Hill|Walk|Mews|Parade|Quay|Rise|View|Park|Circle|Trail|Green)"
_LABEL_EN = r"(?:teacher|author|contact|student|pupil|name|parent|guardian|prepared by|written by|signed|tutor|head|editor|instructor|coordinator|mr|mrs|ms|miss|dr|prof|professor)"

_CAP = r"[A-Z][a-zà-öø-ÿ'’]*[a-zà-öø-ÿ](?:[A-Z][a-zà-öø-ÿ]+)?(?:-[A-Z][a-zà-öø-ÿ]+)?"
# overlapping readings: a label with a capital must not hide the name behind it
_NAME_EN = re.compile(rf"(?<![A-Za-z0-9@._’'-])(?=((?:{_CAP}, {_CAP}(?: [A-Z]\.)?|{_CAP}(?: [A-Z]\.)?(?: (?:van|von|de|del|da|di|la|le))? {_CAP})(?![A-Za-z’'@-])))")
_LABEL_EN_AT = re.compile(rf"(?i)(?:^|[^a-z]){_LABEL_EN}[.:]?[ \n]$")

_HOST = r"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?"
_LOCAL = r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9])?"
_DOT = r"(?:[.．]|[ ]?[\[(（{][ ]?(?:dot|DOT|\.)[ ]?[\])）}][ ]?)"
_AT = r"(?:[@＠]|[ ]?[\[(（{][ ]?(?:at|AT|@)[ ]?[\])）}][ ]?)"
_EMAIL = re.compile(
    rf"(?<![A-Za-z0-9._%+-]){_LOCAL}{_AT}{_HOST}(?:{_DOT}{_HOST})*{_DOT}[A-Za-z]{{2,}}(?![A-Za-z0-9])"
    rf"|(?<![A-Za-z0-9]){_LOCAL}[ ]?(?:艾特|圈a|圈A)[ ]?{_HOST}(?:[ ]?(?:点|\.)[ ]?{_HOST})+"
    rf"|(?<![A-Za-z0-9])(?:[A-Za-z0-9+-]+ (?:dot|underscore|dash|hyphen|plus) )*{_LOCAL} at {_HOST}(?: dot {_HOST})+"
)
_EMAIL_HINT = re.compile(r"[@＠]|艾特|圈[aA]|[\[(（{] ?(?:at|AT)|\bat [A-Za-z0-9-]+ dot ")
_D = r"[0-9０-９]"
_SEP = r"[ \-－–.·　]"
_LONG = re.compile(
    rf"(?<![A-Za-z0-9０-９.＋+(（@-])(?:"
    # country code, or area code in brackets, or plain; groups of digits with single separators
    rf"(?:[+＋]{_D}{{1,3}}{_SEP}?)?(?:[(（]{_D}{{2,5}}[)）]{_SEP}?)?{_D}{{2,}}(?:{_SEP}{_D}{{2,}})*"
    rf"|[A-Z]{{1,2}}{_SEP}?{_D}{{2,}}(?:{_SEP}{_D}{{2,}})*)(?:{_SEP}?[A-Za-zＸ](?![A-Za-z0-9]))?(?![0-9０-９])"
)
_LONG_HINT = re.compile(rf"{_D}{{6}}|{_D}{{2,4}}[)）{_SEP[1:-1]}]{_D}{{2}}")
_SPOKEN_ZH = re.compile(rf"(?:[A-Z])?[{_DIGIT_ZH}]{{7,}}[xXＸ]?")
_SPOKEN_EN = re.compile(rf"\b{_WORD_DIGIT}(?: (?:double |triple )?{_WORD_DIGIT}){{5,}}\b")
_PLACE = r"[一-鿿]{2,3}"
_ADDRESS_ZH = re.compile(
    rf"(?:[一-鿿]{{2,3}}省)?(?:[一-鿿]{{2,4}}市)?(?:[一-鿿]{{2,4}}(?:区|县|镇|乡))?(?:[一-鿿]{{2,4}}(?:街道|社区|村))?"
    rf"[一-鿿]{{2,4}}(?:大道|大街|路|街|巷|里|弄|胡同|村|道)(?:[0-9０-９]+|[{_NUMBER_ZH}]+)(?:号院|号|弄)(?:(?:[0-9０-９]+|[{_NUMBER_ZH}]+)(?:号楼|栋|幢|座|单元|弄|层|楼|室|号))*"
)
_NOT_PLACE = "在是到于往住至由从自寄为向的址点达位搬去来回地家当天会把送赴"
_UNIT_EN = r"(?:[Ff]lat|[Aa]partment|[Aa]pt|[Uu]nit|[Ss]uite|[Rr]oom)\.? ?#?\w{1,4}"
_ADDRESS_EN = re.compile(
    rf"(?:{_UNIT_EN},? )?(?:\d{{1,4}}[A-Za-z]?|{_WORD_NUMBER}(?:[ -](?:and )?{_WORD_NUMBER})*) (?:(?:St\.? )?[A-Z][A-Za-z'’-]* ){{1,3}}{_STREET}\b(?!['’])(?:, {_UNIT_EN}(?![A-Za-z]))?(?:, (?!(?:{_UNIT_EN}))(?:{_CAP})(?: {_CAP})?(?=[\s,.;:!?)]|$))?(?:,? [A-Z]{{1,2}}\d[A-Z\d]? ?\d[A-Z]{{2}}|,? [A-Z]{{2}} \d{{5}})?"
)

_HOUSE_ZH = re.compile(rf"[0-9０-９{_NUMBER_ZH}](?:号|弄)")
_STREET_EN = re.compile(rf" {_STREET}\b")

_ASCII = str.maketrans("０１２３４５６７８９Ｘ＋（）－", "0123456789X+()-")
_SPOKEN = {c: str(d) for d, c in enumerate("零幺二三四五六七八九")} | {"〇": "0", "一": "1", "两": "2"}


def _date(s: str) -> bool:
    return s[:2] in ("19", "20") and 1 <= int(s[4:6]) <= 12 and 1 <= int(s[6:8]) <= 31


def number_kind(raw: str) -> tuple[str | None, float]:
    """Kind and prior of a long number by its inner form."""
    s = raw.translate(_ASCII)
    digits = re.sub(r"\D", "", s)
    head = re.match(r"[A-Z]{1,2}(?=[ -]?\d)", s)
    tail = re.search(r"(?<=[\d ])[A-Za-z]$", s)
    n = len(digits)
    plus = s.startswith("+")
    if head and head.group() == "G" and n in (17, 18) and _date(digits[6:14]):
        return "id_number", 0.95
    if head and len(head.group()) == 1 and n in (7, 8, 9) and not tail:
        return "id_number", 0.8
    if head and len(head.group()) == 2 and n == 6 and tail:
        return "id_number", 0.95
    if head:
        return ("id_number", 0.3) if n >= 6 else (None, 0)
    if (n == 18 and not tail) or (n == 17 and tail and tail.group() in "xX"):
        return "id_number", 0.9 if _date(digits[6:14]) else 0.1
    if tail:
        return None, 0
    if n == 9 and re.fullmatch(r"\d{3}-\d{2}-\d{4}", s):
        return "id_number", 0.85
    if plus and 9 <= n <= 14:
        return "phone", 0.95
    if n == 11 and digits[0] == "1" and digits[1] in "3456789" and re.fullmatch(r"\d{11}|\d{3}[ -]\d{4}[ -]\d{4}", s):
        return "phone", 0.9
    if re.fullmatch(r"\(?0\d{2,3}\)?[ -]?\d{7,8}|\(?0\d{2,3}\)?[ -]\d{3,4}[ -]\d{4}", s) and 10 <= n <= 12:
        return "phone", 0.85
    if re.fullmatch(r"\(?0\d{3,5}\)?[ -]?\d{3}[ -]?\d{3}|0\d{4} \d{6}|0\d{2} \d{4} \d{4}", s):
        return "phone", 0.85
    if re.fullmatch(r"(?:1[ .-])?\(?[2-9]\d{2}\)?[ .-]\d{3}[ .-]\d{4}", s):
        return "phone", 0.9
    if n == 18:
        return "id_number", 0.1
    if 7 <= n <= 13 and re.fullmatch(r"[\d ()-]+", s) and not s.startswith("978"):
        return "phone", 0.2
    return None, 0


def _left(text: str, a: int) -> str:
    """Pattern side before a place: the last word or two characters, digits as one kind, blanks as one."""
    s = text[max(0, a - 12) : a].replace("\n", " ").rstrip(" 　*_`'~")
    if not s:
        return "^"
    if s[-1] > "⺀":
        return re.sub(r"\d+", "0", s[-2:])
    m = re.search(r"([A-Za-z]+)?([^A-Za-z0-9\s]?)$", s)
    return f"{(m.group(1) or '').lower()}{m.group(2)}" or "0"


def _right(text: str, b: int) -> str:
    s = text[b : b + 12].replace("\n", " ").lstrip(" 　*_`'~")
    if not s:
        return "$"
    if s[0] > "⺀":
        return s[0] + re.sub(r"[0-9０-９+＋(（]", "0", s[1:].lstrip(" 　")[:1])
    m = re.match(r"[^A-Za-z0-9\s]|[A-Za-z]+", s)
    return (m.group() if m else "0").lower()


_ZH_CUED = re.compile(rf"(?:(?P<label>{_LABEL_ZH})[ 　]?[：:]?[ 　\n]?|(?P<cue>叫|由|有请|请|让|联系|是|找|问|向|给|和|与|及|、)\n?)(?P<name>{_NAME_ZH})")
_ZH_TITLED = re.compile(rf"(?P<name>{_NAME_ZH})(?={_TITLE_ZH})")
_ZH_FREE = re.compile(rf"(?:^|(?<=[\s，。；：、（(！？“”|>]))(?P<name>{_NAME_ZH})(?=[，,（(：:\s|]|(?:{_TITLE_ZH}))", re.M)
_AFTER_NAME = re.compile(rf"[，,。．.；;、（(：:\s|<!！？]|$|{_TITLE_ZH}|今天|来回|整理|编|电话|住|手机|把|将|的|在|负责|同|说")


def _trim_place(s: str) -> int:
    """Characters before the first place of an address that belong to the words around it."""
    k = 0
    while len(s) - k > 6 and s[k] in _NOT_PLACE:
        k += 1
    m = re.match(r"([一-鿿]{2,4}?)(?:省|市|区|县|镇|乡)", s[k:])
    if m:
        inner = max((i for i, c in enumerate(m.group(1)) if c in "在住到于是址往至寄"), default=-1)
        if inner >= 0 and len(m.group(1)) - inner - 1 >= 2:
            k += inner + 1
    return k


def _around(text: str, anchor: re.Pattern, whole: re.Pattern, before: int, after: int) -> list[tuple[int, int]]:
    """Matches of a costly pattern, looked for only around the places of a cheap one that it holds."""
    out: list[tuple[int, int]] = []
    for m in anchor.finditer(text):
        if out and m.start() < out[-1][1]:
            continue
        low = max(out[-1][1] if out else 0, m.start() - before)
        for found in whole.finditer(text, low, min(len(text), m.end() + after)):
            if found.end() > m.start():
                if found.start() < m.end():
                    out.append(found.span())
                break
    return out


def structured(text: str) -> list[tuple[int, int, str, float]]:
    """``(start, end, kind, prior)`` of candidates other than names."""
    out: list[tuple[int, int, str, float]] = []
    if _EMAIL_HINT.search(text):
        out += [(m.start(), m.end(), "email", 0.95) for m in _EMAIL.finditer(text)]
    out += [(a + _trim_place(text[a:b]), b, "address", 0.9) for a, b in _around(text, _HOUSE_ZH, _ADDRESS_ZH, 40, 30)]
    if _LONG_HINT.search(text):
        for m in _LONG.finditer(text):
            if len(m.group()) < 7:
                continue
            kind, prior = number_kind(m.group())
            start, end = m.span()
            if kind is None and m.group()[-1].isalpha() and not m.group()[0].isalpha():
                # a letter of the next word
                end = start + len(m.group()[:-1].rstrip(" -"))
                kind, prior = number_kind(text[start:end])
            if kind:
                out.append((start, end, kind, prior))
    for m in _SPOKEN_ZH.finditer(text):
        n = len(m.group())
        s = "".join(_SPOKEN.get(c, c) for c in m.group())
        if n in (17, 18, 19) and (s[-1] in "xXＸ" or n >= 18):
            out.append((m.start(), m.end(), "id_number", 0.9))
        elif s[0].isalpha():
            out.append((m.start(), m.end(), "id_number", 0.7))
        elif n in (11, 12) and s[0] in "10":
            out.append((m.start(), m.end(), "phone", 0.9))
        elif n in (7, 8, 10):
            out.append((m.start(), m.end(), "phone", 0.4))
    if " " in text:
        out += [(m.start(), m.end(), "phone", 0.85) for m in _SPOKEN_EN.finditer(text)]
        out += [(a, b, "address", 0.9) for a, b in _around(text, _STREET_EN, _ADDRESS_EN, 90, 70)]
    return out


def names_zh(text: str) -> list[tuple[int, int, str, float, bool]]:
    """``(start, end, item, prior, seed)`` of Chinese full names near a cue; several readings of one place may come."""
    found: dict[tuple[int, int], tuple[float, bool]] = {}

    def add(a: int, b: int, prior: float, seed: bool) -> None:
        old = found.get((a, b), (0.0, False))
        found[a, b] = (max(prior, old[0]), seed or old[1])

    def readings(a: int, b: int) -> Iterator[int]:
        """Ends of the name that begins at ``a``, given what may follow it."""
        first = 2 if text[a : a + 2] in _COMPOUND else 1
        for size in (first + 2, first + 1):
            if a + size <= b and _AFTER_NAME.match(text, a + size):
                yield a + size
                return

    for m in _ZH_CUED.finditer(text):
        a = m.start("name")
        for b in readings(a, m.end("name")):
            add(a, b, 0.5, bool(m.group("label")) and text[b : b + 1] in "，。（(：,；、\n" or (m.group("label") is not None and bool(re.match(_TITLE_ZH, text[b : b + 2]))))
    for m in _ZH_TITLED.finditer(text):
        a, b = m.span("name")
        add(a, b, 0.45, False)
        # a family name may begin inside the match
        for k in range(a + 1, b - 1):
            if text[k] in FAMILY_NAMES:
                add(k, b, 0.2, False)
    if "，" in text or "：" in text or "(" in text or "（" in text:
        for m in _ZH_FREE.finditer(text):
            a = m.start("name")
            for b in readings(a, m.end("name")):
                add(a, b, 0.3, False)
    return [(a, b, text[a:b], p, s) for (a, b), (p, s) in found.items()]


_COMPOUND = frozenset(COMPOUND_NAMES)


def given_of(name: str) -> str:
    """Given characters of a Chinese full name."""
    return name[2:] if name[:2] in _COMPOUND and len(name) > 2 else name[1:]


def names_en(text: str) -> list[tuple[int, int, str, float, bool]]:
    out = []
    for m in _NAME_EN.finditer(text):
        a, b = m.span(1)
        out.append((a, b, m.group(1), 0.3, bool(_LABEL_EN_AT.search(text[max(0, a - 16) : a]))))
    return out


def parts_of(name: str) -> list[str]:
    """Name parts of a western full name, in lower case."""
    return [p for p in re.split(r"[ ,.]+", name.lower()) if len(p) > 2]


def _part_bit(part: str) -> int:
    return zlib.crc32(part.encode()) >> (32 - PART_BITS)


_SCHEMA = "tbl string, id string, kind string, item string, start int, end int, before string, after string, prior double, seed boolean, script string"


def _batches(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[]] * 11
    types = [pa.string()] * 4 + [pa.int32()] * 2 + [pa.string()] * 2 + [pa.float64(), pa.bool_(), pa.string()]
    names = [f.split()[0] for f in _SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)


def candidates(texts: DataFrame) -> DataFrame:
    """Candidates of all kinds in ``(tbl, id, text)`` with the pattern sides around them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for tbl, id_, text in zip(*(c.to_pylist() for c in batch.columns)):
                taken = structured(text)
                rows += [(tbl, id_, kind, text[a:b], a, b, _left(text, a), _right(text, b), prior, prior >= 0.8, "") for a, b, kind, prior in taken]
                covered = [(a, b) for a, b, kind, _ in taken if kind in ("address", "email")]
                starts = {a for a, _, kind, _ in taken if kind in ("phone", "email", "id_number")}
                # a name that an identifier follows stands in a list of contacts
                led = [(a, b, x, max(p, 0.5) if starts & set(range(b + 1, b + 4)) else p, s) for a, b, x, p, s in names_zh(text)]
                named = [(x, "zh") for x in led] + [(x, "en") for x in names_en(text)]
                for (a, b, item, prior, seed), script in named:
                    if not any(a < e and s < b for s, e in covered):
                        rows.append((tbl, id_, "person", item, a, b, _left(text, a), _right(text, b), prior, seed, script))
            yield _batches(rows)

    return texts.mapInArrow(run, _SCHEMA)


def lower_names(texts: DataFrame, parts: np.ndarray) -> DataFrame:
    """Pairs of neighbouring lower-case words that are both known name parts."""
    shared = texts.sparkSession.sparkContext.broadcast(np.packbits(parts))
    word = re.compile(r"(?<![A-Za-z0-9'’-])[a-zà-öø-ÿ][a-zà-öø-ÿ'’]+(?:-[a-zà-öø-ÿ]+)?(?![A-Za-z0-9@])")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = np.unpackbits(shared.value).astype(bool)
        known: dict[str, bool] = {}
        for batch in batches:
            rows = []
            for tbl, id_, text in zip(*(c.to_pylist() for c in batch.columns)):
                last = None
                for m in word.finditer(text):
                    w = m.group()
                    hit = known.get(w)
                    if hit is None:
                        if len(known) > 200_000:
                            known.clear()
                        hit = known[w] = len(w) > 2 and all(have[_part_bit(p)] for p in [w])
                    if hit and last is not None and text[last.end() : m.start()] == " ":
                        a, b = last.start(), m.end()
                        rows.append((tbl, id_, "person", text[a:b], a, b, _left(text, a), _right(text, b), 0.75, False, "lower"))
                        last = None
                    else:
                        last = m if hit else None
            yield _batches(rows)

    return texts.mapInArrow(run, _SCHEMA)


def part_scores(people: DataFrame) -> DataFrame:
    """``(part, script, good, all)``: how often a name part occurs in seeds and in all candidates."""
    zh = people.where("script = 'zh'").select("script", "seed", F.explode(F.split(F.expr("substring(item, IF(substring(item, 1, 2) IN ('" + "','".join(COMPOUND_NAMES) + "') AND length(item) > 2, 3, 2))"), "")).alias("part"))
    en = people.where("script = 'en'").select("script", "seed", F.explode(F.split(F.lower("item"), "[ ,.]+")).alias("part")).where(F.length("part") > 2)
    return union_all([zh.where("part != ''"), en]).groupBy("script", "part").agg(F.sum(F.col("seed").cast("int")).alias("good"), F.count("*").alias("all"))


def score_graph(edges: DataFrame) -> DataFrame:
    """Instances with their scores after rounds over the graph of patterns and instances.

    ``edges`` has kind, item, before, after, prior, n (records). A pattern is the side before
    and the pair of sides; its score is the mean score of the records of its instances, drawn
    to a fixed mean where it has few. An instance has its prior and the mean of its patterns,
    by its records in each: one good pattern among many poor ones does not carry a look-alike
    that is met everywhere, however many good instances that pattern has.
    """
    nodes = edges.select("kind", "item", "prior", "n", F.explode(F.array(F.concat_ws("\u0001", F.lit("b"), "before"), F.concat_ws("\u0001", F.lit("p"), "before", "after"))).alias("pattern"))
    links = nodes.groupBy("kind", "item", "pattern").agg(F.max("prior").alias("prior"), F.sum("n").alias("n"))
    score = links.withColumn("score", F.col("prior"))
    for _ in range(ROUNDS):
        patterns = score.groupBy("kind", "pattern").agg(((F.sum(F.col("n") * F.col("score")) + 0.6) / (F.sum("n") + 2)).alias("trust"))
        told = links.join(patterns, ["kind", "pattern"])
        # the patterns of an instance and its prior agree on its score
        mean = told.groupBy("kind", "item").agg(F.max("prior").alias("own"), (F.sum(F.col("n") * F.col("trust")) / F.sum("n")).alias("trust"))
        again = mean.select("kind", "item", (0.5 * F.col("own") + 0.5 * F.col("trust")).alias("score"))
        score = links.join(again, ["kind", "item"])
    return score.select("kind", "item", "score").distinct()


def personal_items(texts: DataFrame) -> DataFrame:
    """``(tbl, id, kind, start, end, pii_text)`` found in ``(tbl, id, text)``; places in code points from 0.

    Null and empty texts have nothing; repeated rows count once; a null id stays null;
    an empty table gives no rows.
    """
    texts = texts.where(F.length("text") > 0)
    first = cut_lineage(candidates(texts))
    people = first.where("kind = 'person'")
    scores = part_scores(people)
    # parts that the seeds know, as a bit map of fixed size for western ones
    western = scores.where("script = 'en' AND good > 0 AND good * 12 >= all").select("part")

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = np.zeros(1 << PART_BITS, bool)
        for batch in batches:
            for p in batch.column(0).to_pylist():
                have[_part_bit(p)] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(have).astype(np.int32))], names=["bit"])

    parts = np.zeros(1 << PART_BITS, bool)
    parts[western.mapInArrow(bits, "bit int").distinct().toArrow().column("bit").to_numpy()] = True
    shared = texts.sparkSession.sparkContext.broadcast(np.packbits(parts))

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Western candidates rise with each part that the inventory has."""
        have = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            items = batch.column("item").to_pylist()
            share = [sum(have[_part_bit(p)] for p in parts_of(x)) / max(1, len(parts_of(x))) for x in items]
            priors = [max(p if s else min(p, 0.1), 0.9 if k == 1 else 0.3 if k >= 0.5 else 0.05) for p, s, k in zip(batch.column("prior").to_pylist(), batch.column("seed").to_pylist(), share)]
            yield batch.set_column(batch.schema.get_field_index("prior"), "prior", pa.array(priors, pa.float64()))

    en = people.where("script = 'en'").mapInArrow(known, _SCHEMA)
    lower = lower_names(texts, parts)
    zh_parts = scores.where("script = 'zh'").select("part", (F.col("good") / F.col("all")).alias("rate"), "good")
    zh = people.where("script = 'zh'")
    given = F.expr("substring(item, IF(substring(item, 1, 2) IN ('" + "','".join(COMPOUND_NAMES) + "') AND length(item) > 2, 3, 2))")
    # the inventory of given characters is bounded by the script
    spelled = zh.select("item").distinct().select("item", F.explode(F.split(given, "")).alias("part")).where("part != ''")
    fitness = spelled.join(F.broadcast(zh_parts), "part", "left").groupBy("item").agg(F.min(F.coalesce(F.when(F.col("good") >= 1, F.col("rate")), F.lit(0.0))).alias("fit"))
    zh = zh.join(fitness, "item").withColumn("prior", F.when(F.col("fit") >= 0.08, F.when(F.col("prior") >= 0.4, 0.9).otherwise(0.45)).when(F.col("fit") > 0.02, F.col("prior") + 0.1).when(F.col("seed"), 0.5).when(F.col("prior") >= 0.4, 0.12).otherwise(0.05)).select(*first.columns)
    everything = cut_lineage(union_all([first.where("kind != 'person'"), en, lower.select(*first.columns), zh]))
    # records and not rows, so that a record delivered often has no more say
    edges = cut_lineage(everything.groupBy("kind", "item", "before", "after").agg(F.max("prior").alias("prior"), F.count_distinct(F.struct("tbl", "id")).alias("n")))
    good = score_graph(edges).where(F.col("score") >= ACCEPT)
    accepted = everything.join(good, ["kind", "item"]).select("tbl", "id", "kind", "item", "start", "end").distinct()
    # of readings of one place the one that begins first and goes farthest stands
    order = Window.partitionBy("tbl", "id", "kind").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    kept = accepted.withColumn("reach", F.max("end").over(order)).where(F.col("reach").isNull() | (F.col("start") >= F.col("reach")))
    return kept.select("tbl", "id", "kind", "start", "end", F.col("item").alias("pii_text"))


# Placeholders by kind.
PLACEHOLDERS = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID]", "address": "[ADDRESS]", "person": "[PERSON]"}


def redact(texts: DataFrame, items: DataFrame) -> DataFrame:
    """``(tbl, id, text, redacted)`` of ``(tbl, id, text)``: each item replaced by its kind's placeholder, all else unchanged.

    ``items`` are those of ``personal_items``. Texts without any stay as they are, null ones null.
    """
    spans = items.groupBy("tbl", "id").agg(F.sort_array(F.collect_set(F.struct("start", "end", "kind"))).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                out, at = [], 0
                for x in found or ():
                    if x["start"] >= at:
                        out += [text[at : x["start"]], PLACEHOLDERS[x["kind"]]]
                        at = x["end"]
                made.append("".join(out) + text[at:] if out else text)
            yield pa.RecordBatch.from_arrays([batch.column("tbl"), batch.column("id"), batch.column("text"), pa.array(made, pa.string())], names=["tbl", "id", "text", "redacted"])

    return texts.join(spans, ["tbl", "id"], "left").select("tbl", "id", "text", "spans").mapInArrow(run, "tbl string, id string, text string, redacted string")
