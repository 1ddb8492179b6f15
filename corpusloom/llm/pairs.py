"""Problem 3: question-answer pairs with a defective answer, each with its defect.

Method, by label:

* ``copies_question``: the answer is compressed with zstandard under the question
  as dictionary; an answer that then costs next to nothing is a copy. It must hold
  the question's stem and nothing beside it but a label.
* ``refusal`` and ``other_language``: dictionaries of refusing phrases and of the
  commonest words of each language (with its script).
* ``truncated``: a terminal-context model. For the last characters of an answer,
  at several lengths, the share of their occurrences in all answers that end a
  sentence; the longest context with enough occurrences decides.
* ``empty``: nothing, or nothing but labels, fillers and signs.

Contexts are counted in all answers, but only those that some unmarked answer ends
in: these are announced by a bit map of fixed size, counted exactly under 64-bit
keys, and joined back to the answers. No count passes through the driver.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.runtime import cut_lineage

#: Bits of the map that announces contexts to count.
MAP_BITS = 22
CONTEXT_SIZES = (12, 8, 5, 3)
#: Occurrences of a context from which on its share is trusted.
SUPPORT = 6
#: Share of sentence ends below which an unmarked answer counts as broken off.
FINISHED_SHARE = 0.5
#: Compressed bytes beyond the empty frame that a copy may cost, per hundred bytes of answer.
COPY_RATE = 22

# Labels and fillers that are no answer.
_LABEL = r"(?:参考答案|标准答案|答案|解答|解析|解|答|回答|回复|answer|explanation|solution|response|reply|ans|a)"
_FILLER = r"(?:略|无|暂无|空|待补充|待定|未知|没有|同上|n/?a|null|none|nil|tbd|todo|nan|undefined|empty|omitted|unknown|blank|see above|no answer|ok|好的|嗯|呃)"
_EMPTY = re.compile(rf"(?:{_LABEL}|{_FILLER})+", re.I)
_LETTERS = re.compile(r"[^\W_]{1,3}")
_SIGNS = re.compile(r"[\W_]+")
# Labels before a repeated question.
_ECHO = re.compile(r"^(?:你的问题是|您的问题是|您问的是|你问的是|问题是|问题|题目|原题|问|提问|thequestionis|yourquestionis|yourquestionwas|youasked|question|prompt|q|重复一遍问题|答案|answer|答|a)+", re.I)

# How answers are declined.
_DECLINE_ZH = re.compile(
    r"(?:无法|不能|没办法|没法|无从|没有能力|没有权限|不具备[^。]{0,12}能力|不太?方便|不便|难以|恕不|恕难|恕|不会|拒绝|不宜|不可以|未能|帮不了|帮不上|无权|无力|不被允许|不予|没有足够的(?:信息|材料|知识))"
    r"[^。！？!?\n]{0,14}?(?:回答|解答|作答|答复|回应|处理|展开|说明|讨论|提供|协助|帮助|帮您|帮你|帮忙|完成|给出|评论|奉告|受理|满足|执行|响应|继续|谈论|生成)"
)
_DECLINE_ZH_MORE = re.compile(r"超出了?[^。]{0,10}(?:范围|能力)|不在[^。]{0,10}(?:服务|能力|职责|允许)?[^。]{0,4}范围|帮不了您|帮不了你|帮不上忙|无可奉告|请换一?个(?:问题|题目|话题)|(?:请|建议)[^。]{0,4}(?:咨询|请教|询问)[^。]{0,6}老师|作为一?个?(?:人工智能|语言模型|AI)")
_SELF_ZH = re.compile(r"我|本人|本系统|本助手|小助手|系统|助手|模型|AI|此类|该类|这类|这个话题|该内容|这个问题|该问题|这道题|请求|您的|恕")
_OPEN_ZH = re.compile(r"^(?:很|非常|十分|实在|真的)?(?:抱歉|对不起|不好意思|遗憾|请原谅|感谢[^。，]{0,8}|谢谢[^。，]{0,8})(?=[，,。！!、 ])")
_DECLINE_EN = re.compile(
    r"\b(?:I(?:['’]m| am)?(?: \w+)? (?:ca(?:n(?:no|['’])t|nnot)|can not|could not|couldn['’]t|won['’]t|will not|unable|not able|not in a position|must decline|have to decline|decline|refuse|do(?: not|n['’]t) (?:feel comfortable|have (?:enough|sufficient|the ability)))"
    r"|I(?:['’]m| am) (?:\w+ )?(?:unable|not able|not in a position|not allowed|not permitted|not authori[sz]ed)"
    r"|(?:would|is) not (?:be )?(?:appropriate|possible) for me|beyond (?:what|my|the scope)|outside (?:of )?(?:what|my|the scope)|against my (?:guidelines|policy)"
    r"|(?:cannot|can['’]t|won['’]t|unable to|not able to) (?:be )?(?:help|assist|answer|respond|provide|discuss|fulfil|comply|support)|I must decline|I(?:['’]d| would) rather not|not something I can)",
    re.I,
)
_SELF_EN = re.compile(r"\b(?:I|me|my|we|this (?:request|question|topic)|that request|such requests|assistant|model)\b", re.I)

# Commonest words of each language.
_COMMON = {
    "en": "the of and to in is that it was for on are with as be this have from or an by not but at which you they can when what there all will would if about we our should once more your before after i my why do does did how who whose please write explain describe say find give use using between into some any has had were their than then so no yes its also only each other many most",
    "fr": "le la les des de du un une et est à au aux en que qui dans pour sur pas plus ce cette il elle on nous vous se son sa ses avec sont par où peut été depuis très mais ou ne",
    "de": "der die das und ist nicht ein eine den dem des mit von zu im auf für sich auch als wird werden sie es er wir ihr hat war nach bei aus über wurden seit so was jede mich",
    "es": "el la los las de del un una y es en que se por con para su al lo como más pero sus le ya o fue este ha también entre después está son sobre qué no desde era cuál",
}
_COMMON_SETS = {k: frozenset(v.split()) for k, v in _COMMON.items()}
_WORDS = re.compile(r"[^\W\d_]+")
_WIDE = re.compile("[㐀-鿿豈-﫿]")
_WIDE_RUNS = re.compile("[㐀-鿿豈-﫿]+")
_KANA = re.compile("[぀-ヿ]")
_CODE = re.compile(r"```.*?(?:```|$)|~~~.*?(?:~~~|$)|`[^`\n]*`|\$[^$\n]*\$|https?://\S+", re.S)
# Requests for another language, by the language asked for.
_ASKS = (
    ("en", re.compile(r"(?:译成|翻译成|翻译为|译为|翻成|译作)\s*(?:成|为)?\s*英|用英[语文]|英[语文](?:怎么|如何)|(?:in|into|to) english", re.I)),
    ("zh", re.compile(r"(?:译成|翻译成|翻译为|译为|翻成)\s*(?:中|汉)|用[中汉][语文]|(?:in|into|to) (?:chinese|mandarin)", re.I)),
    ("fr", re.compile(r"(?:译成|翻译成|翻译为|译为)\s*法|用法[语文]|(?:in|into|to) french", re.I)),
    ("de", re.compile(r"(?:译成|翻译成|翻译为|译为)\s*德|用德[语文]|(?:in|into|to) german", re.I)),
    ("es", re.compile(r"(?:译成|翻译成|翻译为|译为)\s*西班牙|用西班牙[语文]|(?:in|into|to) spanish", re.I)),
    ("?", re.compile(r"\btranslat|翻译|译成|译为", re.I)),
)

# Words and signs that a finished sentence does not end in.
_DANGLING = re.compile(
    r"(?:[,，、;；:：(（\-–—]|例如|比如|譬如|因为|由于|如果|假如|但是|但|然而|而且|并且|并|以及|或者|所以当|因此|所以|于是|虽然|尽管|即使|只有|只要|除非|不过|同时|此外|另外|其中|以便|从而|当|把|被|将|为了"
    r"|\b(?:the|an|and|or|but|because|since|that|which|who|whose|of|to|with|when|while|if|unless|although|though|as|than|from|into|by|for|for example|such as|in|at|on|so|therefore|however|is|are|was|were|be|has|have|will|would|should|can|must|this|these|those|its|their|our|your|my))$",
    re.I,
)

_FINAL = "。！？.!?…"
# Closing signs, blanks and pictures that may follow a final mark.
_TRAIL = "”’\"'」』）)]】》〉*_` \t\r\n\f\v\u3000\xa0\u200b\ufe0f\u200d" + "".join(map(chr, [*range(0x1F000, 0x1FB00), *range(0x2700, 0x27C0), *range(0xE0000, 0xE0080)]))


def language(text: str) -> str | None:
    """zh, ja, en, fr, de or es, by script and common words; None if there is too little to tell."""
    if "`" in text or "~~~" in text or "$" in text or "http" in text:
        text = _CODE.sub(" ", text)
    wide = 0 if text.isascii() else sum(map(len, _WIDE_RUNS.findall(text)))
    if wide > 8 and 3 * wide >= len(text):
        return "ja" if len(_KANA.findall(text)) > wide else "zh"
    words = [w for w in _WORDS.findall(text.lower()) if w[0] < "ɐ"]
    letters = sum(map(len, words))
    if wide >= 3 and wide * 2 >= letters:
        return "ja" if len(_KANA.findall(text)) > wide else "zh"
    if letters < 8 or len(words) < 3:
        return None
    own = set(words)
    votes = sorted(((len(own & common), k) for k, common in _COMMON_SETS.items()), reverse=True)
    return votes[0][1] if votes[0][0] >= max(1, len(own) // 20) and votes[1][0] < votes[0][0] else None


def asked_language(question: str) -> str | None:
    return next((k for k, p in _ASKS if p.search(question)), None)


def plain(text: str) -> str:
    """Letters and digits only, of one case and width."""
    return _SIGNS.sub("", unicodedata.normalize("NFKC", text).lower())


def is_empty(answer: str | None) -> bool:
    """Nothing, or nothing but signs, labels and fillers."""
    if answer is None:
        return True
    if len(answer) > 60:
        return not plain(answer)
    core = plain(answer)
    if not core:
        return True
    match = _EMPTY.fullmatch(core)
    # a single letter a is a choice unless it is followed by a colon
    return bool(match) and not (core in ("a", "aa") and ":" not in answer and "：" not in answer)


_FRAME = len(zstandard.ZstdCompressor(level=1, write_checksum=False, write_content_size=False).compress(b""))


def copy_cost(question: bytes, answer: bytes) -> int:
    """Bytes that the answer costs beyond an empty frame, with the question as dictionary."""
    d = zstandard.ZstdCompressionDict(question, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    c = zstandard.ZstdCompressor(level=3, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)
    return len(c.compress(answer)) - _FRAME


def is_copy(question: str, answer: str) -> bool:
    """The answer is the question or its stem, once or more, at most with a label."""
    if len(answer) > 2.5 * len(question) + 40:
        return False
    # whatever else it holds, a copy holds the question's first letters
    head = _LETTERS.search(question)
    if head is None or unicodedata.normalize("NFKC", head.group()).lower() not in unicodedata.normalize("NFKC", answer).lower():
        return False
    q, a = plain(question), plain(answer)
    if len(a) < 6 or not q:
        return False
    raw = a.encode()
    # short questions lie below the compressor's shortest useful match; then only the exact check speaks
    if len(q) >= 8 and copy_cost(q.encode(), raw) > 14 + COPY_RATE * len(raw) / 100:
        return False
    stem = plain(re.split(r"\n|(?<=[？?。])", question.strip(), maxsplit=1)[0])
    core = _ECHO.sub("", a) if not q.startswith(a[:4]) else a
    if core == q:
        return True
    whole = plain(question)
    rest = core
    for part in (whole, stem):
        if len(part) >= 6:
            rest = rest.replace(part, "")
    covered = len(core) - len(rest)
    return covered >= 6 and len(_ECHO.sub("", rest)) <= max(2, len(core) // 25) or (len(core) >= 0.6 * len(q) and core in q and q.startswith(core[:6]))


def is_refusal(answer: str) -> bool:
    """The answer as a whole declines: it is short and its opening says so."""
    text = answer.strip()
    if len(text) > 400:
        return False
    head = "".join(re.split(r"(?<=[。！？!?.\n])", text)[:3])
    if _WIDE.search(head):
        opened = _OPEN_ZH.search(text)
        first = re.split(r"[。！？!?\n]", text)[0] if not opened else head
        if _DECLINE_ZH.search(first) and (opened or _SELF_ZH.search(first)):
            return len(text) <= 160
        return bool(_DECLINE_ZH_MORE.search(first) and (opened or _SELF_ZH.search(first))) and len(text) <= 160
    match = _DECLINE_EN.search(head)
    return bool(match) and bool(_SELF_EN.search(head))


_CUT_NUMBER = re.compile(r"[一-鿿]\d+\.$")
_DECIMAL = re.compile(r"\d+\.\d+")
_NUMBER = re.compile(r"\d+")
_BLANKS = re.compile(r"\s{2,}|[^\S \x01\x02]")


def context_form(text: str) -> str:
    """Text as contexts are counted: numbers by kind only, blanks alike."""
    return _BLANKS.sub(" ", _NUMBER.sub("0", _DECIMAL.sub("\x03", text)))


def _rolling(codes: np.ndarray, size: int) -> np.ndarray:
    """64-bit key of the ``size`` code points that end at each place (from ``size - 1`` on)."""
    n = len(codes) - size + 1
    h = np.full(n, size, np.uint64)
    for j in range(size):
        h = h * np.uint64(0x100000001B3) + codes[j : j + n]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    return h ^ h >> np.uint64(32)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


_FINAL_CODES = np.array([ord(c) for c in _FINAL] + [2], np.uint64)


def answers_of(pairs: list | None) -> Iterator[tuple[int, str | None, str | None, bool]]:
    """``(pair_no, question, answer, answered)`` of each user message of ``(role, content)`` messages."""
    no = 0
    for k, (role, content) in enumerate(pairs or ()):
        if role == "user":
            no += 1
            answered = k + 1 < len(pairs) and pairs[k + 1][0] == "assistant"
            yield no, content, pairs[k + 1][1] if answered else None, answered


def messages_of(column: pa.ListArray) -> Iterator[list]:
    """The ``(role, content)`` messages of each row of an Arrow list of structs."""
    flat = column.flatten()
    both = list(zip(flat.field("role").to_pylist(), flat.field("content").to_pylist()))
    ends = column.value_lengths().fill_null(0).to_pylist()
    at = 0
    for n in ends:
        yield both[at : at + n]
        at += n


def tail_keys(answer: str) -> list[int] | None:
    """Keys of the contexts an unmarked answer ends in, longest first; None where its end shows a mark."""
    stripped = answer.rstrip()
    if stripped.endswith(("```", "~~~")):
        return None
    text = answer.rstrip(_TRAIL)
    # a point behind a number that follows a wide character is a decimal point, not a mark
    if not text or (text[-1] in _FINAL and not _CUT_NUMBER.search(text[-16:])):
        return None
    form = context_form(text[-80:])
    if len(text) < 80:
        form = f"\x01{form}"
    codes = _points(form)
    return [int(_rolling(codes[-size:], size)[0].astype(np.int64)) for size in CONTEXT_SIZES if len(form) >= size]


def count_contexts(df: DataFrame, wanted: DataFrame, pairs_column: str = "qa_pairs") -> DataFrame:
    """``(key, seen, ends)``: occurrences of contexts in all answers, and how many of them end a sentence.

    ``wanted`` has the keys to count in its column ``key``; a few others may come along.
    """

    def announce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = np.zeros(1 << MAP_BITS, bool)
        for batch in batches:
            have[batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - MAP_BITS)] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(have).astype(np.int32))], names=["bucket"])

    buckets = wanted.select("key").mapInArrow(announce, "bucket int").distinct().toArrow().column("bucket").to_numpy()
    have = np.zeros(1 << MAP_BITS, bool)
    have[buckets] = True
    shared = df.sparkSession.sparkContext.broadcast(np.packbits(have))
    source = df.select(F.col(pairs_column).alias("p")).where(F.size("p") > 0)
    answers = source.select(F.explode(F.filter("p", lambda m: (m["role"] == "assistant") & (F.length(m["content"]) > 0))).alias("m")).select(F.col("m.content").alias("t"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            # \x02 stands for an end without a mark, \x01 for the start
            codes = _points(context_form("".join([f"\x01{t.rstrip(_TRAIL)}\x02" for t in batch.column(0).to_pylist()])))
            keys, finals = [], []
            for size in CONTEXT_SIZES:
                if len(codes) > size:
                    at = _rolling(codes[:-1], size)
                    hit = have[at >> np.uint64(64 - MAP_BITS)]
                    keys.append(at[hit].view(np.int64))
                    finals.append(np.isin(codes[size:][hit], _FINAL_CODES))
            if keys:
                key, where = np.unique(np.concatenate(keys), return_inverse=True)
                seen = np.bincount(where, minlength=len(key))
                ends = np.bincount(where, np.concatenate(finals), len(key)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(seen), pa.array(ends)], names=["key", "seen", "ends"])

    return answers.mapInArrow(count, "key bigint, seen bigint, ends bigint").groupBy("key").agg(F.sum("seen").alias("seen"), F.sum("ends").alias("ends"))


def defect_of(question: str | None, answer: str | None, answered: bool) -> str | None:
    """The defect of one pair as far as the pair alone shows it, or None."""
    if not answered or is_empty(answer):
        return "empty"
    question = question or ""
    if is_copy(question, answer):
        return "copies_question"
    if is_refusal(answer):
        return "refusal"
    # plain Latin letters without any common word: a terse English question
    terse = question.isascii() and len(_WORDS.findall(question)) >= 3
    asked, own = language(question) or ("en" if terse else None), language(answer)
    if asked and own and own != asked:
        wanted = asked_language(question)
        if wanted is None or (wanted not in ("?", own)):
            return "other_language"
    if answer.count("```") % 2 or answer.count("~~~") % 2 or _DANGLING.search(answer.rstrip()[-24:]):
        return "truncated"
    return None


def defective_pairs(df: DataFrame, id_column: str = "qa_id", pairs_column: str = "qa_pairs") -> DataFrame:
    """One row per defective pair: the id, pair_no (user messages from 1) and defect.

    Null and empty arrays hold no pair; a null question is an empty one; null messages
    are passed over as messages of no role; rows delivered twice count once, of
    rows that share an id and differ each pair is judged; an empty table gives no rows;
    other columns are not read. Two scans; only keys and counts are shuffled.
    """
    source = df.select(df[id_column], F.col(pairs_column).alias("__pairs")).where(F.size("__pairs") > 0)
    kind = source.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, numbers, defects, tails = [], [], [], []
            for k, pairs in enumerate(messages_of(batch.column(1))):
                for no, question, answer, answered in answers_of(pairs):
                    defect = defect_of(question, answer, answered)
                    keys = None if defect else tail_keys(answer)
                    if defect or keys is not None:
                        at.append(k)
                        numbers.append(no)
                        defects.append(defect)
                        tails.append(keys)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(numbers, pa.int64()), pa.array(defects, pa.string()), pa.array(tails, pa.list_(pa.int64()))], names=["id", "pair_no", "defect", "keys"]
            )

    judged = cut_lineage(source.mapInArrow(run, f"id {kind}, pair_no bigint, defect string, keys array<bigint>"))
    unmarked = judged.where(F.col("defect").isNull()).select("id", "pair_no", "keys", F.posexplode("keys").alias("rank", "key"))
    counts = count_contexts(df, unmarked, pairs_column).where(F.col("seen") >= SUPPORT)
    # the longest context that is met often enough decides; an end never met often is no sentence's end
    verdicts = (
        unmarked.join(counts, "key", "left")
        .groupBy("id", "pair_no", "keys")
        .agg(F.min_by(F.col("ends") / F.col("seen"), F.when(F.col("seen").isNotNull(), F.col("rank"))).alias("share"))
        .where(F.coalesce("share", F.lit(0.0)) < FINISHED_SHARE)
    )
    told = judged.where(F.col("defect").isNotNull()).select("id", "pair_no", "defect")
    return told.unionByName(verdicts.select("id", "pair_no", F.lit("truncated").alias("defect"))).distinct().withColumnRenamed("id", id_column)
