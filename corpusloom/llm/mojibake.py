"""Problem 10: find text decoded with the wrong character encoding and restore it.

Method: round-trip repair. A stretch is re-encoded under a candidate wrong
encoding and strictly decoded as a candidate right one; nested layers are undone
one after another; a step is taken only when a garbling cost drops. The cost of a
stretch is the sum, over its pairs of neighbouring characters, of how rare the
pair is in the corpus, so a repair must give text that the corpus really writes.

Pair counts cover all documents. They are kept in a table of fixed size (pairs
hashed to ``2**SKETCH_BITS`` counters), so what is sent to the driver and back is
bounded whatever the corpus holds.

Stretches that cannot be restored (replacement characters, bytes of them decoded
again, fill patterns of uninitialised memory) are found by their form and left.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKETCH_BITS = 21
#: Most layers that are undone.
MAX_LAYERS = 4

# Encodings that text is wrongly decoded with, by width.
SINGLE_BYTE = ("cp1252", "latin-1", "iso8859-15", "cp437", "cp850", "mac_roman", "cp1251", "koi8-r", "cp1250")
MULTI_BYTE = ("gb18030", "big5hkscs", "cp949", "cp932")
# Encodings of western text that are taken for one another.
WESTERN = ("cp1252", "mac_roman", "cp850", "cp437", "cp1251", "cp1250")
# East Asian encodings that are taken for one another (wrong, right).
WIDE_FOR_WIDE = (("big5hkscs", "gb18030"), ("gb18030", "big5hkscs"), ("cp949", "gb18030"), ("cp932", "gb18030"), ("gb18030", "cp932"))
# What is left when replacement characters or unset memory are decoded again.
LOST = re.compile("�|锟斤|斤拷|ï¿½|烫烫|屯屯|锘�")


def byte_image(codec: str) -> list[str]:
    """The character of each byte; bytes that the codec leaves undefined stand for themselves."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(codec))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


def _set(chars) -> str:
    return "[" + "".join(re.escape(c) for c in sorted(set(chars))) + "]"


class SingleByte:
    """Re-encoding under one single-byte codec, with patterns for what it garbles."""

    def __init__(self, codec: str):
        image = byte_image(codec)
        self.codec = codec
        self.back = {c: b for b, c in reversed(list(enumerate(image)))}
        lead2, lead3, lead4, tail = image[0xC2:0xE0], image[0xE0:0xF0], image[0xF0:0xF5], image[0x80:0xC0]
        self.leads = frozenset(lead2 + lead3 + lead4)
        self.tails = frozenset(tail)
        t = _set(tail)
        self.utf8 = re.compile(f"(?:{_set(lead2)}{t}|{_set(lead3)}{t}{t}|{_set(lead4)}{t}{t}{t})+")
        self.pairs = re.compile(f"{_set(image[0xA1:0xFF])}{{4,}}")
        self.high = frozenset(image[0xA1:0xFF])
        self.upper = _set(image[0x80:])

    def encode(self, s: str) -> bytes:
        return bytes(self.back[c] for c in s)


_single: dict[str, SingleByte] = {}


def single(codec: str) -> SingleByte:
    if codec not in _single:
        _single[codec] = SingleByte(codec)
    return _single[codec]


#: Western letters where one code page was taken for another: a capital inside a small word, a sign or a
#: letter of another script that touches a small Latin letter.
_MISPLACED = re.compile("(?<=[a-z])(?:[À-ÖØ-ÞŒŠŽŸ¡-§©-¯±-¶¸-¿×÷‚ƒ„†-‰‹›Ͱ-ӿ∂-≿─-◿ˆ˜])(?=[a-zß-ÿ])|(?<![A-Za-zÀ-ÿ])[‚ƒ†‡ˆ‰Ͱ-ϿЀ-ӿ√∂-≿Ú](?=[a-z]{2})|(?<=[a-z]{2})[‚ƒ†‡ˆ‰Ͱ-ϿЀ-ӿÈÉÚŽ√‡](?![A-Za-zÀ-ÿͰ-Ͽ])|(?<![A-Za-zÀ-ӿ])(?:ì(?=[A-Z])|[‹∞░](?=[A-Za-z]))")
#: Neighbours that a single-byte codec may have made of one character, and of two East Asian ones.
_TWO_HIGH = re.compile("[\x80-\u2fff\ufb00-\ufb0f\uf8ff]{2}")
_FOUR_HIGH = re.compile("[\x80-\u2fff\ufb00-\ufb0f\uf8ff]{4}")
_UTF8_RUN = re.compile(rb"(?:[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}){2,}")
_WIDE_RUN = re.compile("[^\x00-\x7f-ÿ]{3,}")
_NOT_ASCII = re.compile("[^\x00-\x7f]")


def _uncommon_table() -> np.ndarray:
    """Wide characters beyond the everyday ones: level 1 of GB 2312, its signs, and full-width forms."""
    table = np.zeros(0x110000, bool)
    table[0x2E80:] = True
    table[0x250:0x2000] = True
    table[0x2190:0x2E80] = True
    for lead in [0xA1, 0xA3, *range(0xB0, 0xD8)]:
        for tail in range(0xA1, 0xFF):
            try:
                table[ord(bytes([lead, tail]).decode("gb2312"))] = False
            except UnicodeDecodeError:
                continue
    table[0x1F000:0x20000] = False
    return table


_UNCOMMON = _uncommon_table()


def pair_hash(codes: np.ndarray) -> np.ndarray:
    """Counter of each pair of neighbours in an array of code points."""
    mixed = codes[:-1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ codes[1:].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def pair_counts(df: DataFrame, text_column: str = "text") -> np.ndarray:
    """Counts of all character pairs that are not both ASCII, over the whole corpus."""
    texts = df.select(df[text_column].alias("t")).where(F.col("t").isNotNull())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            codes = code_points("\0".join(batch.column(0).to_pylist()))
            if len(codes) > 1:
                keep = (codes[:-1] > 127) | (codes[1:] > 127)
                total += np.bincount(pair_hash(codes)[keep], minlength=len(total))
        at = np.flatnonzero(total)
        for k in range(0, len(at), 200_000):
            part = at[k : k + 200_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], names=["bucket", "n"])

    rows = texts.mapInArrow(count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << SKETCH_BITS, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def pair_costs(counts: np.ndarray) -> np.ndarray:
    """Bits of surprise per counter, in sixteenths of a bit up to 16 bits; unseen pairs cost most."""
    total = max(1, int(counts.sum()))
    bits = np.log2((total + 1.0) / (counts + 0.25))
    least = np.log2((total + 1.0) / (counts.max(initial=0) + 0.25))
    scaled = (bits - least) / max(1e-9, np.log2((total + 1.0) / 0.25) - least)
    return np.clip(scaled * 255, 0, 255).astype(np.uint8)


class Repairer:
    """Finds and undoes wrong decodings in single texts, given pair costs."""

    def __init__(self, costs: np.ndarray):
        self.costs = costs
        self._known: dict[tuple[str, str, str], float] = {}

    def cost(self, before: str, s: str, after: str) -> float:
        """Sum of the costs of the pairs in ``s`` and at its two ends; pairs of ASCII cost little."""
        if len(s) > 8:
            return self._cost(before, s, after)
        key = (before, s, after)
        known = self._known.get(key)
        if known is None:
            if len(self._known) > 200_000:
                self._known.clear()
            known = self._known[key] = self._cost(before, s, after)
        return known

    def _cost(self, before: str, s: str, after: str) -> float:
        codes = code_points(f"{before or chr(0)}{s}{after or chr(0)}")
        costs = self.costs[pair_hash(codes)].astype(np.float64) / 255
        both = (codes[:-1] < 128) & (codes[1:] < 128)
        costs[both] = 0.15
        control = (codes[1:-1] >= 0x80) & (codes[1:-1] < 0xA0) | (codes[1:-1] >= 0xE000) & (codes[1:-1] < 0xF900) | (codes[1:-1] == 0xFFFD)
        return float(costs.sum() + control.sum())

    def _layer(self, text: str) -> tuple[str, int]:
        """One layer undone wherever that lowers the cost; the number of stretches changed.

        A codec pair after which no candidate is left is taken at once, else the one that gains most.
        """
        best: tuple[float, str, int] | None = None
        for spans, repair, margin in self._candidates(text):
            new, n, gain = self._apply(text, spans, repair, margin)
            if n and n == len(spans) and not _TWO_HIGH.search(new) and not self._wide_spans(new):
                return new, n
            if n and (best is None or gain > best[0]):
                best = (gain, new, n)
        if best is None and _MISPLACED.search(text):
            best = self._western(text)
        return (best[1], best[2]) if best else (text, 0)

    def _candidates(self, text: str):
        """Stretches (each a list of alternative spans) with a repair to try on them and the cost it must get below."""
        if _TWO_HIGH.search(text):
            chars = {c for c in set(text) if c > "\x7f"}
            four = _FOUR_HIGH.search(text)
            for codec in SINGLE_BYTE:
                w = single(codec)
                if chars & w.leads and chars & w.tails:
                    yield [[m.span()] for m in w.utf8.finditer(text)], lambda s, w=w: w.encode(s).decode("utf-8"), 0.75
                if four and len(chars & w.high) >= 4:
                    spans = [[m.span()] for m in w.pairs.finditer(text)]
                    for right in ("gb18030", "big5hkscs") if spans else ():
                        yield spans, lambda s, w=w, r=right: self._wide_pairs(w.encode(s), r), 0.6
        spans = self._wide_spans(text)
        if spans:
            for codec in MULTI_BYTE:
                if _UTF8_RUN.search(text.encode(codec, "replace")):
                    yield spans, lambda s, c=codec: self._through(s, c, "utf-8"), 0.7
            for wrong, right in WIDE_FOR_WIDE:
                yield spans, lambda s, w=wrong, r=right: self._through(s, w, r), 0.55

    @staticmethod
    def _wide_spans(text: str) -> list[list[tuple[int, int]]]:
        """Wide runs with two uncommon characters close together: the whole, and from the first to the last of these."""
        odd = _UNCOMMON[code_points(text)]
        near = odd[:-1] & odd[1:]
        near[:-1] |= odd[:-2] & odd[2:]
        if not near.any():
            return []
        at, out = np.flatnonzero(odd), []
        for m in _WIDE_RUN.finditer(text):
            a, b = m.span()
            low, high = np.searchsorted(at, (a, b))
            if high - low < 2 or not near[a : b - 1].any():
                continue
            first, last = int(at[low]), int(at[high - 1]) + 1
            spans = [(a, b)]
            if last - first >= 3 and (first, last) != (a, b):
                spans += [(first, last)] + ([(first - 1, last)] if first > a else []) + ([(first, last + 1)] if last < b else [])
            out.append(spans)
        return out

    def _apply(self, text: str, stretches: list[list[tuple[int, int]]], repair, margin: float) -> tuple[str, int, float]:
        out, at, n, gain = [], 0, 0, 0.0
        for spans in stretches:
            for a, b in spans:
                old = text[a:b]
                try:
                    new = repair(old)
                except (UnicodeError, KeyError):
                    continue
                if new is None or new == old or "\0" in new:
                    continue
                before, after = text[a - 1 : a], text[b : b + 1]
                was, now = self.cost(before, old, after), self.cost(before, new, after)
                if now < margin * was:
                    gain += was - now
                    out += [text[at:a], new]
                    at, n = b, n + 1
                    break
        return ("".join(out) + text[at:] if n else text), n, gain

    @staticmethod
    def _wide_pairs(raw: bytes, right: str) -> str | None:
        if len(raw) % 2:
            return None
        new = raw.decode(right)
        return new if len(new) * 2 == len(raw) else None

    @staticmethod
    def _through(s: str, wrong: str, right: str) -> str | None:
        """Re-encode; where the ends of the run lost bytes, only what decodes strictly is replaced."""
        raw = s.encode(wrong)
        if right != "utf-8":
            return raw.decode(right)
        m = _UTF8_RUN.search(raw)
        if not m or m.end() - m.start() < 0.6 * len(raw):
            return None
        parts, at = [], 0
        for m in _UTF8_RUN.finditer(raw):
            parts.append(raw[at : m.start()].decode(wrong, "replace"))
            parts.append(m.group().decode("utf-8"))
            at = m.end()
        parts.append(raw[at:].decode(wrong, "replace"))
        return "".join(parts)

    def _western(self, text: str):
        """Letters of one western code page taken for another's, over all such letters of the text."""
        best = None
        runs = [m.span() for m in _MISPLACED.finditer(text)]
        for wrong in WESTERN:
            w = single(wrong)
            for right in WESTERN:
                if right == wrong:
                    continue
                out, at, n, gain = [], 0, 0, 0.0
                for a, b in runs:
                    try:
                        new = w.encode(text[a:b]).decode(right)
                    except (UnicodeError, KeyError):
                        continue
                    before, after = text[a - 1 : a], text[b : b + 1]
                    old_cost, new_cost = self.cost(before, text[a:b], after), self.cost(before, new, after)
                    if new_cost < 0.6 * old_cost and new.isprintable():
                        out += [text[at:a], new]
                        at, n, gain = b, n + 1, gain + old_cost - new_cost
                if n and (best is None or gain > best[0]):
                    best = (gain, "".join(out) + text[at:], n)
        return best

    def repair(self, text: str | None) -> tuple[str | None, int, int, bool]:
        """The restored text, the layers and stretches undone, and whether garbling remains."""
        if not text or not _NOT_ASCII.search(text):
            return text, 0, 0, False
        layers = stretches = 0
        while layers < MAX_LAYERS:
            new, n = self._layer(text)
            if not n:
                break
            text, layers, stretches = new, layers + 1, stretches + n
        return text, layers, stretches, LOST.search(text) is not None


def repair_texts(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", *, costs: np.ndarray | None = None) -> DataFrame:
    """Garbled rows only: id, restored text, layers, stretches, lost.

    ``lost`` tells that part of the text cannot be restored. Null and empty texts are
    never garbled; repeated rows stay repeated; an empty table gives no rows; other
    columns are not read. Two scans, no shuffle of texts.
    """
    spark = df.sparkSession
    if costs is None:
        costs = pair_costs(pair_counts(df, text_column))
    shared = spark.sparkContext.broadcast(costs)
    source = df.select(df[id_column], df[text_column].alias("__text")).where(F.col("__text").isNotNull())
    kind = source.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer = Repairer(shared.value)
        for batch in batches:
            at, rows = [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                new, layers, stretches, lost = repairer.repair(text)
                if layers or lost:
                    at.append(k)
                    rows.append((new, layers, stretches, lost))
            cols = list(zip(*rows)) or [[], [], [], []]
            arrays = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names=[id_column, "restored", "layers", "stretches", "lost"])

    return source.mapInArrow(run, f"`{id_column}` {kind}, restored string, layers int, stretches int, lost boolean")
