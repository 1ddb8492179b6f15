"""Problem 7: pieces under a size limit that end at natural boundaries and overlap.

Method: recursive bisection. A text longer than ``limit - overlap`` code points
is cut at the strongest boundary near its midpoint; the halves that are still
longer are cut again; at last each piece but the first is lengthened to the left
by the overlap. A piece's core is the part without overlap: the cores follow one
another and together are the text, so the pieces give the whole text.

Strength of boundaries, strongest first: blank line, line end, end of sentence,
end of clause, white space, and between two Chinese characters or next to a
sign. Within a third of the span around the midpoint the strongest boundary
wins, the nearest among equals; if that zone has none, the nearest boundary of
the whole span does. Only a span without any boundary is cut at the midpoint,
then still not inside a surrogate-free cluster of base and combining marks, and
not between carriage return and line feed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARAGRAPH, LINE, SENTENCE, CLAUSE, SPACE, SIGN = 6, 5, 4, 3, 2, 1
_SENTENCE_WIDE = np.array([ord(c) for c in "。！？…‼⁇"], np.uint32)
_SENTENCE_NARROW = np.array([ord(c) for c in ".!?"], np.uint32)
_CLAUSE_WIDE = np.array([ord(c) for c in "，、；："], np.uint32)
_CLAUSE_NARROW = np.array([ord(c) for c in ",;:"], np.uint32)
_CLOSING = np.array([ord(c) for c in "”’」』》）】〉\"')]}"], np.uint32)
_BLANK = np.array([ord(c) for c in " \t　   ​"], np.uint32)


def _glued(codes: np.ndarray) -> np.ndarray:
    """Whether a character clings to the one before (marks, joiners, selectors, skin tones)."""
    c = codes
    marks = ((c >= 0x300) & (c < 0x370)) | ((c >= 0x20D0) & (c < 0x2100)) | ((c >= 0xFE00) & (c < 0xFE10)) | ((c >= 0x1F3FB) & (c <= 0x1F3FF)) | (c == 0x200D)
    glued = marks.copy()
    glued[1:] |= c[:-1] == 0x200D
    flag = (c >= 0x1F1E6) & (c <= 0x1F1FF)
    if flag.any():
        run = np.zeros(len(c), np.int64)
        at = np.flatnonzero(flag)
        starts = np.r_[True, np.diff(at) > 1]
        first = at[starts][np.cumsum(starts) - 1]
        run[at] = at - first
        glued |= flag & (run % 2 == 1)
    glued[1:] |= (c[:-1] == 13) & (c[1:] == 10)
    return glued


def boundary_strengths(text: str) -> np.ndarray:
    """``s[i]`` is the strength of a cut before code point ``i`` (0: no natural boundary, -1: never)."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(codes)
    s = np.zeros(n + 1, np.int8)
    if n < 2:
        return s
    before, after = codes[:-1], codes[1:]
    cut = np.zeros(n - 1, np.int8)
    wide = (codes >= 0x2E80) & (codes < 0xFB00) | (codes >= 0xFF00) & (codes < 0xFFF0)
    word = (codes >= 48) & (codes < 58) | (codes >= 65) & (codes < 91) | (codes >= 97) & (codes < 123) | (codes >= 0xC0) & ~wide
    blank_after = np.isin(after, _BLANK) | (after == 10) | (after == 13)
    cut[wide[:-1] | wide[1:] | ~word[:-1] & ~np.isin(after, _CLOSING)] = SIGN
    blank_before = np.isin(before, _BLANK)
    cut[blank_before & ~blank_after] = SPACE
    end = np.zeros(n, np.int8)
    end[np.isin(codes, _CLAUSE_WIDE)] = CLAUSE
    end[np.isin(codes, _SENTENCE_WIDE)] = SENTENCE
    narrow = np.zeros(n, np.int8)
    narrow[np.isin(codes, _CLAUSE_NARROW)] = CLAUSE
    narrow[np.isin(codes, _SENTENCE_NARROW)] = SENTENCE
    closing = np.isin(codes, _CLOSING)
    # what ends inside closing quotes or brackets ends behind them
    for _ in range(3):
        carry = closing[1:]
        end[1:][carry] = np.maximum(end[1:][carry], end[:-1][carry])
        narrow[1:][carry] = np.maximum(narrow[1:][carry], narrow[:-1][carry])
    inner = closing[1:] | np.isin(after, _SENTENCE_WIDE)
    strong = np.where(inner, 0, end[:-1])
    cut = np.maximum(cut, strong.astype(np.int8))
    spaced = blank_before.copy()
    spaced[0] = False
    behind = np.zeros(n - 1, np.int8)
    behind[1:] = narrow[:-2]
    cut = np.where(spaced & ~blank_after, np.maximum(cut, behind), cut)
    newline = before == 10
    cut[newline] = LINE
    cut[newline & (np.r_[0, codes[:-2]] == 10)] = PARAGRAPH
    cut[(after == 10) & (cut < LINE)] = 0
    cut[newline & (after == 10)] = 0
    cut[_glued(codes)[1:]] = -1
    s[1:n] = cut
    return s


def bisect(length: int, strengths: np.ndarray, limit: int) -> list[int]:
    """Ends of the cores, each at most ``limit`` long, by recursive bisection."""
    natural = np.flatnonzero(strengths[:length] > 0)
    ends: list[int] = []
    spans = [(0, length)]
    while spans:
        low, high = spans.pop()
        if high - low <= limit:
            ends.append(high)
            continue
        mid = (low + high) // 2
        reach = max(1, (high - low) // 6)
        a, b = np.searchsorted(natural, (max(low + 1, mid - reach), min(high - 1, mid + reach) + 1))
        if a < b:
            near = natural[a:b]
            best = near[np.lexsort((np.abs(near - mid), -strengths[near].astype(np.int64)))[0]]
        else:
            a, b = np.searchsorted(natural, (low + 1, high))
            near = natural[a:b]
            best = near[np.argmin(np.abs(near - mid))] if a < b else mid
            if a == b:
                while best > low + 1 and strengths[best] < 0:
                    best -= 1
        spans += [(int(best), high), (low, int(best))]
    return ends


def pieces(text: str, limit: int, overlap: int) -> list[tuple[int, int, int]]:
    """``(start, core_start, end)`` of each piece, in code points from 0."""
    if limit < 1 or overlap < 0 or overlap >= limit:
        raise ValueError("limit must be positive and larger than the overlap")
    n = len(text)
    if n <= limit:
        return [(0, 0, n)]
    out, start = [], 0
    for end in bisect(n, boundary_strengths(text), limit - overlap):
        out.append((max(0, start - overlap), start, end))
        start = end
    return out


def split_texts(df: DataFrame, settings: list[tuple[int, int, int]], id_column: str = "id", text_column: str = "text", *, keep_text: bool = True) -> DataFrame:
    """One row per setting, input row and piece.

    ``settings`` are ``(setting_id, max_chars, overlap_chars)``; limits are in code
    points. Columns: setting_id, the id, piece_no (from 1), n_pieces, start_at,
    core_start, end_at (from 0, ends exclusive) and with ``keep_text`` the piece's
    text. Texts within the limit give one piece, empty texts one empty piece, null
    texts none. Repeated rows give repeated pieces; other columns are not read.
    Map-only: no shuffle.
    """
    for setting, limit, overlap in settings:
        if limit is None or overlap is None or limit < 1 or not 0 <= overlap < limit:
            raise ValueError(f"setting {setting}: limit {limit}, overlap {overlap}")
    source = df.select(df[id_column], df[text_column].alias("__text")).where(F.col("__text").isNotNull())
    fields = [T.StructField("setting_id", T.IntegerType()), source.schema[0]]
    fields += [T.StructField(c, T.LongType()) for c in ("piece_no", "n_pieces", "start_at", "core_start", "end_at")]
    fields += [T.StructField("piece_text", T.StringType())] if keep_text else []
    shortest = min((limit for _, limit, _ in settings), default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column(0), batch.column(1).to_pylist()
            cols: list[list] = [[] for _ in range(7)]
            texts: list[str] = []
            for k, text in enumerate(rows):
                n = len(text)
                strengths = boundary_strengths(text) if n > shortest else None
                for setting, limit, overlap in settings:
                    ends = [n] if n <= limit else bisect(n, strengths, limit - overlap)
                    start = 0
                    for no, end in enumerate(ends, 1):
                        for col, value in zip(cols, (setting, k, no, len(ends), max(0, start - overlap), start, end)):
                            col.append(value)
                        if keep_text:
                            texts.append(text[max(0, start - overlap) : end])
                        start = end
            out = [pa.array(cols[0], pa.int32()), ids.take(pa.array(cols[1], pa.int64()))]
            out += [pa.array(c, pa.int64()) for c in cols[2:]]
            out += [pa.array(texts, pa.string())] if keep_text else []
            yield pa.RecordBatch.from_arrays(out, names=[f.name for f in fields])

    return source.mapInArrow(run, T.StructType(fields))


def read_settings(settings: DataFrame) -> list[tuple[int, int, int]]:
    """Rows of the settings table; a table of parameters, so its size is a handful."""
    rows: pd.DataFrame = settings.select("setting_id", "max_chars", "overlap_chars").toPandas()
    return [tuple(int(x) for x in row) for row in rows.itertuples(index=False)]
