"""Problem 4: the reading band of each document, on the scale of graded passages.

Method: familiar-word formula. A document is measured by the share of its words
outside lists of familiar words, plus its average sentence length. The lists come
from document frequencies over the whole corpus: list ``k`` has the words that a
set share of the corpus documents with sentences up to length tier ``k`` contain,
so a word is familiar at the level whose readers meet it often. Words are letter
runs, and overlapping character pairs where a script writes no spaces.

Document frequencies are kept per tier in tables of fixed size (words hashed to
``2**HASH_BITS`` counters), so what is sent to the driver and back is bounded.
The graded passages give the tiers and, by a least-squares fit on their few
rows, the weights of the formula; texts without sentence marks are placed by a
second fit on the shares alone.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HASH_BITS = 19
TIERS = 4
#: A word is familiar in a tier if at least this share of the tier's documents has it.
FAMILIAR_SHARES = (0.004, 0.03)
#: A text whose sentences are this many times longer than in any graded passage has no sentence marks.
UNMARKED = 1.6

_WIDE = re.compile("[぀-ヿ㐀-鿿豈-﫿]+")
_WORD = re.compile("[A-Za-zÀ-ÖØ-öø-ÿͰ-ӿ]+(?:[’'][A-Za-z]+)?")
_END = re.compile("[。！？…；]+[”’」』）)]*|[.!?]+[”’\"')]*(?=\\s|$|[^\x00-\x7f])|\\n\\s*\\n")
_MARKS = re.compile(r"[^\w\s]|\n")
_NOISE = re.compile("```.*?```|~~~.*?~~~|\\$\\$.*?\\$\\$|\\$[^$\\n]{1,80}\\$|<[^<>\\n]{1,200}>|https?://\\S+|\\\\[a-zA-Z]+|&[a-z#0-9]{2,8};|!?\\[[^\\]\\n]*\\]\\([^)\\n]*\\)|^[ \\t]*\\|.*$", re.S | re.M)


def average(lengths: np.ndarray) -> float:
    """Average sentence length without the shortest quarter: headings, labels and exclamations say little."""
    return float(np.sort(lengths)[len(lengths) // 4 :].mean())


def words_of(text: str) -> tuple[np.ndarray, bool, np.ndarray]:
    """Hashed words, whether the text is mainly in a script without spaces, and the lengths of its sentences.

    The lengths count characters of such a script, else words.
    """
    text = _NOISE.sub(" ", text)
    runs = _WIDE.findall(text)
    wide = sum(map(len, runs))
    narrow = _WORD.findall(text)
    is_wide = wide > 2 * len(narrow)
    if is_wide:
        joined = _WIDE.findall(text.replace("\n", ""))
        codes = np.frombuffer("\0".join(joined).encode("utf-32-le"), np.uint32)
        keep = (codes[:-1] != 0) & (codes[1:] != 0)
        hashed = ((codes[:-1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ codes[1:].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - HASH_BITS)).astype(np.int64)[keep]
    else:
        hashed = np.fromiter((zlib.crc32(w.lower().encode()) >> (32 - HASH_BITS) for w in narrow), np.int64, len(narrow))
    lengths = []
    for part in _END.split(text):
        n = sum(map(len, _WIDE.findall(part))) if is_wide else len(_WORD.findall(part))
        if n >= (4 if is_wide else 3):
            lengths.append(n)
    return hashed, is_wide, np.array(lengths or [max(1, len(hashed))], float)


class Scale:
    """Graded passages: sentence-length tiers, and the fitted formula, per script."""

    def __init__(self, anchors: pd.DataFrame):
        graded = [(t, int(b)) for t, b in zip(anchors["text"], anchors["band"]) if isinstance(t, str) and t.strip() and b == b]
        if not graded:
            raise ValueError("there are no graded passages")
        self.rows = [(*words_of(t), b) for t, b in graded]
        # the same passages as a text without marks would show them
        self.bare = [(*words_of(_MARKS.sub("", t)), b) for t, b in graded]
        self.edges, self.limit, self.fits = {}, {}, {}
        for script in (True, False):
            own = [r for r in self.rows if r[1] == script] or self.rows
            means = pd.Series([np.log(average(r[2])) for r in own]).groupby([r[3] for r in own]).mean().sort_index()
            values = np.sort(means.to_numpy())
            self.edges[script] = (values[1:] + values[:-1]) / 2
            self.limit[script] = UNMARKED * max(average(r[2]) for r in own)

    def length(self, script: bool, lengths: np.ndarray) -> float | None:
        """Average sentence length over stretches that are sentences; None if most of the text has no marks."""
        real = lengths[lengths <= self.limit[script]]
        return average(real) if 2 * real.sum() >= lengths.sum() else None

    def tier(self, script: bool, length: float) -> int:
        return min(TIERS - 1, int(np.searchsorted(self.edges[script], np.log(length))))

    def fit(self, lists: np.ndarray) -> None:
        """Weights of the formula per script, with and without sentence length, and the band borders."""
        for script in (True, False):
            for marked in (True, False):
                rows = self.rows if marked else self.bare
                own = [r for r in rows if r[1] == script] or rows
                bands = np.array([r[3] for r in own], float)
                x = np.array([self.features(lists, r[0], r[1], average(r[2]) if marked else None) for r in own])
                centre = x.mean(0)
                # ridge regression; the small penalty only keeps collinear shares apart
                a = x - centre
                w = np.linalg.solve(a.T @ a + 0.02 * np.eye(x.shape[1]), a.T @ (bands - bands.mean()))
                score = bands.mean() + a @ w
                levels = np.unique(bands)
                means = np.array([score[bands == b].mean() for b in levels])
                self.fits[script, marked] = (centre, w, bands.mean(), levels, (means[1:] + means[:-1]) / 2)

    def features(self, lists: np.ndarray, hashed: np.ndarray, script: bool, length: float | None) -> np.ndarray:
        own = lists[:, int(script)]
        outside = 1 - own[:, hashed].mean(1) if len(hashed) else np.ones(len(own))
        return np.append(outside, np.log(length)) if length is not None else outside

    def band(self, lists: np.ndarray, hashed: np.ndarray, script: bool, lengths: np.ndarray) -> tuple[int, float, float, float | None]:
        """Band, score, share of words outside the first list, and average sentence length."""
        length = self.length(script, lengths)
        x = self.features(lists, hashed, script, length)
        centre, w, mean, levels, borders = self.fits[script, length is not None]
        score = float(mean + (x - centre) @ w)
        return int(levels[np.searchsorted(borders, score)]), score, float(x[0]), length


def familiar_lists(df: DataFrame, text_column: str, scale: Scale) -> np.ndarray:
    """``lists[l, s, w]``: whether hashed word ``w`` of script ``s`` is in list ``l``, from all documents."""
    texts = df.select(df[text_column].alias("t")).where(F.col("t").isNotNull())
    cells = 2 * TIERS << HASH_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int32)
        documents = np.zeros(2 * TIERS, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                hashed, script, lengths = words_of(text)
                length = scale.length(script, lengths)
                if len(hashed) and length is not None:
                    row = int(script) * TIERS + scale.tier(script, length)
                    documents[row] += 1
                    total[(row << HASH_BITS) + np.unique(hashed)] += 1
        at = np.flatnonzero(total)
        for k in range(0, len(at), 200_000):
            part = at[k : k + 200_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part].astype(np.int64))], names=["cell", "n"])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, -2 * TIERS - 1, -1).astype(np.int32)), pa.array(documents)], names=["cell", "n"])

    rows = texts.mapInArrow(count, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    at, n = rows.column("cell").to_numpy(), rows.column("n").to_numpy()
    documents = np.zeros(2 * TIERS)
    documents[-1 - at[at < 0]] = n[at < 0]
    table = np.zeros(cells)
    table[at[at >= 0]] = n[at >= 0]
    table = table.reshape(2, TIERS, -1)
    rates = table / np.maximum(1, documents.reshape(2, TIERS, 1))
    lists = [rates[:, : k + 1].max(1) >= share for share in FAMILIAR_SHARES for k in range(TIERS - 1)]
    return np.array(lists)


def reading_levels(df: DataFrame, anchors: DataFrame, id_column: str = "id", text_column: str = "text") -> DataFrame:
    """One row per row with a text: id, band, score, share of unfamiliar words, average sentence length.

    Null and blank texts have no row; repeated rows stay repeated; a text without any
    word is placed like one of unfamiliar words only; the average
    length is null where most of the text has no sentence marks; an empty table gives no rows; other
    columns are not read. ``anchors`` is a small table of graded passages (text, band).
    """
    spark = df.sparkSession
    scale = Scale(anchors.select("text", "band").toPandas())
    lists = familiar_lists(df, text_column, scale)
    scale.fit(lists)
    shared = spark.sparkContext.broadcast(np.packbits(lists))
    shape = lists.shape
    source = df.select(df[id_column], df[text_column].alias("__text")).where(F.col("__text").rlike(r"(?U)[^\s]"))
    kind = source.schema[0].dataType.simpleString()
    scale.rows = scale.bare = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.unpackbits(shared.value, count=int(np.prod(shape))).reshape(shape)
        for batch in batches:
            made = []
            for text in batch.column(1).to_pylist():
                made.append(scale.band(own, *words_of(text)))
            cols = list(zip(*made)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cols[0], pa.int32()), *(pa.array(c, pa.float64()) for c in cols[1:])], names=[id_column, "band", "score", "unfamiliar", "sentence_length"])

    return source.mapInArrow(run, f"`{id_column}` {kind}, band int, score double, unfamiliar double, sentence_length double")
