"""Problem 8: exact ids of a public byte-level BPE tokenizer for a whole corpus.

Method: per-prefix dynamic programming. An Aho-Corasick automaton over the
vocabulary yields the tokens that end at each byte (the suffix matches of each
prefix). Among them exactly one can be the last token of the prefix's encoding:
the one whose own prefix ends in a token it is compatible with. That token is
stored for every prefix; following the back-pointers from the end gives the ids
that the merge loop of the tokenizer would give, in linear time even for a
single word of megabytes.

Two facts keep the inner loop off the hot path without changing any id: no merge
crosses a pretoken, and no merge crosses a byte pair that occurs in no token of
the vocabulary. Pieces between such places are encoded once per worker and
remembered in bounded memories.

The vocabulary is read from its file on each worker; it is neither copied into
the repository nor broadcast. Null and empty texts get an empty list.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Words and pieces remembered per worker; beyond it a memory starts anew.
MEMORY_ENTRIES = 400_000


def default_vocabulary(name: str = "byte_bpe_50k") -> str:
    """Path of a vocabulary of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.tiktoken")


def default_pattern() -> str:
    """Pretoken pattern of the installed public byte-level tokenizers."""
    import public_tokenizers

    return public_tokenizers.PATTERN


class ByteBpe:
    """Exact encoder for a rank file of base64 tokens (one ``token rank`` per line)."""

    def __init__(self, vocabulary: str, pattern: str):
        with open(vocabulary, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.ids = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.pretokens = regex.compile(pattern).findall
        self.joins = {}
        self.parts = {}
        self._compatible: dict[tuple[int, int], bool] = {}
        self._derive_merges()
        self.inner = {pair for token in self.ids for pair in zip(token, token[1:])}
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.ids.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()
        self._words: dict[str, tuple[int, ...]] = {}
        self._pieces: dict[bytes, tuple[int, ...]] = {}

    def _derive_merges(self) -> None:
        """The pair that each token is merged from, learned in rank order.

        Of all cuts of a token into two earlier tokens, its merge is the one at
        which the two are neighbours in the encoding by earlier ranks alone.
        """
        for token, rank in sorted(self.ids.items(), key=lambda x: x[1]):
            if len(token) == 1:
                continue
            for cut in range(len(token) - 1, 0, -1):
                left, right = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if left is not None and right is not None and max(left, right) < rank and self._fit(left, right):
                    self.parts[rank] = (left, right)
                    self.joins[left, right] = rank
                    break
        self._compatible.clear()

    def _fit(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart when their bytes are encoded together.

        Undo merges on both sides of the border, latest first; if at some point
        the border tokens would have merged earlier than what they are part of,
        the pair is impossible.
        """
        bound = 1 << 60
        while True:
            merged = self.joins.get((left, right))
            if merged is not None and merged < bound:
                return False
            whole_left, whole_right = self.parts.get(left), self.parts.get(right)
            if whole_left is None and whole_right is None:
                return True
            undo_left = whole_right is None or (whole_left is not None and left > right)
            if undo_left:
                bound, left = left, whole_left[1]
            else:
                # at equal rank the left merge comes first, hence the border may still use it
                bound, right = right + 1, whole_right[0]

    def compatible(self, left: int, right: int) -> bool:
        known = self._compatible.get((left, right))
        if known is None:
            if len(self._compatible) > MEMORY_ENTRIES:
                self._compatible.clear()
            known = self._compatible[left, right] = self._fit(left, right)
        return known

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        """Ids of bytes that no pretoken border cuts, by the dynamic programme."""
        whole = self.ids.get(piece)
        if whole is not None:
            return (whole,)
        n = len(piece)
        last = [-1] * n
        size = [0] * n
        compatible = self.compatible
        for end, (length, token) in self.automaton.iter(piece.decode("latin-1")):
            # matches at one end come longest first; the first that fits is the only one
            if last[end] >= 0:
                continue
            before = end - length
            if before < 0 or (last[before] >= 0 and compatible(last[before], token)):
                last[end], size[end] = token, length
        out = []
        at = n - 1
        while at >= 0:
            if last[at] < 0:
                raise ValueError("the vocabulary lacks a single-byte token of the text")
            out.append(last[at])
            at -= size[at]
        return tuple(reversed(out))

    def encode_word(self, word: str) -> tuple[int, ...]:
        raw = word.encode("utf-8", "surrogatepass")
        whole = self.ids.get(raw)
        if whole is not None:
            return (whole,)
        inner, pieces = self.inner, self._pieces
        if len(pieces) > MEMORY_ENTRIES:
            pieces.clear()
        out: list[int] = []
        start = 0
        for at in range(1, len(raw) + 1):
            if at == len(raw) or (raw[at - 1], raw[at]) not in inner:
                piece = raw[start:at]
                ids = pieces.get(piece)
                if ids is None:
                    ids = self.encode_piece(piece)
                    if len(piece) <= 64:
                        pieces[piece] = ids
                out.extend(ids)
                start = at
        return tuple(out)

    def encode(self, text: str | None) -> list[int]:
        """Ids of ``text`` without special tokens; their strings are ordinary text."""
        if not text:
            return []
        words = self._words
        if len(words) > MEMORY_ENTRIES:
            words.clear()
        found = []
        for word in self.pretokens(text):
            ids = words.get(word)
            if ids is None:
                ids = self.encode_word(word)
                if len(word) <= 64:
                    words[word] = ids
            found.append(ids)
        return list(chain.from_iterable(found))


_encoders: dict[tuple[str, str], ByteBpe] = {}


def encoder(vocabulary: str, pattern: str) -> ByteBpe:
    """The encoder of this worker process, built once."""
    key = (vocabulary, pattern)
    if key not in _encoders:
        _encoders[key] = ByteBpe(vocabulary, pattern)
    return _encoders[key]


def encode_corpus(df: DataFrame, id_column: str, text_column: str = "text", *, vocabulary: str | None = None, pattern: str | None = None, ids_column: str = "ids", count_only: bool = False) -> DataFrame:
    """One row per input row: ``id_column`` and the token ids of the text.

    With ``count_only`` the column holds their number (bigint) instead. Null and
    empty texts give an empty list (or 0); repeated rows stay repeated; a null id
    stays null; other columns are not read. Map-only: no shuffle.
    """
    vocabulary = vocabulary or default_vocabulary()
    pattern = pattern or default_pattern()
    source = df.select(df[id_column], df[text_column].alias("__text"))
    kind = T.LongType() if count_only else T.ArrayType(T.IntegerType())
    schema = T.StructType([source.schema[0], T.StructField(ids_column, kind)])
    to_type = pa.int64() if count_only else pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, pattern).encode
        for batch in batches:
            rows = (encode(text) for text in batch.column(1).to_pylist())
            if count_only:
                made = pa.array([len(ids) for ids in rows], to_type)
            else:
                values, ends = [], [0]
                for ids in rows:
                    values.extend(ids)
                    ends.append(len(values))
                made = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), made], names=[id_column, ids_column])

    return source.mapInArrow(run, schema)
