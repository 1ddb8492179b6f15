"""Row filters and the ordered cleaning chain."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as T

# Names of answer sheets, and the name that is none.
ANSWER_SHEETS = ("答题纸", "答题卡", "答题卷", "答卷")
ANSWER_BOOK = "解答卷"


@dataclass(frozen=True)
class CleanOptions:
    """Which cleaners run; their order is fixed. All are off by default."""

    markdown: bool = False
    email: bool = False
    link: bool = False
    ip: bool = False
    control_char: bool = False
    repeat_space: bool = False
    punctuation_clip: bool = False
    text_circled: bool = False
    filename: bool = False
    repeat_char: bool = False
    html: bool = False
    answer_sheet_filter: bool = False
    min_text_length: int = 100

    @classmethod
    def everything(cls, **changes) -> CleanOptions:
        return cls(**({f.name: True for f in fields(cls) if f.type in (bool, "bool")} | changes))


def is_answer_sheet(path: Column) -> Column:
    """The file name is that of an answer sheet; a missing path is not."""
    name = T.base_name(F.coalesce(path, F.lit("")))
    named = F.lit(False)
    for word in ANSWER_SHEETS:
        named = named | F.contains(name, F.lit(word))
    return named & ~F.contains(name, F.lit(ANSWER_BOOK))


def keep_long(df: DataFrame, least: int = 100, text_column: str = "text") -> DataFrame:
    """Rows with at least ``least`` letters; null texts have none and go."""
    return df.where(T.letter_count(F.coalesce(df[text_column], F.lit(""))) >= least)


def drop_answer_sheets(df: DataFrame, path_column: str = "path") -> DataFrame:
    return df.where(~is_answer_sheet(df[path_column]))


def clean(df: DataFrame, options: CleanOptions, text_column: str = "text", path_column: str = "path") -> DataFrame:
    """Filters on the raw text, then the cleaners that are on, in order; all other columns pass.

    One projection without Python: each cleaner is its own column, so that Catalyst evaluates
    every step once.
    """
    if options.answer_sheet_filter and path_column in df.columns:
        df = drop_answer_sheets(df, path_column)
    df = keep_long(df, options.min_text_length, text_column)
    for name, cleaner in T.CLEANERS.items():
        if getattr(options, name):
            df = df.withColumn(text_column, cleaner(F.col(text_column)))
    return df
