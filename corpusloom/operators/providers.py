"""Model-assisted steps behind providers, with rule-based defaults.

A provider maps a batch of prompts or inputs to replies. Each Python worker builds one
instance; retries back off; several endpoints are taken in turn. Recognition of scans,
speech and free generation need models this library does not ship: their providers
are for the user to give.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from itertools import cycle
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as T


class Provider(Protocol):
    """Turns inputs into replies, one for one; None stands for a failure."""

    def reply(self, inputs: list[str]) -> list[str | None]: ...


class RoundRobin:
    """Several providers taken in turn, with retries and growing pauses."""

    def __init__(self, providers: list[Provider], tries: int = 4, pause: float = 1.0, growth: float = 1.5):
        self._next, self.tries, self.pause, self.growth = cycle(providers), tries, pause, growth

    def reply(self, inputs: list[str]) -> list[str | None]:
        wait = self.pause
        for attempt in range(self.tries):
            try:
                return next(self._next).reply(inputs)
            except Exception:
                if attempt + 1 < self.tries:
                    time.sleep(wait)
                    wait *= self.growth
        return [None] * len(inputs)


def ask(df: DataFrame, make: Callable[[], Provider], input_column: str, reply_column: str = "reply") -> DataFrame:
    """``df`` with the provider's replies; one provider per Python worker, Arrow batches in between."""

    @F.pandas_udf("string")
    def replies(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        provider = make()
        for batch in batches:
            yield pd.Series(provider.reply(batch.fillna("").tolist()), dtype=object)

    return df.withColumn(reply_column, replies(F.col(input_column)))


# Vocabularies of the classification.
GRADES = "一年级 二年级 三年级 四年级 五年级 六年级 初一 初二 初三 七年级 八年级 九年级 高一 高二 高三 其他".split()
DISCIPLINES = "语文 数学 英语 自然与科学 音乐 美术 劳动技术 体育 思想政治 信息技术 物理 生物 政治 地理 化学 历史 通用技术 其他".split()
FILE_TYPES = "教案 跨学科材料 练习卷 期末试卷（试题） 期末试卷（学生答卷） 期中试卷（试题） 期中试卷（学生答卷） 作业练习 作业卷 其他".split()
#: First years of the school years that are known.
SCHOOL_YEARS = range(2010, 2026)


def grade_from_path(path: Column, vocabulary: list[str] = GRADES, default: str = "无") -> Column:
    """The first vocabulary term in the path; rule-based stand-in for a model's answer."""
    out = None
    for term in vocabulary:
        hit = F.contains(F.coalesce(path, F.lit("")), F.lit(term))
        out = F.when(hit, F.lit(term)) if out is None else out.when(hit, F.lit(term))
    return out.otherwise(F.lit(default))


def school_year_from_path(path: Column, default: str = "无") -> Column:
    """``Y-(Y+1)学年`` from a path; a single year is completed, an unknown one is none."""
    text = F.coalesce(path, F.lit(""))
    first = F.regexp_extract(text, r"(20\d\d)(?:-20\d\d)?学年", 1)
    second = F.regexp_extract(text, r"20\d\d-(20\d\d)学年", 1)
    end = F.when(second != "", second).otherwise((F.try_to_number(first, F.lit("9999")) + 1).cast("int").cast("string"))
    year = F.concat(first, F.lit("-"), end, F.lit("学年"))
    return F.when(year.isin(*(f"{y}-{y + 1}学年" for y in SCHOOL_YEARS)), year).otherwise(F.lit(default))


def classify_document(path: Column, text: Column) -> dict[str, Column]:
    """Rule-based discipline and file type from the path and the first 3000 characters; empty texts give the word for none."""
    seen = F.concat_ws("\n", F.coalesce(path, F.lit("")), T.truncate(F.coalesce(text, F.lit("")), 3000))
    empty = F.coalesce(text, F.lit("")) == ""
    pick = lambda words: grade_from_path(seen, [w for w in words if w != "其他"], "其他")
    return {"discipline": F.when(empty, F.lit("无")).otherwise(pick(DISCIPLINES)), "file_type": F.when(empty, F.lit("无")).otherwise(pick(FILE_TYPES))}


def parse_classification(reply: Column, disciplines: list[str] = DISCIPLINES, file_types: list[str] = FILE_TYPES) -> dict[str, Column]:
    """Discipline, file type (validated) and subcategory from a labelled reply."""
    valid = lambda c, words: F.when(c.isin(*words), c).otherwise(F.lit("其他"))
    return {
        "discipline": valid(T.labelled_value(reply, "学科"), disciplines),
        "file_type": valid(T.labelled_value(reply, "文件类型"), file_types),
        "subcategories": T.labelled_value(reply, "子类别"),
    }


def parse_label(reply: Column) -> Column:
    """The ``label`` of a judging reply as JSON text; null where there is no object with that key."""
    return F.get_json_object(T.outer_object(T.strip_reasoning(reply)), "$.label")


class RuleNames:
    """Names of people behind common labels; the rule-based stand-in for a model."""

    _pattern = re.compile(r"(?:姓名|老师|作者|教师)[：:]\s*([一-鿿]{2,4})")

    def reply(self, inputs: list[str]) -> list[str | None]:
        import json

        return [json.dumps(self._pattern.findall(x), ensure_ascii=False) for x in inputs]


def entities_from_reply(reply: Column) -> Column:
    """Array of strings from a JSON array; failures give an empty one."""
    return F.filter(F.coalesce(F.from_json(reply, "array<string>"), F.array().cast("array<string>")), lambda x: x.isNotNull())
