"""Consistent pseudonyms for entities of a corpus: extract, map, rewrite."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import replace_in_order
from corpusloom.operators.dialogue import number_rows

# Parts of invented names.
SURNAMES = "张 李 王 赵 刘 陈 杨 黄 吴 周 徐 孙 马 朱 胡 林 何 高 郭 罗".split()
GIVEN = "一 二 三 四 五 六 七 八 九 十".split()
REGIONS = "东城 西城 南山 北湖 中心 华阳 朝阳 海滨 绿洲 阳光".split()
SCHOOL_TYPES = "小学 中学 小学分校 第一小学 第二中学 第三小学 实验小学 附属中学".split()
#: Names of schools as the rule-based extractor knows them.
SCHOOL_PATTERN = r"[一-鿿]{2,12}?(?:小学|中学|大学|学院|学校|幼儿园)"


def fake_person_names(spark: SparkSession, n: int) -> DataFrame:
    """``n`` invented names (fake, rn); more than there are combinations is an error."""
    pool = [s + g for s in SURNAMES for g in GIVEN] + [s + a + b for s, a, b in product(SURNAMES, GIVEN, GIVEN)]
    return _pool(spark, pool, n)


def fake_school_names(spark: SparkSession, n: int) -> DataFrame:
    return _pool(spark, [r + t for r, t in product(REGIONS, SCHOOL_TYPES)], n)


def _pool(spark: SparkSession, names: list[str], n: int) -> DataFrame:
    if n > len(names):
        raise ValueError(f"{n} names asked for, {len(names)} exist")
    return spark.createDataFrame([(x, k) for k, x in enumerate(names[:n])], "fake string, rn bigint")


def distinct_entities(df: DataFrame, entities: Column) -> DataFrame:
    """Distinct values of an array column of entities."""
    return df.select(F.explode(entities).alias("real")).where(F.length("real") > 0).distinct()


def longer_person_names(rn: Column) -> Column:
    """The invented name at a position beyond the pool: a surname and three or more given characters."""
    k = rn - len(SURNAMES) * len(GIVEN) * (1 + len(GIVEN))
    surname = F.element_at(F.array(*map(F.lit, SURNAMES)), (F.pmod(k, F.lit(len(SURNAMES))) + 1).cast("int"))
    return F.concat(surname, F.translate(F.format_string("%03d", F.floor(k / len(SURNAMES))), "0123456789", "".join(GIVEN)))


def build_mapping(entities: DataFrame, pool: DataFrame, beyond: Callable[[Column], Column] | None = None) -> DataFrame:
    """(real, fake, rn): the entities, longest first, paired with the pool by position.

    Where the pool ends, ``beyond`` names by position; without it, more entities are an error.
    """
    ranked = number_rows(entities.withColumn("__len", -F.length("real")), ["__len", "real"]).withColumnRenamed("row_no", "rn").drop("__len")
    rest = beyond(F.col("rn")) if beyond else F.raise_error(F.lit("more entities than names in the pool"))
    return ranked.join(pool, "rn", "left").withColumn("fake", F.coalesce("fake", rest))


def pseudonymise(df: DataFrame, mapping: DataFrame, text_column: str = "text", limit: int = 5000) -> DataFrame:
    """Text with every real name replaced by its fake one, one name after another, longest first.

    The mapping travels to every task, so its size is checked: pools are finite, and
    ``limit`` bounds them. An automaton over all names finds those that a text has, so that
    a text costs as much as it has names, not as there are names.
    """
    rows = mapping.orderBy("rn").select("real", "fake").limit(limit + 1).toPandas()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} names; split the corpus or raise the limit")
    try:
        import ahocorasick  # noqa: F401
    except ImportError:
        folded = mapping.agg(F.sort_array(F.collect_list(F.struct("rn", "real", "fake"))).alias("map"))
        return df.withColumn("__map", folded.scalar()).withColumn(text_column, replace_in_order(F.col(text_column), F.col("__map"))).drop("__map")
    pairs = list(rows.itertuples(index=False, name=None))
    shared = df.sparkSession.sparkContext.broadcast(pairs)
    at = df.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        names = ahocorasick.Automaton()
        for order, (real, _) in enumerate(shared.value):
            names.add_word(real, order)
        if shared.value:
            names.make_automaton()
        for batch in batches:
            texts = batch.column(at).to_pylist()
            if shared.value:
                texts = [t and rewrite(t, names, shared.value) for t in texts]
            yield batch.set_column(at, batch.schema.field(at).name, pa.array(texts, batch.schema.field(at).type))

    return df.mapInArrow(run, df.schema)


def rewrite(text: str, names, pairs: list[tuple[str, str]]) -> str:
    """Replacements in order; a name that an earlier replacement brings about counts as well."""
    done = -1
    while True:
        order = min((k for _, k in names.iter(text) if k > done), default=None)
        if order is None:
            return text
        text = text.replace(*pairs[order])
        done = order
