"""Queries over records: counts, ids, semi-joins, resuming."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import python_str


def field_equals(df: DataFrame, field: str, value: Any) -> Column:
    """``str(field) == str(value)``, where a missing or null field is the empty string."""
    if field not in df.columns:
        return F.lit("") == F.lit(str(value))
    return python_str(df[field], dict(df.dtypes)[field]) == F.lit(str(value))


def usable(conditions: Iterable[dict]) -> list[dict]:
    """Conditions with a field and a value; none at all is an error."""
    out = [c for c in conditions if isinstance(c, dict) and "field" in c and "value" in c]
    if not out:
        raise ValueError("no usable condition")
    return out


def count_by_conditions(df: DataFrame, conditions: Iterable[dict]) -> DataFrame:
    """One row: the number of records that meet all conditions."""
    met = reduce(lambda a, b: a & b, (field_equals(df, c["field"], c["value"]) for c in usable(conditions)))
    return df.where(met).agg(F.count(F.lit(1)).alias("matches"))


def extract_ids(df: DataFrame, field: str, value: Any, id_field: str = "id") -> DataFrame:
    """Ids of records whose field equals the value; duplicates stay."""
    return df.where(field_equals(df, field, value)).select(F.col(id_field).cast("string").alias("id"))


def semi_join_by_id(df: DataFrame, ids: DataFrame, id_field: str = "id") -> DataFrame:
    """Records whose id is in the one-column ``ids``, compared as strings. Spark picks the strategy by size."""
    wanted = ids.select(F.col(ids.columns[0]).cast("string").alias("__id")).distinct()
    return df.join(wanted, df[id_field].cast("string") == wanted["__id"], "left_semi")


def resume(df: DataFrame, done: DataFrame, id_field: str = "id") -> DataFrame:
    """Records still to do: those with an id that ``done`` lacks. Without an id counts as done."""
    past = done.select(F.col(done.columns[0]).cast("string").alias("__id")).distinct()
    key = df[id_field].cast("string")
    return df.where(key.isNotNull() & (key != "")).join(past, key == past["__id"], "left_anti")


def append_once(df: DataFrame, id_field: str = "id", order_by: str | None = None) -> DataFrame:
    """One record per id that is not empty: the least by ``order_by``, else any."""
    df = df.where(F.coalesce(df[id_field].cast("string"), F.lit("")) != "")
    if order_by is None:
        return df.dropDuplicates([id_field])
    order = Window.partitionBy(id_field).orderBy(F.col(order_by).asc_nulls_last())
    return df.withColumn("__n", F.row_number().over(order)).where(F.col("__n") == 1).drop("__n")


def validate_vocabulary(df: DataFrame, column: str, vocabulary: Iterable[str], default: str) -> DataFrame:
    """Values outside the vocabulary become the default."""
    return df.withColumn(column, F.when(F.col(column).isin(*vocabulary), F.col(column)).otherwise(F.lit(default)))
