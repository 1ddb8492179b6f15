"""Dialogues: pairing, flattening, sharding, and model input lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import qa_line


def pairs_at_even_offsets(turns: Column) -> Column:
    """Slices of two turns at even offsets whose roles are user and assistant; others drop out."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(turns) - 1, F.lit(0)), F.lit(2))
    slices = F.transform(starts, lambda i: F.slice(turns, i + 1, F.lit(2)))
    ok = lambda p: (F.size(p) == 2) & (F.get(p, 0)["role"] == "user") & (F.get(p, 1)["role"] == "assistant")
    return F.filter(slices, lambda p: F.coalesce(ok(p), F.lit(False)))


def flatten_pairs(df: DataFrame, id_columns: list[str], turns_column: str = "qa_pairs") -> DataFrame:
    """One row per valid pair: the ids, pair_pos (from 0) and qa_pair."""
    pairs = df.where(F.size(turns_column) > 0).select(*id_columns, pairs_at_even_offsets(F.col(turns_column)).alias("__pairs"))
    return pairs.select(*id_columns, F.posexplode("__pairs").alias("pair_pos", "qa_pair"))


def number_rows(df: DataFrame, order: list[str], partitions: int | None = None) -> DataFrame:
    """Rows numbered from 0 in the given order, without gathering them in one task.

    Rows are range-partitioned and sorted; each partition's offset is the number of rows in
    those before it (a list as long as there are partitions).
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id())
    # the split must not change between the two uses
    from corpusloom.runtime import cut_lineage

    placed = cut_lineage(placed)
    counts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    offsets = counts.withColumn("__before", F.coalesce(F.sum("__rows").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    within = Window.partitionBy("__part").orderBy(*order)
    numbered = placed.withColumn("__n", F.row_number().over(within)).join(F.broadcast(offsets.select("__part", "__before")), "__part")
    return numbered.withColumn("row_no", (F.col("__before") + F.col("__n") - 1).cast("bigint")).drop("__part", "__n", "__before")


def shard(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """Rows with the number of their shard of ``size`` rows; an exact multiple makes no empty shard."""
    if size <= 0:
        raise ValueError("the shard size must be positive")
    return number_rows(df, order).withColumn("shard", F.floor(F.col("row_no") / size).cast("bigint"))


def model_lines(df: DataFrame, pair_column: str = "qa_pair") -> DataFrame:
    """Rows with at least two turns, with their ``line`` for a classifier."""
    first, second = F.get(pair_column, 0)["content"], F.get(pair_column, 1)["content"]
    return df.where(F.size(pair_column) >= 2).withColumn("line", qa_line(F.coalesce(first, F.lit("")), F.coalesce(second, F.lit(""))))
