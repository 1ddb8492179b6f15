"""Sinks: JSONL by source file, shards, appending once, archive and audit results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.dialogue import shard
from corpusloom.operators.records import append_once, resume


def write_by_source(df: DataFrame, path: str, source_column: str = "src_file", mode: str = "overwrite") -> None:
    """JSON lines, one folder per source file; nulls are kept, other columns too."""
    df.repartition(source_column).write.mode(mode).option("ignoreNullFields", "false").partitionBy(source_column).json(path)


def write_texts(df: DataFrame, path: str, text_column: str = "text") -> None:
    """Only rows with a text."""
    df.where(F.length(text_column) > 0).write.mode("overwrite").json(path)


def write_shards(df: DataFrame, path: str, order: list[str], size: int) -> None:
    """Shards of ``size`` rows each, one folder a shard."""
    shard(df, order, size).drop("row_no").repartition("shard").write.mode("overwrite").partitionBy("shard").json(path)


def append_new(df: DataFrame, path: str, id_field: str = "id") -> int:
    """Append records whose id the output lacks, each once; the number appended.

    A record without an id counts as written. Safe to repeat after a failure: what is
    there already is passed over.
    """
    spark = df.sparkSession
    fresh, before = append_once(df, id_field), 0
    try:
        done = spark.read.parquet(path).select(id_field)
        fresh, before = resume(fresh, done, id_field), done.count()
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER" not in str(e):
            raise
    fresh.write.mode("append").parquet(path)
    return spark.read.parquet(path).count() - before
