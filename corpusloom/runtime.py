"""Session helpers shared by all operators."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Set and return the directory that ``DataFrame.checkpoint`` writes to.

    A cluster names its shared folder in ``spark.checkpoint.dir``; only where
    that is unset (tests, a single machine) a local folder is made.
    """
    sc = spark.sparkContext
    have = sc._jsc.sc().getCheckpointDir()
    if have.isDefined():
        return have.get()
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    path = named or os.path.join(tempfile.gettempdir(), f"corpusloom-checkpoints-{os.getuid()}")
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows of ``frames``, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def input_partitions(df: DataFrame) -> int:
    """Number of partitions ``df`` is planned with (no job runs)."""
    return df.rdd.getNumPartitions()
