"""Problem 5: a uniform sample of fixed size from data of unknown length.

Method: adaptive Bernoulli sampling. A buffer includes each record with
probability ``2**-level``; when it overflows, the level rises by one (the
probability is halved) and the buffer is thinned at the new rate. Buffers that
meet are brought to the higher of their levels first, then joined, and thinned
again on overflow. The last buffer holds a Bernoulli sample of everything at one
rate; a uniform draw from it has the size asked. A rate is not halved where less
than the size asked would be left, so the last buffer is never too small for it;
the level depends on the distinct keys alone, not on how they are parted.

A record's coin is a hash of its key and the seed, so a record delivered twice
has the same coins and counts once, a lost executor redoes the same draw, and
any partitioning gives the same sample. The draw by the lowest of a second hash
among the included is uniform over the distinct keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.runtime import input_partitions

#: Partial buffers that one task joins.
FAN_IN = 64


def _level_of(coins: np.ndarray) -> np.ndarray:
    """The highest level at which a coin is still included (its leading zero bits)."""
    x = np.asarray(coins, np.int64).view(np.uint64) >> np.uint64(11)
    return np.where(x == 0, 53, 53 - np.frexp(x.astype(np.float64))[1]).astype(np.int64)


class AdaptiveBernoulli:
    """A mergeable buffer of distinct keys with their coins and draws."""

    def __init__(self, capacity: int, level: int = 0, least: int = 0):
        self.capacity, self.level, self.least = capacity, level, least
        self._parts: list[pd.DataFrame] = []
        self._held = 0

    def _thin(self) -> None:
        held = pd.concat(self._parts, ignore_index=True) if self._parts else pd.DataFrame({"key": [], "coin": [], "draw": []})
        held = held.drop_duplicates("key", ignore_index=True)
        of = _level_of(held["coin"].to_numpy())
        while True:
            keep = of >= self.level
            if keep.sum() <= self.capacity or self.level >= 53 or (of > self.level).sum() < self.least:
                break
            self.level += 1
        held = held[keep]
        self._parts, self._held = [held], len(held)

    def add(self, rows: pd.DataFrame, level: int = 0) -> None:
        """Take rows (key, coin, draw) that were included at ``level``."""
        self.level = max(self.level, level)
        rows = rows[_level_of(rows["coin"].to_numpy()) >= self.level]
        if len(rows):
            self._parts.append(rows)
            self._held += len(rows)
            if self._held > 2 * self.capacity:
                self._thin()

    def rows(self) -> pd.DataFrame:
        self._thin()
        return self._parts[0].assign(level=self.level)


def sample_keys(df: DataFrame, key: str, k: int, *, seed: int = 42) -> DataFrame:
    """``min(k, distinct keys)`` keys, each distinct key equally likely.

    Null keys are no records and are left out; repeated keys count once; an empty
    table gives an empty sample; ``k`` of 0 gives none. Only the key column is read.
    """
    if k < 0:
        raise ValueError("k must not be negative")
    rows = df.select(df[key].alias("key")).where(F.col("key").isNotNull())
    rows = rows.select("key", F.xxhash64(F.lit(seed), "key").alias("coin"), F.xxhash64(F.lit(seed + 1), "key", F.lit("draw")).alias("draw"))
    capacity = max(2 * k, k + 1024)
    key_type = rows.schema["key"].dataType.simpleString()
    schema = f"key {key_type}, coin bigint, draw bigint, level bigint, part bigint"

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        buffer = AdaptiveBernoulli(capacity, least=k)
        for batch in batches:
            buffer.add(batch.to_pandas())
        out = buffer.rows().assign(part=TaskContext.get().partitionId())
        yield pa.RecordBatch.from_pandas(out.astype({"coin": "int64", "draw": "int64"}), schema=shape, preserve_index=False)

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        # the highest level first: every part is thinned to it on arrival
        buffer = AdaptiveBernoulli(capacity, int(pdf["level"].max()), k)
        buffer.add(pdf[["key", "coin", "draw"]])
        return buffer.rows().assign(part=int(pdf["part"].iloc[0]) // FAN_IN)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    shape = to_arrow_schema(_parse_datatype_string(schema))
    parts = rows.mapInArrow(fill, schema)
    left = max(1, input_partitions(df))
    while True:
        parts = parts.groupBy(F.floor(F.col("part") / FAN_IN).alias("__at")).applyInPandas(lambda pdf: join(pdf), schema)
        left = -(-left // FAN_IN)
        if left <= 1:
            break
    chosen = parts.orderBy("draw", "key").limit(k)
    return chosen.select(F.col("key").alias(key))


def sample_rows(df: DataFrame, key: str, k: int, *, seed: int = 42, order_by: str | None = None) -> DataFrame:
    """The sampled records whole, one row per sampled key.

    Of a key's repeated rows the one with the least ``order_by`` is kept (else any
    equal one). The sample's size is bounded by ``k``, so only rows of sampled keys
    are shuffled.
    """
    keys = sample_keys(df, key, k, seed=seed)
    hits = df.join(F.broadcast(keys) if k <= 1_000_000 else keys, key, "left_semi")
    if order_by is None:
        return hits.dropDuplicates([key])
    order = Window.partitionBy(key).orderBy(F.col(order_by).asc_nulls_last())
    return hits.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") == 1).drop("__rank")
