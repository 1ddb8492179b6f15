"""Cleaning JSONL files as they arrive, each id once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators.clean import CleanOptions, clean


def stream_jsonl(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.jsonl").option("maxFilesPerTrigger", files_per_batch).json(folder)


def clean_stream(stream: DataFrame, options: CleanOptions, id_column: str = "id", time_column: str | None = None, delay: str = "1 day") -> DataFrame:
    """Filtered and cleaned records, the first of each id.

    With ``time_column`` ids are remembered for ``delay`` behind the watermark, so the state
    stays bounded; without it they are remembered for good.
    """
    if time_column:
        stream = stream.withWatermark(time_column, delay).dropDuplicatesWithinWatermark([id_column])
    else:
        stream = stream.dropDuplicates([id_column])
    return clean(stream, options)


def start(df: DataFrame, output: str, checkpoint: str, *, once: bool = False) -> StreamingQuery:
    """Write a stream to parquet; ``checkpoint`` makes every file's rows appear exactly once."""
    writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start(output)
