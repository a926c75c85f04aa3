"""Incremental ingestion of new reads and run tables with Structured Streaming.

The file source takes each file once; the checkpoint keeps what was taken, so that a restarted query goes on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tarnflow.operators import reads as R


def arriving(spark: SparkSession, folder: str, schema: StructType | str, files_per_batch: int = 100) -> DataFrame:
    """Rows of Parquet files as they appear below a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def running_counts(reads: DataFrame, by: list[str]) -> DataFrame:
    """Reads and rejected reads so far; the state is one row a group."""
    reason = R.reject_reason()
    return reads.groupBy(*by).agg(F.count(F.lit(1)).alias("reads"), F.count_if(reason != "kept").alias("rejected"))


def windowed_counts(events: DataFrame, time: str = "ts", late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Events by window; windows that the watermark has passed are final and leave the state."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))


def each_batch(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Run ``handle`` once for each batch of what has arrived by now, then stop. The batch number makes it repeatable."""
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle).trigger(availableNow=True).start()


def append_gated(stream: DataFrame, checkpoint: str, out: str) -> StreamingQuery:
    """Append the reads that pass the quality gate, exactly once."""
    return R.quality_gate(stream).writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", out).trigger(availableNow=True).start()
