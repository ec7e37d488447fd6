"""Streaming forms of the incremental load, dashboard feed and change merge.

All take a streaming DataFrame and a checkpoint folder and use
``availableNow``, so the same code serves a schedule or a long-running query
(pass another trigger).  Sinks are files written per batch id, which makes a
replayed batch harmless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..plans.features import dashboard_feed
from .merge_store import MergeStore

NOW = {"availableNow": True}


def file_stream(spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet",
                files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    )


def incremental_load(stream: DataFrame, target: str, checkpoint: str, trigger: dict = NOW) -> StreamingQuery:
    """Copy only files that arrived since the last run; the checkpoint is the mark."""
    return (
        stream.writeStream.format("parquet").outputMode("append").option("path", target)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def dashboard_stream(events: DataFrame, target: str, checkpoint: str, width: str = "1 hour",
                     late: str = "2 hours", trigger: dict = NOW) -> StreamingQuery:
    """Windowed counts; state older than the watermark is dropped.

    Changed windows are written under their batch id; ``dashboard_table``
    keeps the newest version of each.
    """
    feed = dashboard_feed(events.withWatermark("ts", late), width)

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return (
        feed.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        .foreachBatch(save).trigger(**trigger).start()
    )


def dashboard_table(spark: SparkSession, target: str) -> DataFrame:
    rows = spark.read.parquet(target)
    newest = F.max_by(F.struct("window_end", "events", "purchases", "purchase_value"), "batch").alias("r")
    return rows.groupBy("window_start").agg(newest).select("window_start", "r.*")


def cdc_stream(changes: DataFrame, store: MergeStore, checkpoint: str, order_by: str = "change_timestamp",
               trigger: dict = NOW) -> StreamingQuery:
    """Merge change batches into a keyed store: batch ``b`` turns version ``b`` into ``b+1`` and rewrites the buckets of its keys only."""
    return (
        changes.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: store.merge(batch, batch_id, order_by) and None).trigger(**trigger).start()
    )


def finish(query: StreamingQuery) -> None:
    query.awaitTermination()


__all__ = ["file_stream", "incremental_load", "dashboard_stream", "dashboard_table", "cdc_stream", "finish"]
