"""Streams: accepted samples appended as they come, and late events counted in windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def append_accepted(stream: DataFrame, accept: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Writes what ``accept`` lets through of each micro-batch as JSON lines under ``path``/batch=N.

    A batch that is run again after a failure overwrites its own folder, so every sample is there once.
    """

    def write(batch: DataFrame, number: int) -> None:
        accept(batch).write.mode("overwrite").json(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time: str, width: str, late: str, keys: list[str], value: str | None = None) -> DataFrame:
    """(window_start, keys, events[, total]) per window of event time; events later than ``late`` are dropped by the watermark."""
    measures: list[Column] = [F.count("*").alias("events")]
    if value:
        measures.append(F.sum(value).alias("total"))
    grouped = stream.withWatermark(time, late).groupBy(F.window(time, width).alias("_w"), *keys).agg(*measures)
    return grouped.select(F.col("_w.start").alias("window_start"), *keys, *[m for m in ("events", "total") if m == "events" or value])
