"""Counts over streams, written so that the same code runs on tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeline.operators import keyed
from lakeline.streaming.sinks import per_batch


def per_batch_word_count(
    stream: DataFrame, column: str, sink: str, checkpoint: str, every: str | None = "5 seconds"
) -> StreamingQuery:
    """Word counts of each micro-batch on its own, with no state between batches.

    A streaming ``groupBy`` would give running totals instead.
    """
    return per_batch(
        stream, lambda batch: keyed.word_count(batch, column, ordered=False), sink, checkpoint, every
    )


def interval_count(
    df: DataFrame, ts: str, key: str, width: str = "5 seconds", late: str | None = None
) -> DataFrame:
    """Rows per fixed time interval and key, for a table or a stream.

    On a stream ``late`` sets how long an interval stays open; a stream with no
    such bound keeps all intervals and must be written in complete or update mode.
    """
    if late is not None:
        df = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    counted = df.groupBy(F.window(ts, width).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("w.start").alias("start"), key, "n")


def per_batch_interval_count(
    stream: DataFrame, ts: str, key: str, sink: str, checkpoint: str,
    width: str = "5 seconds", every: str | None = "5 seconds",
) -> StreamingQuery:
    """Interval counts of each micro-batch, to be added up by ``merged_intervals``.

    Keeps no state, so late rows are never dropped and nothing grows with the
    number of intervals.
    """
    return per_batch(
        stream, lambda batch: interval_count(batch, ts, key, width), sink, checkpoint, every
    )


def closed_interval_count(
    stream: DataFrame, ts: str, key: str, sink: str, checkpoint: str, late: str,
    width: str = "5 seconds", every: str | None = "5 seconds",
) -> StreamingQuery:
    """Counts of intervals that are over, each written once, by event time.

    Intervals wait in the state store until the latest time seen, less ``late``, has passed their end. A row
    that comes for an interval already written is dropped. Nothing is written for intervals still open, and the
    state holds no others, so it does not grow with the stream.
    """
    counted = interval_count(stream, ts, key, width, late)
    writer = counted.writeStream.outputMode("append").format("parquet").option("path", sink)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def merged_intervals(parts: DataFrame, key: str) -> DataFrame:
    """Totals per interval over the batches written so far."""
    return parts.groupBy("start", key).agg(F.sum("n").alias("n"))
