"""Writing each micro-batch, and merging the folders of many batches into few files."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeline.session import drop_folders

COMMIT = "first bigint, last bigint, folder string"


def merged_ranges(spark: SparkSession, sink: str) -> list[tuple[int, int, str]]:
    """``(first, last, folder)`` of the merged batches that count, in order.

    A merge counts once its row is in the commit log. Of ranges inside each other the widest counts.
    """
    try:
        rows = spark.read.schema(COMMIT).parquet(f"{sink}/_commits").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    live: list[tuple[int, int, str]] = []
    for first, last, folder in sorted(map(tuple, rows), key=lambda r: (r[0], -r[1], r[2])):
        if not live or first > live[-1][1]:
            live.append((first, last, folder))
    return live


def compact(spark: SparkSession, sink: str, schema: str, first: int, last: int) -> None:
    """Merge batches ``first`` to ``last`` into one folder of few files.

    The new folder counts from the moment its commit row is written, in one rename; the folders it replaces
    are deleted after that, so a merge that breaks off leaves the sink as it was, with some files too many.
    A batch that is run again after its merge finds itself merged and writes nothing.
    """
    folder = f"_merged/{first}-{last}-{uuid.uuid4().hex[:12]}"
    inside = F.col("batch_id").between(first, last)
    old = [f"{sink}/{name}" for low, high, name in merged_ranges(spark, sink) if first <= low and high <= last]
    read_sink(spark, sink, schema).where(inside).hint("rebalance").write.parquet(f"{sink}/{folder}")
    spark.createDataFrame([(first, last, folder)], COMMIT).coalesce(1).write.mode("append").parquet(f"{sink}/_commits")
    drop_folders(spark, *old, *(f"{sink}/batch_id={number}" for number in range(first, last + 1)))


def per_batch(
    stream: DataFrame,
    work: Callable[[DataFrame], DataFrame],
    sink: str,
    checkpoint: str,
    every: str | None = None,
    merge: int | None = None,
) -> StreamingQuery:
    """Write ``work(batch)`` of each micro-batch to its own folder ``batch_id=N``.

    A batch that is run again after a failure replaces its folder, so each
    batch counts once. ``every`` is the trigger interval; without it all
    waiting input is processed and the query ends.

    With ``merge`` every that many batches are merged into one folder, as many of these into one again, and so on:
    a row is rewritten as often as the logarithm of the batches says, and the folders stay as few.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if merge and any(first <= batch_id <= last for first, last, _ in merged_ranges(spark, sink)):
            return
        result = work(batch)
        result.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
        size = 1
        while merge and (batch_id + 1) % (size * merge) == 0:
            size *= merge
        if size > 1:
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in result.schema)
            compact(spark, sink, fields, batch_id + 1 - size, batch_id)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def read_sink(spark: SparkSession, sink: str, schema: str) -> DataFrame:
    """All batches written so far, with their ``batch_id``."""
    schema = f"{schema}, batch_id bigint"
    rows, merged = spark.read.schema(schema).parquet(sink), merged_ranges(spark, sink)
    for first, last, _ in merged:
        rows = rows.where(~F.col("batch_id").between(first, last))
    for _, _, folder in merged:
        rows = rows.union(spark.read.schema(schema).parquet(f"{sink}/{folder}"))
    return rows
