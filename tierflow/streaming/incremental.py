"""Incremental runs: new files or rows are worked on once, late data is bounded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def run_once(stream: DataFrame, output: str, checkpoint: str, work: Callable[[DataFrame], DataFrame] | None = None, form: str = "json") -> StreamingQuery:
    """Works on all that is new, appends it to ``output`` and stops; the checkpoint remembers what was done."""
    out = work(stream) if work else stream
    return out.writeStream.format(form).option("path", output).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_each(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Every micro-batch to ``sink(batch, number)``; a repeated number is a repeated batch."""
    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_in_stream(stream: DataFrame, key: str, time: str, late: str = "1 day") -> DataFrame:
    """First arrival of each (key, time) within the watermark: repeated rows of a stream drop out."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicatesWithinWatermark([key, time])


def windowed_counts(stream: DataFrame, time: str, width: str, late: str, *keys: str) -> DataFrame:
    """Tumbling counts; timestamps without zone are read as UTC, which watermarks need."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return timed.groupBy(F.window(time, width), *keys).agg(F.count(F.lit(1)).alias("n"))


def latest_in_stream(stream: DataFrame, key: str, time: str) -> DataFrame:
    """The latest row of each key so far (update or complete mode); one row a key is kept as state."""
    return stream.groupBy(key).agg(F.max_by(F.struct(*[c for c in stream.columns if c != key]), time).alias("row")).select(key, "row.*")
