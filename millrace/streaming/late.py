"""Records that come too late, or without a time, as rows of their own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.sources.topics import first_row
from millrace.streaming.runner import start_batches

_HIGH = "batch bigint, high bigint"


def start_splitting(
    stream: DataFrame,
    on_time: Callable[[DataFrame, int], None],
    refused: Callable[[DataFrame, int], None],
    checkpoint: str,
    delay_ms: int,
    ts: str = "ts",
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Hand each micro-batch's rows to ``on_time``, or with a ``reason`` to ``refused``.

    ``late``: the time is below the watermark, the latest time of all earlier micro-batches less
    ``delay_ms``, which is where Spark's stateful operators drop rows unseen.  ``untimed``: there is no
    time.  The latest time is kept with the micro-batch it comes from, so a micro-batch that is
    run again splits as before.
    """
    spark = stream.sparkSession
    slot = lambda batch_id: f"{checkpoint}/high/slot={batch_id % 2}"

    def high_before(batch_id: int) -> int | None:
        row = first_row(spark, slot(batch_id - 1), _HIGH)
        return row["high"] if row and row["batch"] == batch_id - 1 else None

    def write(batch: DataFrame, batch_id: int) -> None:
        high = high_before(batch_id)
        reason = F.when(F.col(ts).isNull(), "untimed")
        if high is not None:
            reason = reason.when(F.col(ts) < high - delay_ms, "late")
        batch = batch.withColumn("reason", reason).persist()
        try:
            on_time(batch.where("reason is null").drop("reason"), batch_id)
            refused(batch.where("reason is not null"), batch_id)
            found = batch.agg(F.max(ts)).first()[0]
            highs = [h for h in (high, found) if h is not None]
            row = spark.createDataFrame([(batch_id, max(highs, default=None))], _HIGH)
            row.coalesce(1).write.mode("overwrite").parquet(slot(batch_id))
        finally:
            batch.unpersist()

    return start_batches(stream, write, checkpoint, trigger, name, close_windows=False)
