"""Running streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.session import ROCKSDB, STATE_STORE_KEY, shared_dir


#: State of a query: RocksDB, which else looks each key up before it writes it, to count keys.
STATE_CONF = {STATE_STORE_KEY: ROCKSDB, "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}

#: Native memory of all state stores of an executor together, unless the session says otherwise; else each store, of which
#: a join has four per shuffle partition, has a cache and write buffers of its own.
STATE_MEMORY = {
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
}


def state_conf(spark: SparkSession) -> dict[str, str]:
    """Settings of a query's state."""
    return {**{key: spark.conf.get(key, value) for key, value in STATE_MEMORY.items()}, **STATE_CONF}


@contextmanager
def query_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings a query captures when it starts; restored afterwards."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def start_batches(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
    close_windows: bool = True,
) -> StreamingQuery:
    """Start a query handing each micro-batch and its id to ``write``.

    ``close_windows=False`` leaves out the empty batches that only move time on;
    needed by ``availableNow`` with processing-time state, which would never end.
    """
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    if name:
        writer = writer.queryName(name)
    conf = {
        **state_conf(stream.sparkSession),
        "spark.sql.streaming.noDataMicroBatches.enabled": str(close_windows).lower(),
    }
    with query_conf(stream.sparkSession, conf):
        return writer.start()


def run_to_table(stream: DataFrame, purpose: str, root: str | None = None) -> DataFrame:
    """Drain a stream into Parquet under ``root`` (a fresh shared folder) and read it."""
    spark = stream.sparkSession
    root = root or shared_dir(spark, purpose)
    with query_conf(spark, state_conf(spark)):
        query = (
            stream.writeStream.format("parquet")
            .option("path", f"{root}/out")
            .option("checkpointLocation", f"{root}/checkpoint")
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped behind the watermark in the batches still in the progress history."""
    return sum(
        op.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for op in progress.stateOperators
    )
