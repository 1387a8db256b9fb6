"""Topic sinks.  File topics keep each micro-batch in its own folder, so a replayed
batch replaces what it wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.records import to_lines
from millrace.sources.topics import Topics
from millrace.streaming.runner import start_batches

# Fixed value: where rows without a topic go.
DEFAULT_TOPIC = "dwd_default_topic"


def write_routed(
    topics: Topics, lines: DataFrame, writer: str, batch_id: int = 0
) -> None:
    """Write ``topic, value`` rows, each to its own topic; a column ``key`` goes along, but not to text files."""
    key = ["key"] if "key" in lines.columns and topics.file_format != "text" else []
    rows = lines.select(F.coalesce("topic", F.lit(DEFAULT_TOPIC)).alias("topic"), *key, "value")
    if topics.backend == "kafka":
        rows.write.format("kafka").options(**topics.options).save()
        return
    (
        rows.withColumns({"writer": F.lit(writer), "batch": F.lit(batch_id)})
        .write.partitionBy("topic", "writer", "batch")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .format(topics.file_format)
        .save(topics.root)
    )


def write_topic(
    topics: Topics, df: DataFrame, topic: str, writer: str, batch_id: int = 0
) -> None:
    """Write rows as JSON texts to one topic."""
    write_routed(topics, to_lines(df).withColumn("topic", F.lit(topic)), writer, batch_id)


def to_topic(topics: Topics, topic: str, writer: str) -> Callable[[DataFrame, int], None]:
    """A micro-batch writer for ``start_batches``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_topic(topics, batch, topic, writer, batch_id)
    return write


def write_topic_stream(
    topics: Topics,
    stream: DataFrame,
    topic: str,
    checkpoint: str,
    trigger: dict | None = None,
    close_windows: bool = True,
) -> StreamingQuery:
    """Write a stream as JSON texts to one topic."""
    write = to_topic(topics, topic, topic)
    return start_batches(stream, write, checkpoint, trigger, topic, close_windows)


def print_stream(stream: DataFrame, label: str, checkpoint: str) -> StreamingQuery:
    """Show each micro-batch on the console."""
    writer = stream.writeStream.format("console").queryName(label)
    return writer.option("truncate", "false").option("checkpointLocation", checkpoint).start()
