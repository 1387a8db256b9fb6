"""Named topics on Kafka or in a directory.

A record is one text ``value``, the time ``stored_ms`` it was stored at, and its
position: the time stored, then partition and offset on Kafka, file and row in a
directory.  Positions tell records of equal time apart, and order a key's records where
one writer stored them in turn; changes carry their own place (``CHANGE_ORDER``).
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


POSITION = ("src", "part", "off")
#: Order of changes read from a topic of envelopes: the place they carry, then their position.
CHANGE_ORDER = ("at", *POSITION)


@dataclass(frozen=True)
class Start:
    """Where reading begins: ``initial``, ``latest``, ``timestamp`` or ``offsets``."""

    mode: str = "initial"
    timestamp_ms: int | None = None
    offsets: Mapping | None = None

    def kafka_options(self) -> dict[str, str]:
        if self.mode == "initial":
            return {"startingOffsets": "earliest"}
        if self.mode == "latest":
            return {"startingOffsets": "latest"}
        if self.mode == "timestamp":
            return {"startingTimestamp": str(self.timestamp_ms)}
        if self.mode == "offsets":
            return {"startingOffsets": json.dumps(self.offsets)}
        raise ValueError(f"unknown start mode {self.mode!r}")


@dataclass(frozen=True)
class Topics:
    """Topics of one back end.

    ``root`` is the directory of the ``file`` back end, whose topics are folders
    ``topic=<name>``; ``options`` holds the caller's Kafka connection options.
    """

    spark: SparkSession
    root: str | None = None
    backend: str = "file"
    file_format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)

    def path(self, topic: str) -> str:
        return f"{self.root}/topic={topic}"

    def read(self, topic: str, start: Start = Start()) -> DataFrame:
        return self._records(self.spark.read, topic, start, streaming=False)

    def read_stream(
        self, topic: str, start: Start = Start(), files_per_batch: int | None = None
    ) -> DataFrame:
        reader = self.spark.readStream
        if files_per_batch and self.backend == "file":
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        return self._records(reader, topic, start, streaming=True)

    def _records(self, reader, topic: str, start: Start, streaming: bool) -> DataFrame:
        if self.backend == "kafka":
            options = start.kafka_options()
            if not streaming and options.get("startingOffsets") == "latest":
                raise ValueError("a batch read has no latest start")
            rows = reader.format("kafka").options(**self.options, **options)
            return rows.option("subscribe", topic).load().select(
                F.col("value").cast("string").alias("value"),
                F.unix_millis("timestamp").alias("stored_ms"),
                F.unix_millis("timestamp").alias("src"),
                F.col("partition").cast("bigint").alias("part"),
                F.col("offset").alias("off"),
            )
        return self._file_records(reader, topic, start)

    def _file_records(self, reader, topic: str, start: Start) -> DataFrame:
        if start.mode not in ("initial", "timestamp"):
            raise ValueError("file topics start at 'initial' or at a 'timestamp'; pin 'latest' first")
        rows = reader.schema("value string").format(self.file_format)
        rows = rows.option("recursiveFileLookup", "true").load(self.path(topic))
        if start.mode == "timestamp":
            begin = F.timestamp_millis(F.lit(start.timestamp_ms))
            rows = rows.where(F.col("_metadata.file_modification_time") >= begin)
        if self.file_format == "parquet":
            position = F.col("_metadata.row_index")
        else:
            position = F.xxhash64("value")
        stored = F.unix_millis("_metadata.file_modification_time")
        return rows.select(
            "value",
            stored.alias("stored_ms"),
            stored.alias("src"),
            _file_order().alias("part"),
            position.alias("off"),
        )


def pinned_start(topics: Topics, topic: str, start: Start, checkpoint: str) -> Start:
    """``latest`` of a file topic as the time behind what is stored now, kept under ``checkpoint``.

    A query that is started again there begins where it first began, so nothing stored between is
    passed over.  Other starts, and Kafka, which keeps its offsets itself, stay as they are.
    """
    if topics.backend == "kafka" or start.mode != "latest":
        return start
    path, spark = f"{checkpoint}/start", topics.spark
    kept = first_row(spark, path, "begin_ms bigint")
    if kept is None:
        try:
            newest = topics.read(topic).agg(F.max("stored_ms")).first()[0]
        except AnalysisException:  # nothing stored yet
            newest = None
        kept = ((newest or 0) + 1,)
        spark.createDataFrame([kept], "begin_ms bigint").coalesce(1).write.mode("overwrite").parquet(path)
    return Start("timestamp", timestamp_ms=kept[0])


def first_row(spark: SparkSession, path: str, schema: str | StructType):
    """The first row stored at ``path``; none if there is nothing."""
    try:
        return spark.read.schema(schema).parquet(path).first()
    except AnalysisException:
        return None


def _file_order() -> Column:
    """Files of one write by their number, then by a hash of the path that tells files apart."""
    path = F.col("_metadata.file_path")
    number = F.coalesce(F.regexp_extract(path, r"part-(\d{1,6})", 1).try_cast("bigint"), F.lit(0))
    return F.shiftleft(number, 40) + F.xxhash64(path).bitwiseAND(F.lit((1 << 40) - 1))


def log_files(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Landed log files, one JSON text per line."""
    return (spark.readStream if streaming else spark.read).text(path)


def delimited(
    spark: SparkSession, path: str, schema: str, sep: str = ",", streaming: bool = False
) -> DataFrame:
    """Delimited text rows with a declared layout."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(schema).option("sep", sep).csv(path)
