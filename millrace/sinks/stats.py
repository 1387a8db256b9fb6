"""Storing closed statistics windows."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_parquet(path: str) -> Callable[[DataFrame, int], None]:
    """A micro-batch writer: windows by day, a replayed batch replacing its own files."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumns({"day": F.substring("stt", 1, 10), "batch": F.lit(batch_id)})
            .write.partitionBy("day", "batch")
            .option("partitionOverwriteMode", "dynamic")
            .mode("overwrite")
            .parquet(path)
        )
    return write


def to_jdbc(table: str, options: Mapping[str, str]) -> Callable[[DataFrame, int], None]:
    """A micro-batch writer appending to a database table."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format("jdbc").options(**options).option("dbtable", table).mode("append").save()
    return write
