"""Whole dimension tables as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from millrace.functions.records import to_camel


def read_table(
    spark: SparkSession,
    location: str,
    format: str = "parquet",
    options: Mapping[str, str] | None = None,
    camel_case: bool = False,
) -> DataFrame:
    """A table by path, by catalog name (``format="table"``) or through JDBC options."""
    if format == "table":
        df = spark.table(location)
    elif format == "jdbc":
        df = spark.read.format("jdbc").options(**(options or {})).option("dbtable", location).load()
    else:
        df = spark.read.format(format).options(**(options or {})).load(location)
    return to_camel(df) if camel_case else df
