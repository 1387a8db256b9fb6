"""Reading, scratch tables and small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import shared_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the shared folder: cuts lineage, survives lost executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def text_bytes(rows: DataFrame) -> int:
    """Bytes of all texts (doc_id, text)."""
    return rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]


def narrowed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, under fixed names, so no other column can clash."""
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col], F.lit("")).alias("text"),
    )


def smallest_hashes(rows: DataFrame, group: str, id_col: str, most: int, slot_bits: int = 12) -> DataFrame:
    """Of each group the ``most`` rows with the smallest hash of the id, ties by id.

    Rows are counted by group and leading bits of the hash, combined before the shuffle; only those
    of the first slots that together hold ``most`` rows are ranked, so no group meets in one task.
    """
    rank = F.xxhash64(id_col)
    marked = rows.withColumn("__slot", F.shiftright(rank, 64 - slot_bits))
    before = Window.partitionBy(group).orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    first = marked.groupBy(group, "__slot").agg(F.count(F.lit(1)).alias("__n")).withColumn(
        "__before", F.coalesce(F.sum("__n").over(before), F.lit(0))
    ).where(F.col("__before") < most).select(group, "__slot")
    place = F.row_number().over(Window.partitionBy(group).orderBy(rank, id_col))
    near = marked.join(first, [group, "__slot"]).withColumn("__place", place)
    return near.where(F.col("__place") <= most).select(*rows.columns)
