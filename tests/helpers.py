"""Small log fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.schemas import ODS_LOG
from pyspark.sql.types import ArrayType, LongType, MapType, StringType, StructField, StructType



def page_schema():
    schema = type(ODS_LOG)(list(ODS_LOG.fields))
    return schema.add("seq", LongType())


def page(mid, second, kind="N", seq=None, is_new="0", during=None, dims=("v", "c", "a"), displays=None, start=None):
    """One log record: kind ``E`` entry page (null), ``e`` (empty text), ``B`` blank, ``N`` other."""
    last = {"E": None, "e": "", "B": " ", "N": "home"}[kind]
    ts = round(second * 1000)
    vc, ch, ar = dims
    return (
        (mid, is_new, vc, ch, ar), ("p1", last, during), start, displays, ts,
        ts if seq is None else seq,
    )


def pages(spark, *rows):
    texts = StructField("displays", ArrayType(MapType(StringType(), StringType())))
    schema = StructType([texts if f.name == "displays" else f for f in page_schema().fields])
    rows = spark.createDataFrame(list(rows), schema)
    return rows.withColumn("displays", F.col("displays").cast(ODS_LOG["displays"].dataType)).select(*page_schema().names)


def plain(image):
    """Fields of an image or display item as Python values."""
    return {k: v.toPython() for k, v in image.items()}


def seen(df):
    """(visitor, second) pairs, sorted."""
    rows = df.select("common.mid", (F.col("ts") / 1000).alias("s")).collect()
    return sorted((r[0], r[1]) for r in rows)
