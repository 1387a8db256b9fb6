"""Whole-record helpers: JSON text, merging, column naming."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, LongType, MapType, StringType, StructField, StructType


def numbers_as_text(schema: StructType) -> StructType:
    """The same layout with long fields as text, so quoted numbers parse too."""
    def loose(kind: DataType) -> DataType:
        if isinstance(kind, LongType):
            return StringType()
        if isinstance(kind, StructType):
            return numbers_as_text(kind)
        return kind
    return StructType([StructField(f.name, loose(f.dataType)) for f in schema.fields])


def as_typed(value: Column, kind: DataType) -> Column:
    """A field read with ``numbers_as_text`` in its own type; null where it is none."""
    if isinstance(kind, LongType):
        return value.try_cast("bigint")
    if isinstance(kind, StructType):
        inner = [as_typed(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*inner))
    if isinstance(kind, (ArrayType, MapType, StringType)):
        return value
    return value.try_cast(kind)


def parse_typed(
    lines: DataFrame,
    schema: StructType,
    value: str = "value",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """JSON texts to the columns of ``schema``; other columns of ``lines`` are kept.

    A text that does not parse gives nulls; numbers may be quoted.  The fields come out of a generator so
    that each text is parsed once: filters on them stay above it instead of parsing
    the text again for every condition.
    """
    kept = [c for c in lines.columns if c != value]
    loose = numbers_as_text(schema)
    record = F.from_json(F.col(value), loose, dict(options or {}))
    parsed = lines.select(*kept, F.inline(F.array(record)))
    if loose == schema:
        return parsed
    return parsed.select(*kept, *(as_typed(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields))


def to_lines(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One JSON text per row in column ``value``; null fields are left out."""
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias("value"))


def first_non_null(
    left: str, right: str, columns: Sequence[str], keep_left: Sequence[str] = ()
) -> list[Column]:
    """``coalesce(left.c, right.c)`` per column; those in ``keep_left`` stay the left's."""
    merged = []
    for c in columns:
        own = F.col(f"{left}.{c}")
        merged.append((own if c in keep_left else F.coalesce(own, F.col(f"{right}.{c}"))).alias(c))
    return merged


def camel(name: str) -> str:
    head, *rest = name.lower().split("_")
    return head + "".join(word.capitalize() for word in rest)


def to_camel(df: DataFrame) -> DataFrame:
    """Rename snake_case columns to camelCase."""
    return df.toDF(*[camel(c) for c in df.columns])
