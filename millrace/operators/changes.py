"""Change-data-capture records: normalising, filtering, changelog, current state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from millrace.functions.records import parse_typed
from millrace.operators.latest import first_per_key
from millrace.schemas import CDC_ENVELOPE, CDC_RECORD

#: Type of a row image: fields by name, each with its JSON type.
FIELDS = "map<string,variant>"

# One-letter operation codes of change-feed records.
OP_CODES = {"c": "create", "u": "update", "d": "delete", "r": "read"}


def change_type(op: Column) -> Column:
    """Operation name in lower case, ``create`` renamed to ``insert``."""
    name = F.lower(op)
    for code, word in OP_CODES.items():
        name = F.when(F.lower(op) == code, F.lit(word)).otherwise(name)
    return F.when(name == "create", F.lit("insert")).otherwise(name)


def _image(df: DataFrame, column: str) -> Column:
    """A row image as map<string,variant>, nulls left out; ``{}`` where it is absent."""
    image = F.col(column)
    if isinstance(df.schema[column].dataType, MapType):
        image = image.cast(FIELDS)
    else:
        image = F.from_json(F.to_json(image), FIELDS)
    known = F.map_filter(image, lambda _, v: v.isNotNull() & ~F.is_variant_null(v))
    return F.coalesce(known, F.create_map().cast(FIELDS))


def normalize(
    records: DataFrame,
    topic: str = "topic",
    op: str = "op",
    before: str = "before",
    after: str = "after",
) -> DataFrame:
    """Raw change records to ``database, tableName, before, after, type``.

    ``topic`` reads ``server.database.table``.  Columns other than the four
    named ones (positions, for example) are kept.
    """
    parts = F.split(F.col(topic), r"\.")
    kept = [c for c in records.columns if c not in (topic, op, before, after)]
    return records.select(
        *kept,
        F.get(parts, F.lit(1)).alias("database"),
        F.get(parts, F.lit(2)).alias("tableName"),
        _image(records, before).alias("before"),
        _image(records, after).alias("after"),
        change_type(F.col(op)).alias("type"),
    )


def parse_records(lines: DataFrame, value: str = "value") -> DataFrame:
    """Raw change-feed texts (``topic, op, before, after``) to columns."""
    return parse_typed(lines, CDC_RECORD, value)


def placed(records: DataFrame, position: Sequence[str]) -> DataFrame:
    """Add ``at``, which orders changes whatever files or partitions they pass later.

    The database's log position comes first, then the time of the change, then ``position``
    (columns ``src, part, off`` of the raw topic); what a feed does not name is null.
    """
    source = F.col("source")
    at = F.struct(
        source["file"].alias("file"), source["pos"].alias("pos"), source["row"].alias("row"),
        F.coalesce(source["ts_ms"], "ts_ms").alias("ts_ms"), *position,
    )
    return records.withColumn("at", at).drop("source", "ts_ms")


def parse_envelopes(lines: DataFrame, value: str = "value") -> DataFrame:
    """Envelope texts to columns."""
    return parse_typed(lines, CDC_ENVELOPE, value)


def drop_deletes(changes: DataFrame) -> DataFrame:
    """All but deletes; a missing type is kept."""
    return changes.where(~F.col("type").eqNullSafe("delete"))


def only_tables(changes: DataFrame, *tables: str) -> DataFrame:
    """Changes of the named ``database.table`` or ``table``; none named means all."""
    if not tables:
        return changes
    full = [t for t in tables if "." in t]
    bare = [t for t in tables if "." not in t]
    wanted = F.lit(False)
    if bare:
        wanted = wanted | F.col("tableName").isin(bare)
    if full:
        wanted = wanted | F.concat_ws(".", "database", "tableName").isin(full)
    return changes.where(wanted)


def above_place(records: DataFrame, file: str, pos: int) -> DataFrame:
    """Placed changes above a place of the database's log; those that name no place are kept."""
    there = F.struct(F.lit(file).alias("file"), F.lit(pos).cast("bigint").alias("pos"))
    named = F.struct(F.col("at")["file"].alias("file"), F.col("at")["pos"].alias("pos"))
    return records.where(F.col("at")["file"].isNull() | (named > there))


def snapshot_as_changes(snapshot: DataFrame, database: str, table: str) -> DataFrame:
    """Rows of a table as ``read`` envelopes."""
    image = F.from_json(F.to_json(F.struct(*snapshot.columns)), FIELDS)
    rows = snapshot.select(
        F.lit(f"snapshot.{database}.{table}").alias("topic"),
        F.lit("read").alias("op"),
        F.lit(None).cast(FIELDS).alias("before"),
        image.alias("after"),
    )
    return normalize(rows)


def snapshot_then_changes(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """The ``initial`` start: a table's rows, then its later changes."""
    return snapshot.unionByName(changes, allowMissingColumns=True)


def to_changelog(changes: DataFrame) -> DataFrame:
    """Add/withdraw rows of a changing table: ``is_add`` and the row's ``image``.

    An update withdraws its old image and adds its new one.
    """
    steps = (
        F.when(F.col("type").isin("insert", "read"), F.array(F.lit(True)))
        .when(F.col("type") == "update", F.array(F.lit(False), F.lit(True)))
        .when(F.col("type") == "delete", F.array(F.lit(False)))
    )
    kept = [c for c in changes.columns if c not in ("before", "after", "type")]
    image = F.when(F.col("is_add"), F.col("after")).otherwise(F.col("before"))
    return changes.withColumn("is_add", F.explode(steps)).select(
        *kept, "is_add", image.alias("image")
    )


def current_state(
    changes: DataFrame, key: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Live rows of a changing table: each key's last image unless withdrawn.

    ``key`` names image fields, ``order`` the columns giving the change order.
    Working on add/withdraw rows keeps updates that alter a key right.
    """
    names = [f"_k{i}" for i in range(len(key))]
    keyed = to_changelog(changes).withColumns(
        {name: F.col("image")[k].cast("string") for name, k in zip(names, key)}
    )
    known = keyed.dropna(subset=names).withColumn("image", F.when(F.col("is_add"), F.col("image")))
    newest = [F.col(c).desc() for c in order] + [F.col("is_add").desc()]
    return first_per_key(known, names, newest).where("is_add").drop("is_add", *names)


def register_table(state: DataFrame, name: str, columns: Sequence[str]) -> None:
    """Expose a change table's live rows to ``spark.sql`` as view ``name``, fields as text."""
    state.select(*[F.col("image")[c].cast("string").alias(c) for c in columns]).createOrReplaceTempView(name)
