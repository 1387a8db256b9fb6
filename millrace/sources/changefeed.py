"""Change feeds: a topic of envelopes, optionally preceded by a table's rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.operators.changes import (
    only_tables,
    parse_envelopes,
    snapshot_as_changes,
    snapshot_then_changes,
)
from millrace.sources.topics import Start, Topics


def change_feed(
    topics: Topics,
    topic: str,
    tables: tuple[str, ...] = (),
    start: Start = Start(),
    streaming: bool = False,
) -> DataFrame:
    """Changes of the named tables (all when none are named)."""
    lines = topics.read_stream(topic, start) if streaming else topics.read(topic, start)
    return only_tables(parse_envelopes(lines), *tables)


def table_feed(
    topics: Topics, topic: str, database: str, table: str, snapshot: DataFrame
) -> DataFrame:
    """One table from the beginning: its rows as ``read`` changes, then its changes."""
    changes = change_feed(topics, topic, (f"{database}.{table}",))
    return snapshot_then_changes(snapshot_as_changes(snapshot, database, table), changes)
