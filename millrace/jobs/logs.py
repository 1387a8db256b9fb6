"""Log stages: split, unique visits, bounces, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.functions.records import parse_typed
from millrace.operators import logs
from millrace.schemas import ODS_LOG
from millrace.sinks.stats import to_parquet
from millrace.sinks.topics import write_routed, write_topic_stream
from millrace.sources.topics import POSITION, Topics
from millrace.streaming import state
from millrace.streaming.runner import start_batches
from millrace.streaming.stats import STATS_DELAY, visitor_stats_stream

# Topics of the log stages.
ODS = "ods_base_log"
DIRTY = "dirty_log"
VISITS = "dwm_unique_visit"
JUMPS = "dwm_user_jump_detail"

LANES = 16


def _page_stream(
    topics: Topics, topic: str, files_per_batch: int | None, schema: StructType = ODS_LOG
) -> DataFrame:
    return parse_typed(topics.read_stream(topic, files_per_batch=files_per_batch), schema)


def split_logs(
    topics: Topics, checkpoint: str, trigger: dict | None = None,
    files_per_batch: int | None = None, schema: StructType = ODS_LOG,
) -> list[StreamingQuery]:
    """Raw logs to start, page and display topics; malformed texts to their own.

    Start and page logs are the whole source records with only ``common.is_new`` replaced.
    In the next stages, ``schema`` names the log fields that are carried on.
    """
    def parsed():
        return logs.parse(topics.read_stream(ODS, files_per_batch=files_per_batch), schema=schema)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_routed(topics, logs.split_lines(batch, schema.names, "value"), "split_logs", batch_id)

    def write_dirty(batch: DataFrame, batch_id: int) -> None:
        write_routed(topics, batch.withColumn("topic", F.lit(DIRTY)), "dirty_logs", batch_id)

    # Lanes leave a visitor that keeps claiming to be new few rows for its one task.
    repaired = state.repair_is_new_stream(logs.good(parsed(), keep_text=True), tiebreak=POSITION, lanes=LANES)
    return [
        start_batches(repaired, write, f"{checkpoint}/split", trigger, "split_logs"),
        start_batches(logs.dirty(parsed()), write_dirty, f"{checkpoint}/dirty", trigger, "dirty_logs"),
    ]


def unique_visits(
    topics: Topics, checkpoint: str, trigger: dict | None = None,
    files_per_batch: int | None = None, ttl_ms: int | None = state.DAY_MS,
    schema: StructType = ODS_LOG,
) -> list[StreamingQuery]:
    """Page logs to daily unique visits; visitors are forgotten after ``ttl_ms``."""
    pages = _page_stream(topics, logs.PAGE_TOPIC, files_per_batch, schema)
    found = state.unique_visits_stream(pages, tiebreak=POSITION, ttl_ms=ttl_ms)
    return [
        write_topic_stream(
            topics, found.select(*schema.names), VISITS, f"{checkpoint}/visits", trigger,
            close_windows=False,
        )
    ]


def user_jumps(
    topics: Topics, checkpoint: str, trigger: dict | None = None,
    files_per_batch: int | None = None, schema: StructType = ODS_LOG,
) -> list[StreamingQuery]:
    """Page logs to bounces."""
    pages = _page_stream(topics, logs.PAGE_TOPIC, files_per_batch, schema)
    found = state.jumps_stream(pages, tiebreak=POSITION)
    return [
        write_topic_stream(
            topics, found.select(*schema.names), JUMPS, f"{checkpoint}/jumps", trigger
        )
    ]


def visitor_stats(
    topics: Topics, checkpoint: str, out: str, trigger: dict | None = None,
    files_per_batch: int | None = None, delay: str = STATS_DELAY,
) -> list[StreamingQuery]:
    """Visits, bounces and page logs to stored statistics windows."""
    sides = [_page_stream(topics, t, files_per_batch) for t in (VISITS, JUMPS, logs.PAGE_TOPIC)]
    stats = visitor_stats_stream(*sides, delay=delay)
    return [start_batches(stats, to_parquet(out), f"{checkpoint}/stats", trigger, "visitor_stats")]
