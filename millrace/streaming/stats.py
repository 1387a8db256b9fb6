"""Visitor statistics on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.stats import WINDOW, aggregate, to_stats_rows

# Bounces come up to lateness (2 s) + limit (10 s) after their event; wait a second more.
STATS_DELAY = "13 seconds"


def visitor_stats_stream(
    visits: DataFrame,
    jumps: DataFrame,
    pages: DataFrame,
    window: str = WINDOW,
    delay: str = STATS_DELAY,
) -> DataFrame:
    """Closed windows of the three united streams; one watermark after the union."""
    rows = to_stats_rows(visits, jumps, pages).withColumn("et", F.timestamp_millis("ts"))
    return aggregate(rows.withWatermark("et", delay), window)
