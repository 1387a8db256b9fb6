"""Bounce detection: entry pages not followed by another page in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.visits import is_entry

WITHIN_MS = 10_000
SLICES_PER_LIMIT = 60


def time_slice(ts: Column, width_ms: int) -> Column:
    return F.floor(ts / F.lit(width_ms))


def consecutive_match(
    pages: DataFrame,
    n: int = 2,
    within_ms: int = WITHIN_MS,
    key: str = "common.mid",
    ts: str = "ts",
    tiebreak: Sequence[str] = ("seq",),
    starts: Column | None = None,
    slice_ms: int | None = None,
) -> DataFrame:
    """Events opening a run of ``n`` strictly consecutive ``starts`` events of one key.

    ``outcome`` is ``match`` where the run completes in less than ``within_ms``,
    ``timeout`` where that time passes (or the input ends) before anything broke it.

    Only events less than ``within_ms`` later can decide an event, so keys are cut
    into time slices, each reading ahead into the first ``within_ms`` of the next.
    A hot key thus spreads over its slices and still costs one shuffle; rows that
    cannot be results carry no payload through it.
    """
    width = max(slice_ms or within_ms * SLICES_PER_LIMIT, within_ms)
    starts = is_entry() if starts is None else starts
    own = time_slice(F.col("_ts"), width)
    ahead = F.pmod(F.col("_ts"), F.lit(width)) < within_ms
    ties = [f"_o{i}" for i in range(len(tiebreak))]
    events = pages.withColumns({
        "_key": F.col(key),
        "_ts": F.col(ts),
        **{name: F.col(c) for name, c in zip(ties, tiebreak)},
        "_start": starts,
    }).withColumn("_slice", F.explode(F.when(ahead, F.array(own, own - 1)).otherwise(F.array(own))))
    events = events.withColumn("_keep", F.col("_start") & (F.col("_slice") == own))
    events = events.withColumns({c: F.when(F.col("_keep"), F.col(c)) for c in pages.columns})

    order = Window.partitionBy("_key", "_slice").orderBy("_ts", *ties)
    outcome = F.lit("match")
    for step in range(n - 1, 0, -1):
        gap = F.lead("_ts", step).over(order) - F.col("_ts")
        in_time = F.coalesce(gap < within_ms, F.lit(False))
        again = F.lead("_start", step).over(order)
        outcome = F.when(~in_time, F.lit("timeout")).when(again, outcome)
    decided = events.withColumn("outcome", outcome)
    return decided.where("_keep and outcome is not null").select(*pages.columns, "outcome")


def detect(pages: DataFrame, within_ms: int = WITHIN_MS, **options) -> DataFrame:
    """Bounces: the entry event of every match and of every timeout."""
    return consecutive_match(pages, 2, within_ms, **options).drop("outcome")


def matched(outcomes: DataFrame) -> DataFrame:
    return outcomes.where("outcome = 'match'").drop("outcome")


def timed_out(outcomes: DataFrame) -> DataFrame:
    return outcomes.where("outcome = 'timeout'").drop("outcome")
