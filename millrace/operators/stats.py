"""Visitor statistics per tumbling window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from millrace.functions.times import date_text, time_text
from millrace.operators.jumps import SLICES_PER_LIMIT, WITHIN_MS, time_slice
from millrace.operators.visits import is_entry
from millrace.schemas import VISITOR_STATS

WINDOW = "10 seconds"
GROUP = ["ar", "ch", "is_new", "vc"]
MEASURES = ["uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"]


def _stats_rows(records: DataFrame, carry: Sequence[str], **measures: Column) -> DataFrame:
    zero = F.lit(0)
    return records.select(
        F.struct(*[F.col(f"common.{c}") for c in ("mid", *GROUP)]).alias("common"),
        *[measures.get(m, zero).cast("bigint").alias(m) for m in MEASURES],
        "ts",
        *carry,
    )


def to_stats_rows(
    visits: DataFrame, jumps: DataFrame, pages: DataFrame, carry: Sequence[str] = ()
) -> DataFrame:
    """Unique visits, bounces and page views as one table of 0/1 counters."""
    one = F.lit(1)
    entered = F.when(is_entry(), 1).otherwise(0)
    stay = F.coalesce("page.during_time", F.lit(0))
    return (
        _stats_rows(visits, carry, uv_ct=one)
        .unionByName(_stats_rows(jumps, carry, uj_ct=one))
        .unionByName(_stats_rows(pages, carry, pv_ct=one, sv_ct=entered, dur_sum=stay))
    )


def aggregate(rows: DataFrame, window: str = WINDOW, event_time: str = "et") -> DataFrame:
    """Sums per window and (area, channel, is_new, version); the end is exclusive."""
    dims = [F.col(f"common.{c}").alias(c) for c in GROUP]
    return (
        rows.groupBy(F.window(event_time, window).alias("_w"), *dims)
        .agg(*[F.sum(m).alias(m) for m in MEASURES], F.min("ts").alias("ts"))
        .withColumns({"stt": time_text(F.col("_w.start")), "edt": time_text(F.col("_w.end"))})
        .select(*VISITOR_STATS.names)
    )


def visitor_stats(
    visits: DataFrame, jumps: DataFrame, pages: DataFrame, window: str = WINDOW
) -> DataFrame:
    """Statistics of the three tables derived from repaired logs."""
    rows = to_stats_rows(visits, jumps, pages).withColumn("et", F.timestamp_millis("ts"))
    return aggregate(rows, window)


def visitor_stats_of_logs(
    pages: DataFrame,
    within_ms: int = WITHIN_MS,
    window: str = WINDOW,
    tiebreak: Sequence[str] = ("seq",),
    slice_ms: int | None = None,
) -> DataFrame:
    """Statistics straight from unrepaired page logs, read and shuffled once.

    Records meet by (visitor, time slice), with the read-ahead of ``consecutive_match``; that decides
    bounces.  A slice's first claim to be new and its first entry page of each day are the only records
    for which other slices matter: they alone meet by visitor, at most a few per slice however
    many records a visitor has.  All others count at once, their claims as known visitors.
    """
    width = max(slice_ms or within_ms * SLICES_PER_LIMIT, within_ms)
    ties = [f"o{i}" for i in range(len(tiebreak))]
    own = time_slice(F.col("ts"), width)
    ahead = F.pmod(F.col("ts"), F.lit(width)) < within_ms
    rows = pages.select(
        *[F.col(f"common.{c}").alias(c) for c in ("mid", *GROUP)], "ts",
        *[F.col(c).alias(name) for c, name in zip(tiebreak, ties)],
        is_entry().alias("entry"), F.coalesce("page.during_time", F.lit(0)).alias("stay"),
    ).withColumn("slice", F.explode(F.when(ahead, F.array(own, own - 1)).otherwise(F.array(own))))

    claim, day = F.col("is_new").eqNullSafe("1"), date_text(F.col("ts"))
    in_slice = Window.partitionBy("mid", "slice").orderBy("ts", *ties)
    of_mid = Window.partitionBy("mid").orderBy("ts", *ties)

    def first_claim(claims: Column, over: WindowSpec) -> Column:
        return claims & (F.count(F.when(claims, 1)).over(over.rowsBetween(Window.unboundedPreceding, 0)) == 1)

    def first_of_day(entries: Column, over: WindowSpec) -> Column:
        """Days rise with the order, so an entry is the first of its day if the last one before has another."""
        last = F.max(F.when(entries, day)).over(over.rowsBetween(Window.unboundedPreceding, -1))
        return entries & ~last.eqNullSafe(day)

    gap = F.lead("ts").over(in_slice) - F.col("ts")
    lone = ~F.coalesce(gap < within_ms, F.lit(False))
    # A slice's own records come before those read ahead, so these change nothing for them but the bounces.
    seen = rows.withColumns({
        "uj": F.col("entry") & (lone | F.coalesce(F.lead("entry").over(in_slice), F.lit(False))),
        "claim_first": first_claim(claim, in_slice), "visit_first": first_of_day(F.col("entry"), in_slice),
    }).where(F.col("slice").eqNullSafe(own))
    open_ = F.col("claim_first") | F.col("visit_first")
    flag = F.when(claim, "0").otherwise(F.col("is_new"))
    kept = ["ar", "ch", "vc", "ts", "entry", "stay", "uj"]
    settled = seen.where(~open_).select(*kept, flag.alias("is_new"), F.lit(False).alias("uv"))
    decided = seen.where(open_).withColumns({
        "new": first_claim(F.col("claim_first"), of_mid), "uv": first_of_day(F.col("visit_first"), of_mid),
    }).select(*kept, F.when(F.col("new"), "1").otherwise(flag).alias("is_new"), "uv")
    counters = {
        "uv_ct": F.col("uv"), "pv_ct": F.lit(1), "sv_ct": F.col("entry"), "uj_ct": F.col("uj"), "dur_sum": F.col("stay"),
    }
    counted = settled.unionByName(decided).select(
        F.struct(*GROUP).alias("common"), *[c.cast("bigint").alias(name) for name, c in counters.items()], "ts",
        F.timestamp_millis("ts").alias("et"),
    )
    return aggregate(counted, window)
