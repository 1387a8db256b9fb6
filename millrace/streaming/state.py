"""Stateful operators on streams of log records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.times import date_text
from millrace.operators.jumps import SLICES_PER_LIMIT, WITHIN_MS, time_slice
from millrace.operators.visits import is_entry
from millrace.streaming.processors import DailyFirst, FirstClaim, Runs

DAY_MS = 24 * 60 * 60 * 1000
NO_TIME = -(2**63)
#: Visitors share the state of a time slice in so many buckets.
BUCKETS = 1024

# Keep microseconds when a record travels as text.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _body(df: DataFrame, columns: Sequence[str] | None = None):
    return F.to_json(F.struct(*(columns or df.columns)), _JSON)


def _restore(states: DataFrame, like: DataFrame, *extra: str) -> DataFrame:
    record = F.from_json("body", like.schema, _JSON).alias("_r")
    return states.select(record, *extra).select("_r.*", *extra)


def _ordered(df: DataFrame, ts: str, tiebreak: Sequence[str]):
    ties = [(f"o{i}", df.select(c).schema[0].dataType.simpleString()) for i, c in enumerate(tiebreak)]
    # Records without a time come first, as in the batch forms.
    when = F.coalesce(F.col(ts), F.lit(NO_TIME)).alias("ts")
    columns = [when, *[F.col(c).alias(f"o{i}") for i, c in enumerate(tiebreak)]]
    return columns, ties


def _ddl(ties) -> str:
    return "ts bigint, " + "".join(f"{name} {kind}, " for name, kind in ties)


def repair_is_new_stream(
    records: DataFrame,
    ts: str = "ts",
    tiebreak: Sequence[str] = ("seq",),
    lanes: int = 1,
) -> DataFrame:
    """Keep ``is_new = '1'`` on a visitor's first claim ever, set later ones to ``'0'``.

    Only claims go through the keyed state; other records stay where they are.  With
    ``lanes`` over 1 a visitor's claims are first decided per lane of input
    partitions, and only each lane's first meets the others: for feeds in which one
    visitor claims to be new very often.
    """
    order, ties = _ordered(records, ts, tiebreak)
    claim = F.col("common.is_new").eqNullSafe("1")
    names = ["ts", *[name for name, _ in ties]]
    keys = ["mid", "lane"] if lanes > 1 else ["mid"]
    lane = "lane int, " if lanes > 1 else ""
    layout = f"mid string, {lane}{_ddl(ties)}is_new string, body string"

    def decide(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).transformWithStateInPandas(
            FirstClaim(names), layout, "append", "none"
        )

    flat = records.where(claim).select(
        F.col("common.mid").alias("mid"),
        *([(F.spark_partition_id() % lanes).alias("lane")] if lanes > 1 else []),
        *order, F.col("common.is_new").alias("is_new"), _body(records).alias("body"),
    )
    out = decide(flat)
    if lanes > 1:
        # Each lane's first claim goes to the visitor's common lane, the rest stays spread.
        first = F.col("is_new") == "1"
        out = decide(out.withColumn("lane", F.when(first, -1).otherwise(F.col("lane"))))
    decided = _restore(out, records, "is_new")
    common = F.col("common").withField("is_new", F.col("is_new"))
    decided = decided.withColumn("common", common).select(*records.columns)
    return decided.unionByName(records.where(~claim))


def unique_visits_stream(
    pages: DataFrame,
    key: str = "common.mid",
    ts: str = "ts",
    tiebreak: Sequence[str] = ("seq",),
    ttl_ms: int | None = None,
) -> DataFrame:
    """Entry pages whose day differs from the visitor's last one.

    A day coming back late passes again, unlike in the batch form.  ``ttl_ms``
    forgets a visitor that long (processing time) after its last passed row; use it
    with continuous triggers, not with ``availableNow``.
    """
    order, ties = _ordered(pages, ts, tiebreak)
    flat = pages.where(is_entry()).select(
        F.col(key).alias("mid"), *order, date_text(F.col(ts)).alias("day"),
        _body(pages).alias("body"),
    )
    names = ["ts", *[name for name, _ in ties]]
    layout = f"mid string, {_ddl(ties)}day string, body string"
    out = flat.groupBy("mid").transformWithStateInPandas(
        DailyFirst(names, ttl_ms), layout, "append", "processingTime" if ttl_ms else "none"
    )
    return _restore(out, pages)


def unique_visits_dedup_stream(
    pages: DataFrame,
    key: str = "common.mid",
    ts: str = "ts",
    delay: str = "24 hours",
    lanes: int = 16,
) -> DataFrame:
    """One entry page per visitor and day, whichever arrives first, without Python.

    Keeps (visitor, day) pairs until the watermark is past them.  A first round
    within ``lanes`` of input partitions leaves a hot visitor few rows for the second.
    """
    entries = pages.where(is_entry()).withColumns({
        "_et": F.timestamp_millis(F.col(ts)),
        "_mid": F.col(key),
        "_day": date_text(F.col(ts)),
        "_lane": F.spark_partition_id() % lanes,
    })
    return (
        entries.withWatermark("_et", delay)
        .dropDuplicatesWithinWatermark(["_mid", "_day", "_lane"])
        .dropDuplicatesWithinWatermark(["_mid", "_day"])
        .drop("_et", "_mid", "_day", "_lane")
    )


def jumps_stream(
    pages: DataFrame,
    within_ms: int = WITHIN_MS,
    lateness: str = "2 seconds",
    key: str = "common.mid",
    ts: str = "ts",
    tiebreak: Sequence[str] = ("seq",),
    slice_ms: int | None = None,
) -> DataFrame:
    """Bounces with their ``outcome``, each emitted once the watermark is past its limit."""
    return consecutive_match_stream(pages, 2, within_ms, lateness, key, ts, tiebreak, slice_ms)


def consecutive_match_stream(
    pages: DataFrame,
    n: int = 2,
    within_ms: int = WITHIN_MS,
    lateness: str = "2 seconds",
    key: str = "common.mid",
    ts: str = "ts",
    tiebreak: Sequence[str] = ("seq",),
    slice_ms: int | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Entry pages opening a run of ``n`` strictly consecutive ones, or running out of time before.

    The stream form of ``jumps.consecutive_match``; an entry is decided once the watermark is past its
    limit.  State is kept per (bucket of visitors, time slice) with the batch form's read-ahead, so a
    replayed backlog of one visitor spreads over its slices, and a call of the state program serves
    all of a bucket's visitors.  ``buckets`` bounds the number of calls: raise it where a bucket's rows of a
    slice are too many for one task.
    """
    width = max(slice_ms or within_ms * SLICES_PER_LIMIT, within_ms)
    own = time_slice(F.col("ts"), width)
    order, ties = _ordered(pages, ts, tiebreak)
    flat = pages.where(F.col(ts).isNotNull()).select(
        F.col(key).alias("mid"), *order, is_entry().alias("start"),
        F.when(is_entry(), _body(pages)).alias("body"),
    ).withColumn("et", F.timestamp_millis("ts")).withWatermark("et", lateness)
    ahead = F.pmod(F.col("ts"), F.lit(width)) < within_ms
    sliced = flat.withColumn(
        "slice", F.explode(F.when(ahead, F.array(own, own - 1)).otherwise(F.array(own)))
    ).withColumns({
        "body": F.when(F.col("slice") == own, F.col("body")),
        "bucket": F.pmod(F.xxhash64("mid"), F.lit(buckets)),
    })
    out = sliced.groupBy("bucket", "slice").transformWithStateInPandas(
        Runs(ties, within_ms, n), "body string, outcome string", "append", "eventTime"
    )
    return _restore(out, pages, "outcome")
