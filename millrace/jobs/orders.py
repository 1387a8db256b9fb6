"""Order stages: order and payment wide tables."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.records import parse_typed
from millrace.operators import orders
from millrace.operators.lookups import hot_keys
from millrace.schemas import ORDER_DETAIL, ORDER_INFO, ORDER_WIDE, PAYMENT_INFO
from millrace.sinks.topics import write_topic, write_topic_stream
from millrace.sources.topics import Topics
from millrace.streaming.joins import interval_join_stream
from millrace.streaming.runner import query_conf, start_batches

# Topics of the order stages.
ORDER_TOPIC = "dwd_order_info"
DETAIL_TOPIC = "dwd_order_detail"
PAYMENT_TOPIC = "dwd_payment_info"
WIDE_TOPIC = "dwm_order_wide"
PAID_TOPIC = "dwm_payment_wide"

#: Joins of rows wider than this do not become one method with the text of the row: the JVM's compiler took some 400 MB
#: beside the heap to compile that one, and gave up.
WIDE_CONF = {"spark.sql.codegen.maxFields": "30"}


def order_wide(
    topics: Topics,
    read_dims: Callable[[], Mapping[str, DataFrame]],
    checkpoint: str,
    trigger: dict | None = None,
    files_per_batch: int | None = None,
    delay: str = "0 seconds",
) -> list[StreamingQuery]:
    """Orders joined to their lines, dimensions read anew for every micro-batch."""
    def read(topic, schema):
        return parse_typed(topics.read_stream(topic, files_per_batch=files_per_batch), schema)

    joined = interval_join_stream(
        orders.prepare_order_info(read(ORDER_TOPIC, ORDER_INFO)),
        orders.prepare_order_detail(read(DETAIL_TOPIC, ORDER_DETAIL)),
        [("id", "order_id")], "create_ts", "create_ts", *orders.ORDER_INTERVAL_MS,
        left_delay=delay, right_delay=delay,
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            hot = hot_keys(batch, ["user_id", "province_id", "sku_id"])
            wide = orders.enrich(batch, read_dims(), int(time.time() * 1000), hot=hot)
            with query_conf(batch.sparkSession, WIDE_CONF):
                write_topic(topics, wide, WIDE_TOPIC, "order_wide", batch_id)
        finally:
            batch.unpersist()

    # An inner join gives nothing in batches that only move the time on; the next one drops what is past.
    merged = orders.merge_order(joined)
    return [start_batches(merged, write, f"{checkpoint}/order_wide", trigger, "order_wide", close_windows=False)]


def payment_wide(
    topics: Topics, checkpoint: str, trigger: dict | None = None,
    files_per_batch: int | None = None, delay: str = "0 seconds",
) -> list[StreamingQuery]:
    """Payments joined to the order lines they pay."""
    def read(topic, schema):
        # A time that does not parse falls back to when the record was stored.
        rows = parse_typed(topics.read_stream(topic, files_per_batch=files_per_batch), schema)
        return orders.timed_by_creation(rows, "stored_ms")

    joined = interval_join_stream(
        read(PAYMENT_TOPIC, PAYMENT_INFO), read(WIDE_TOPIC, ORDER_WIDE),
        [("order_id", "order_id")], "create_ts", "create_ts", *orders.PAYMENT_INTERVAL_MS,
        left_delay=delay, right_delay=delay,
    )
    return [
        write_topic_stream(
            topics, orders.merge_payment(joined), PAID_TOPIC, f"{checkpoint}/payment_wide", trigger,
            close_windows=False,
        )
    ]
