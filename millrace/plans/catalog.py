"""Registered queries: name -> callable of (spark, table folder)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions import records, times
from millrace.jobs import changes as change_jobs
from millrace.jobs import orders as order_jobs
from millrace.jobs.run import dimension_reader
from millrace.operators import changes, joins, jumps, logs, lookups, orders, routing, stats, visits
from millrace.plans import adapters as a
from millrace.schemas import ORDER_WIDE, PAYMENT_WIDE, TABLE_PROCESS, VISITOR_STATS
from millrace.session import DUPLICATES_KEY, shared_dir
from millrace.sinks.dimensions import DimensionTable
from millrace.sinks.stats import to_parquet
from millrace.sinks.topics import write_routed, write_topic
from millrace.sources.tables import read_table
from millrace.sources.topics import CHANGE_ORDER, Start, Topics, delimited, log_files
from millrace.streaming import joins as stream_joins
from millrace.streaming import state
from millrace.streaming.late import start_splitting
from millrace.streaming.runner import run_to_table, start_batches
from millrace.streaming.stats import visitor_stats_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

WITHIN_MS = 6 * a.HOUR_MS

#: Raw records are dealt to files of about so many at most; a turn of micro-batches takes as many files as that makes.
FILE_RECORDS = 250_000


def query(fn: Query) -> Query:
    """Register under the function's name, with the session zone pinned to UTC."""
    @wraps(fn)
    def pinned(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.set(DUPLICATES_KEY, "true")
        return fn(spark, sf_dir)
    QUERIES[fn.__name__] = pinned
    return pinned


def _brief(pages: DataFrame, *extra: str) -> DataFrame:
    return pages.select("seq", F.col("common.mid").alias("mid"), "ts", *extra)


# Logs

@query
def parse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = logs.good(logs.parse(a.log_lines(spark, sf_dir)))
    return good.select(
        "seq", "common.mid", "common.is_new", "common.vc", "common.ch", "common.ar",
        "page.page_id", "page.last_page_id", "page.during_time", "start",
        F.size("displays").alias("n_displays"), "ts",
    )


@query
def dirty_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.dirty(logs.parse(a.log_lines(spark, sf_dir, errors_raw=True)))


@query
def entry_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _brief(a.pages(spark, sf_dir).where(visits.is_entry()))


@query
def repair_is_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    repaired = logs.repair_is_new(a.pages(spark, sf_dir))
    return _brief(repaired, "common.is_new")


@query
def log_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    records_ = a.pages(spark, sf_dir)
    sides = {
        "start": logs.start_logs(records_),
        "page": logs.page_logs(records_),
        "display": logs.display_logs(records_),
    }
    counts = [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("side"), "n")
        for name, df in sides.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query
def split_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of the split, of texts with fields that the layout of logs does not name."""
    seq = F.col("seq").cast("string")
    text = F.concat(F.lit('{"err":{"code":'), seq, F.lit('},"actions":[{"id":'), seq, F.lit("}],"), F.expr("substr(value, 2)"))
    for name, field, mark in (("common", "uid", "u"), ("page", "item", "p")):
        text = F.regexp_replace(
            text, F.lit(f'"{name}":\\{{'), F.concat(F.lit(f'"{name}":{{"{field}":"{mark}'), seq, F.lit('",'))
        )
    parsed = logs.parse(a.log_lines(spark, sf_dir).select("seq", text.alias("value")))
    lines = logs.split_lines(logs.repair_is_new(logs.good(parsed, keep_text=True)), text="value")
    paths = {
        "mid": "$.common.mid", "is_new": "$.common.is_new", "uid": "$.common.uid", "page_item": "$.page.item",
        "action": "$.actions[0].id", "err": "$.err.code", "ts": "$.ts", "start": "$.start", "shown": "$.item",
    }
    found = {name: F.get_json_object("value", path) for name, path in paths.items()}
    found["start"] = found["start"].isNotNull()
    page = F.coalesce(F.get_json_object("value", "$.page.page_id"), F.get_json_object("value", "$.page_id"))
    return lines.select("topic", *[c.alias(name) for name, c in found.items()], page.alias("page_id"))


@query
def start_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _brief(logs.start_logs(a.pages(spark, sf_dir)), "start")


@query
def display_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    display = F.col("display")
    return logs.display_logs(a.pages(spark, sf_dir)).select(
        display["item"].cast("string").alias("item"), display["order"].cast("bigint").alias("order"),
        display["page_id"].cast("string").alias("page_id"), F.to_json("display").alias("value"),
    )


@query
def display_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items keep their types from the raw text to the topic's text, where fields are in order of name."""
    parsed = logs.good(logs.parse(a.log_lines(spark, sf_dir)), keep_text=True)
    lines = logs.split_lines(logs.repair_is_new(parsed), text="value")
    return lines.where(F.col("topic") == logs.DISPLAY_TOPIC).select("value")


# Visits, bounces, statistics

@query
def unique_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _brief(visits.unique_visits(a.pages(spark, sf_dir)))


@query
def user_jumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _brief(jumps.detect(a.pages(spark, sf_dir), WITHIN_MS))


@query
def jump_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _brief(jumps.consecutive_match(a.pages(spark, sf_dir), 2, WITHIN_MS), "outcome")


@query
def consecutive_3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _brief(jumps.matched(jumps.consecutive_match(a.pages(spark, sf_dir), 3, 24 * a.HOUR_MS)))


@query
def visitor_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.visitor_stats_of_logs(a.pages(spark, sf_dir), WITHIN_MS, "1 day")


# Change data

@query
def cdc_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.normalize(a.order_records(spark, sf_dir)).select(
        "seq", "database", "tableName", F.to_json("before").alias("before"),
        F.to_json("after").alias("after"), "type",
    )


@query
def cdc_drop_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = changes.drop_deletes(changes.normalize(a.order_records(spark, sf_dir)))
    return kept.groupBy("type").agg(F.count("*").alias("n"))


@query
def cdc_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = changes.to_changelog(changes.normalize(a.order_records(spark, sf_dir)))
    image = F.col("image")
    return log.select(
        "seq", "is_add", image["id"].cast("string").alias("id"), image["status"].cast("string").alias("status")
    )


@query
def cdc_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = changes.current_state(a.line_changes(spark, sf_dir), ["id"], a.LINE_ORDER)
    image = F.col("image")
    return live.select(image["id"].cast("string").alias("id"), image["part"].cast("string").alias("part"))


@query
def cdc_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = changes.current_state(a.line_changes(spark, sf_dir), ["id"], a.LINE_ORDER)
    changes.register_table(live, "last_line", ["id", "part"])
    return spark.sql("select * from last_line")


@query
def cdc_snapshot_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = a.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name")
    )
    feed = changes.only_tables(a.shop_changes(spark, sf_dir), "shop.orders")
    whole = changes.snapshot_then_changes(
        changes.snapshot_as_changes(customers, "shop", "customer"), feed
    )
    return whole.groupBy("tableName", "type").agg(F.count("*").alias("n"))


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(a.RULES, TABLE_PROCESS)
    return routing.route(changes.drop_deletes(a.shop_changes(spark, sf_dir)), rules)


@query
def route_kafka(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.topic_lines(_routed(spark, sf_dir)).select("topic", "value")


@query
def route_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.table_rows(_routed(spark, sf_dir)).select(
        "sink_table", "sink_pk", "type", F.to_json("data").alias("data")
    )


@query
def route_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.unrouted(_routed(spark, sf_dir)).select(
        "reason", "tableName", "type", F.col("after")["id"].cast("string").alias("id")
    )


@query
def topic_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes routed to topics on files, then read back."""
    topics = Topics(spark, shared_dir(spark, "topics"))
    write_routed(topics, routing.topic_lines(_routed(spark, sf_dir)), "route")
    back = [
        topics.read(name).select(F.lit(name).alias("topic"), "value")
        for name in ("dwd_orders", "dwd_orders_changed")
    ]
    return back[0].unionByName(back[1])


def _customer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
        "o_orderdate", "o_orderkey",
    )


def _customer_table(spark: SparkSession) -> DimensionTable:
    rule = {
        "sink_table": "dim_customer_state", "sink_columns": "id,status,priority",
        "sink_pk": None, "sink_extend": None,
    }
    return DimensionTable.from_rule(spark, shared_dir(spark, "dims"), rule)


@query
def dim_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two upserts (older, then newer orders) with a compaction between them."""
    rows = _customer_rows(spark, sf_dir)
    older = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    dim = _customer_table(spark)
    dim.apply(rows.where(older), ["o_orderdate", "o_orderkey"], "q", 0)
    dim.compact()
    dim.apply(rows.where(~older), ["o_orderdate", "o_orderkey"], "q", 1)
    return dim.read()


# Whole paths, from raw change records through the jobs over topics on files

def _drained(queries) -> None:
    for query in queries:
        query.awaitTermination()


def _files_per_turn(records: int, turns: int) -> int:
    """Files of each of ``turns`` micro-batches, so that no file holds many more than ``FILE_RECORDS``."""
    return max(1, -(-records // (turns * FILE_RECORDS)))


def _stored_per_turn(topics: Topics, topic: str, turns: int) -> int:
    """Files of a stored topic to read at a time, so that it takes ``turns`` micro-batches."""
    return max(1, -(-len(topics.read(topic).inputFiles()) // turns))


def _fed(spark: SparkSession, purpose: str, raw: DataFrame, records: int, turns: int = 3) -> tuple[Topics, str, str]:
    """Raw records, about so many, dealt over files in no order, through the feed and the routing job in so many turns."""
    root = shared_dir(spark, purpose)
    topics, checkpoint, dims, drain = Topics(spark, f"{root}/topics"), f"{root}/ck", f"{root}/dims", {"availableNow": True}
    write_topic(topics, a.business_rules(spark), "table_process", "rules")
    files = _files_per_turn(records, turns)
    dealt = raw.repartition(turns * files, F.xxhash64("value")).withColumn("topic", F.lit("change_records"))
    write_routed(topics, dealt, "database")
    _drained(change_jobs.normalize_feed(topics, "change_records", checkpoint, drain, files_per_batch=files))
    stored = _stored_per_turn(topics, change_jobs.ODS, turns)
    _drained(change_jobs.route_changes(topics, "table_process", dims, checkpoint, drain, files_per_batch=stored))
    return topics, checkpoint, dims


def _business_topics(spark: SparkSession, sf_dir: str) -> tuple[Topics, str]:
    """Raw change records, normalised, routed by rules to topics and dimension tables, and joined to wide orders."""
    raw = a.raw_business_changes(spark, sf_dir).unionByName(a.raw_dimension_changes(spark, sf_dir))
    named = a.row_count(spark, sf_dir, "orders", "lineitem", "orders", *["customer", "part", "supplier"] * 2)
    topics, checkpoint, dims = _fed(spark, "chain", raw, named, 2)
    read = dimension_reader(topics, "table_process", dims)
    _drained(order_jobs.order_wide(topics, read, checkpoint, {"availableNow": True}))
    return topics, checkpoint


@query
def chain_dim_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension table after the routing job, its changes spread over micro-batches in no order."""
    _, _, dims = _fed(spark, "dim-chain", a.raw_customer_changes(spark, sf_dir), a.row_count(spark, sf_dir, "orders"))
    rule = {
        "sink_table": "dim_customer_state", "sink_columns": a.DIMENSION_COLUMNS["customer_state"],
        "sink_pk": "id", "sink_extend": None,
    }
    return DimensionTable.from_rule(spark, dims, rule).read()


@query
def chain_order_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide orders at the end of three jobs; without the age, which follows the clock."""
    topics, _ = _business_topics(spark, sf_dir)
    wide = records.parse_typed(topics.read(order_jobs.WIDE_TOPIC), ORDER_WIDE)
    return wide.select(*[c for c in ORDER_WIDE.names if c != "user_age"])


@query
def chain_payment_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide payments at the end of four jobs; without the age, which follows the clock."""
    topics, checkpoint = _business_topics(spark, sf_dir)
    _drained(order_jobs.payment_wide(topics, checkpoint, {"availableNow": True}))
    wide = records.parse_typed(topics.read(order_jobs.PAID_TOPIC), PAYMENT_WIDE)
    return wide.select(*[c for c in PAYMENT_WIDE.names if c != "user_age"])


@query
def chain_cdc_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live rows after the feed job, its records spread over many files in no order."""
    root = shared_dir(spark, "feed")
    topics = Topics(spark, f"{root}/topics")
    raw = a.raw_line_changes(spark, sf_dir).withColumn("topic", F.lit("change_records"))
    files = 8 * _files_per_turn(a.row_count(spark, sf_dir, "lineitem"), 8)
    write_routed(topics, raw.repartition(files), "database")
    _drained(change_jobs.normalize_feed(topics, "change_records", f"{root}/ck", {"availableNow": True}))
    feed = changes.parse_envelopes(topics.read(change_jobs.ODS))
    image = F.col("image")
    return changes.current_state(feed, ["id"], CHANGE_ORDER).select(
        image["id"].cast("string").alias("id"), image["part"].cast("string").alias("part")
    )


def _put_orders(topics: Topics, rows: DataFrame, batch: int) -> None:
    """Raw change records of some orders on the raw topic."""
    raw = rows.select(F.lit("change_records").alias("topic"), F.to_json(F.struct("topic", "op", "before", "after")).alias("value"))
    write_routed(topics, raw, "database", batch)


def _order_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = a.order_records(spark, sf_dir)
    return rows.where("seq % 2 = 0"), rows.where("seq % 2 = 1")


def _fed_orders(topics: Topics) -> DataFrame:
    feed = changes.parse_envelopes(topics.read(change_jobs.ODS))
    key = F.coalesce(F.col("after")["id"], F.col("before")["id"])
    return feed.select(key.cast("bigint").alias("id"), "type")


@query
def feed_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed that begins behind what is stored, and is started again once more is."""
    root = shared_dir(spark, "latest")
    topics, (early, late) = Topics(spark, f"{root}/topics"), _order_halves(spark, sf_dir)
    for n, rows in enumerate((early, late)):
        _put_orders(topics, rows, n)
        _drained(change_jobs.normalize_feed(topics, "change_records", f"{root}/ck", {"availableNow": True}, Start("latest")))
    return _fed_orders(topics)


@query
def feed_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed that begins at a time."""
    root = shared_dir(spark, "since")
    topics, (early, late) = Topics(spark, f"{root}/topics"), _order_halves(spark, sf_dir)
    _put_orders(topics, early, 0)
    since = topics.read("change_records").agg(F.max("stored_ms")).first()[0] + 1
    _put_orders(topics, late, 1)
    _drained(change_jobs.normalize_feed(
        topics, "change_records", f"{root}/ck", {"availableNow": True}, Start("timestamp", timestamp_ms=since)
    ))
    return _fed_orders(topics)


@query
def stream_snapshot_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table's rows at a place of the log, then the changes above it: all keys, their rows and their last part.

    The raw topic holds the changes below the place, too, and in no order.
    """
    root = shared_dir(spark, "handover")
    topics = Topics(spark, f"{root}/topics")
    raw = a.raw_line_changes(spark, sf_dir).withColumn("topic", F.lit("change_records"))
    files = _files_per_turn(a.row_count(spark, sf_dir, "lineitem"), 2)
    write_routed(topics, raw.repartition(2 * files, F.xxhash64("value")), "database")
    before = a.line_changes(spark, sf_dir).where(F.date_format("l_shipdate", "yyyyMMdd") < a.HANDOVER)
    image = F.col("image")
    live = lambda feed, order: changes.current_state(feed, ["id"], order).select(
        image["id"].cast("string").alias("id"), image["part"].cast("string").alias("part")
    )
    for _ in range(2):  # the second start finds its work done
        _drained(change_jobs.snapshot_feed(
            topics, lambda: live(before, a.LINE_ORDER), "shop.last_line", a.HANDOVER, 0, "change_records", f"{root}/ck",
            {"availableNow": True}, files_per_batch=files,
        ))
    feed = changes.parse_envelopes(topics.read(change_jobs.ODS))
    key = F.coalesce(F.col("after")["id"], F.col("before")["id"]).cast("string")
    counts = feed.groupBy(key.alias("id")).agg(
        F.count_if(F.col("type") == "read").alias("n_read"), F.count_if(F.col("type") != "read").alias("n_changed")
    )
    return counts.join(live(feed, CHANGE_ORDER), "id", "left")


@query
def route_rule_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the orders under first rules, half after one rule was changed and one deleted."""
    root = shared_dir(spark, "rules")
    topics, (early, late) = Topics(spark, f"{root}/topics"), _order_halves(spark, sf_dir)
    for n, (rules, rows) in enumerate(((a.FIRST_RULES, early), (a.CHANGED_RULES, late))):
        write_topic(topics, spark.createDataFrame(rules, a.RULE_CHANGE), "table_process", "rules", n)
        _put_orders(topics, rows, n)
        _drained(change_jobs.normalize_feed(topics, "change_records", f"{root}/ck", {"availableNow": True}))
        _drained(change_jobs.route_changes(topics, "table_process", f"{root}/dims", f"{root}/ck", {"availableNow": True}))
    names = ("dwd_orders", "dwd_orders_changed", "dwd_orders_v2")
    back = [
        spark.read.schema("key string, value string").option("recursiveFileLookup", "true").parquet(topics.path(name))
        .select(F.lit(name).alias("topic"), "key", "value") for name in names
    ]
    return reduce(DataFrame.unionByName, back)


# Joins and wide tables

def _orders_by_ms(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return (
        orders.prepare_order_info(a.order_info(spark, sf_dir)),
        orders.prepare_order_detail(a.order_detail(spark, sf_dir)),
    )


@query
def order_detail_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    info, detail = _orders_by_ms(spark, sf_dir)
    joined = joins.interval_join(
        info, detail, [("id", "order_id")], "create_ts", "create_ts", -5 * a.DAY_MS, 5 * a.DAY_MS
    )
    return joined.select(
        F.col("l.id").alias("order_id"), F.col("r.id").alias("detail_id"),
        F.col("l.create_time").alias("order_time"), F.col("r.create_time").alias("detail_time"),
    )


def _event_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = a.table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", a.epoch_ms("ts").alias("ts")
    )
    return rows.where("event_type = 'purchase'"), rows.where("event_type = 'view'")


@query
def payment_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid, seen = _event_sides(spark, sf_dir)
    joined = joins.interval_join(
        paid, seen, [("user_id", "user_id")], "ts", "ts", -15 * a.HOUR_MS, 5 * a.HOUR_MS
    )
    return joined.select(
        F.col("l.user_id").alias("user_id"), F.col("l.event_id").alias("purchase_id"),
        F.col("r.event_id").alias("view_id"),
    )


@query
def interval_exclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    info, detail = _orders_by_ms(spark, sf_dir)
    joined = joins.interval_join(
        info, detail, [("id", "order_id")], "create_ts", "create_ts",
        -5 * a.DAY_MS, 5 * a.DAY_MS, lower_inclusive=False, upper_inclusive=False,
    )
    return joined.select(F.col("l.id").alias("order_id"), F.col("r.id").alias("detail_id"))


def _every_line(spark: SparkSession, sf_dir: str, by_order: bool = False) -> DataFrame:
    return orders.order_wide(
        a.order_info(spark, sf_dir), a.order_detail(spark, sf_dir),
        a.dimensions(spark, sf_dir), a.AS_OF_MS, a.AGES_MS, by_order=by_order,
    )


@query
def order_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line, whatever its date, with all dimensions."""
    return _every_line(spark, sf_dir)


@query
def order_wide_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.order_wide(
        a.order_info(spark, sf_dir), a.order_detail(spark, sf_dir),
        a.dimensions(spark, sf_dir), a.AS_OF_MS, (-5 * a.DAY_MS, 5 * a.DAY_MS),
    )


def _wide_without_large_parts(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    parts = a.remaining_parts(a.table(spark, sf_dir, "part"))
    return orders.order_wide(
        a.order_info(spark, sf_dir), a.order_detail(spark, sf_dir),
        a.dimensions(spark, sf_dir, parts), a.AS_OF_MS, a.AGES_MS, how,
    )


@query
def order_wide_missing_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wide_without_large_parts(spark, sf_dir, "left")


@query
def order_wide_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wide_without_large_parts(spark, sf_dir, "inner")


@query
def payment_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = _every_line(spark, sf_dir, by_order=True)
    return orders.payment_wide(a.payment_info(spark, sf_dir), wide, by_order=True)


@query
def coalesce_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order headers filled up from their payment."""
    columns = ["order_status", "create_time", "feight_fee", "total_amount", "activity_reduce_amount"]
    info = a.order_info(spark, sf_dir)
    other = a.payment_info(spark, sf_dir).select(
        "order_id", F.col("payment_type").alias("order_status"), "create_time",
        F.col("total_amount").alias("feight_fee"), "total_amount",
        F.col("total_amount").alias("activity_reduce_amount"),
    )
    joined = info.alias("l").join(other.alias("r"), F.col("l.id") == F.col("r.order_id"))
    merged = records.first_non_null("l", "r", columns, keep_left=["activity_reduce_amount"])
    return joined.select("l.id", *merged)


@query
def user_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = a.dimensions(spark, sf_dir)[orders.USER]
    age = times.age_years(F.col("BIRTHDAY"), F.lit(a.AS_OF_MS).cast("bigint"))
    return user.select(F.col("ID").alias("id"), age.alias("age"))


@query
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.date_format("ts", times.TIME_FORMAT)
    events = a.table(spark, sf_dir, "events").select(
        "event_id", text.alias("text"), a.epoch_ms("ts").alias("ms")
    )
    return events.select(
        "event_id",
        times.create_date(F.col("text")).alias("create_date"),
        times.create_hour(F.col("text")).alias("create_hour"),
        times.to_epoch_ms(F.col("text")).alias("epoch_ms"),
        times.to_epoch_ms_or(times.create_date(F.col("text")), F.col("ms")).alias("fallback_ms"),
        times.date_text(F.col("ms")).alias("date_text"),
        times.time_text(F.timestamp_millis("ms")).alias("time_text"),
        times.to_epoch_ms_at(F.col("text")).alias("fixed_zone_ms"),
    )


@query
def dim_table_camel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/customer.parquet", camel_case=True).select(
        "cCustkey", "cName", "cNationkey", "cMktsegment"
    )


@query
def dim_point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The look-up by key itself; the whole table is behind it."""
    return lookups.by_id(a.dimensions(spark, sf_dir)[orders.SKU], 7)


# Streams: the given tables as file streams, drained and read back

@query
def stream_repair_is_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    repaired = state.repair_is_new_stream(a.pages_stream(spark, sf_dir))
    return run_to_table(_brief(repaired, "common.is_new"), "repair")


@query
def stream_unique_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = state.unique_visits_stream(a.pages_stream(spark, sf_dir))
    return run_to_table(_brief(found), "visits")


@query
def stream_unique_visits_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visitor and day only: which of a day's entry pages comes first is open."""
    found = state.unique_visits_dedup_stream(a.pages_stream(spark, sf_dir))
    days = found.select(F.col("common.mid").alias("mid"), times.date_text(F.col("ts")).alias("day"))
    return run_to_table(days, "visits-dedup")


@query
def stream_jumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = state.jumps_stream(a.pages_stream(spark, sf_dir), WITHIN_MS, "2 hours")
    return run_to_table(_brief(found, "outcome"), "jumps")


@query
def stream_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = a.stream(spark, sf_dir, "events", a.EVENTS_DDL)
    events = rows.select("event_id", "user_id", "event_type", a.epoch_ms("ts").alias("ts"))
    again = a.stream(spark, sf_dir, "events", a.EVENTS_DDL).select(
        "event_id", "user_id", "event_type", a.epoch_ms("ts").alias("ts")
    )
    joined = stream_joins.interval_join_stream(
        events.where("event_type = 'purchase'"), again.where("event_type = 'view'"),
        [("user_id", "user_id")], "ts", "ts", -15 * a.HOUR_MS, 5 * a.HOUR_MS,
    )
    pairs = joined.select(
        F.col("l.user_id").alias("user_id"), F.col("l.event_id").alias("purchase_id"),
        F.col("r.event_id").alias("view_id"),
    )
    return run_to_table(pairs, "interval")


@query
def stream_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three stages over topics on files, as in production: visits, bounces, then windows."""
    root = shared_dir(spark, "stats")
    topics = Topics(spark, f"{root}/topics")
    pages = a.pages_stream(spark, sf_dir)
    like = pages.schema
    stages = {
        "dwm_unique_visit": state.unique_visits_stream(pages),
        "dwm_user_jump_detail": state.jumps_stream(pages, WITHIN_MS, "2 hours").drop("outcome"),
        "dwd_page_log": pages,
    }
    for topic, rows in stages.items():
        write = lambda batch, n, topic=topic: write_topic(topics, batch, topic, topic, n)
        start_batches(
            rows, write, f"{root}/ck-{topic}", {"availableNow": True}
        ).awaitTermination()
    read = [records.parse_typed(topics.read_stream(topic), like) for topic in stages]
    closed = visitor_stats_stream(*read, window="1 day", delay="9 hours")
    return run_to_table(closed, "windows")


@query
def stream_dim_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = a.stream(spark, sf_dir, "orders", a.ORDERS_DDL).select(
        F.col("o_custkey").cast("string").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
        "o_orderdate", "o_orderkey",
    )
    dim = _customer_table(spark)
    start_batches(
        rows,
        lambda batch, n: dim.apply(batch, ["o_orderdate", "o_orderkey"], "stream", n),
        shared_dir(spark, "dims-checkpoint"),
        {"availableNow": True},
    ).awaitTermination()
    return dim.read()


@query
def stream_consecutive_3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = state.consecutive_match_stream(a.pages_stream(spark, sf_dir), 3, 24 * a.HOUR_MS, "2 hours")
    return run_to_table(_brief(found, "outcome"), "runs")


@query
def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records behind the watermark or without a time, of four files read one after the other."""
    root = shared_dir(spark, "late")
    topics = Topics(spark, f"{root}/topics")
    lines = a.late_log_lines(spark, sf_dir).withColumn("topic", F.lit("dwd_page_log"))
    files = _files_per_turn(a.row_count(spark, sf_dir, "events"), a.LATE_FILES)
    for n in range(a.LATE_FILES):
        turn = lines.where(F.col("file") == n)
        write_routed(topics, turn.coalesce(1) if files == 1 else turn.repartition(files), "pages", n)
    rows = topics.read_stream("dwd_page_log", files_per_batch=files).select(
        F.get_json_object("value", "$.seq").cast("bigint").alias("seq"),
        F.get_json_object("value", "$.ts").try_cast("bigint").alias("ts"), "value",
    )
    to = lambda topic: lambda batch, n: write_topic(topics, batch, topic, topic, n)
    _drained([start_splitting(rows, to("on_time"), to("audit"), f"{root}/ck", 2 * a.HOUR_MS, trigger={"availableNow": True})])
    read = lambda topic: records.parse_typed(topics.read(topic), StructType.fromDDL("seq bigint, reason string"))
    return read("audit").unionByName(read("on_time")).select("seq", F.coalesce("reason", F.lit("on time")).alias("reason"))


# Sources and sinks on files

@query
def log_file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolled log files, one text per line, as a stream."""
    root = shared_dir(spark, "logs")
    a.log_lines(spark, sf_dir).select("value").write.text(f"{root}/app")
    parsed = logs.good(logs.parse(log_files(spark, f"{root}/app", streaming=True)))
    return run_to_table(parsed.select("common.mid", "page.page_id", "ts"), "log-files")


@query
def delimited_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited texts as a stream."""
    root = shared_dir(spark, "delimited")
    events = a.table(spark, sf_dir, "events").select("event_id", "event_type", a.epoch_ms("ts").alias("ts"))
    events.write.option("sep", ";").csv(f"{root}/in")
    rows = delimited(spark, f"{root}/in", "event_id bigint, event_type string, ts bigint", ";", streaming=True)
    return run_to_table(rows, "delimited")


@query
def raw_change_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw change records through a topic, unread and unchanged."""
    topics = Topics(spark, shared_dir(spark, "raw"))
    raw = a.raw_customer_changes(spark, sf_dir).withColumn("topic", F.lit("change_records"))
    write_routed(topics, raw, "database")
    return run_to_table(topics.read_stream("change_records").select("value"), "raw-texts")


@query
def stored_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics windows stored by day, one micro-batch written twice, and read back."""
    path = shared_dir(spark, "stored")
    rows = stats.visitor_stats_of_logs(a.pages(spark, sf_dir), WITHIN_MS, "1 day")
    for _ in range(2):
        to_parquet(path)(rows, 0)
    return spark.read.schema(VISITOR_STATS).parquet(path).select(*VISITOR_STATS.names)
