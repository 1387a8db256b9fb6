"""The given tables in the roles of the warehouse's own inputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.times import DATE_FORMAT, TIME_FORMAT
from millrace.operators import changes, orders
from millrace.operators.lookups import lookup_join
from millrace.schemas import MONEY, ORDER_DETAIL, ORDER_INFO, PAYMENT_INFO

EVENTS_DDL = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)
ORDERS_DDL = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)
LINEITEM_DDL = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)

HOUR_MS = 60 * 60 * 1000
DAY_MS = 24 * HOUR_MS
AS_OF_MS = 1_704_067_200_000  # 2024-01-01T00:00:00Z
AGES_MS = (-60 * 365 * DAY_MS, 60 * 365 * DAY_MS)  # wide enough for any order and line


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_count(spark: SparkSession, sf_dir: str, *names: str) -> int:
    """Rows of some tables together, as their files state it."""
    return sum(table(spark, sf_dir, name).count() for name in names)


def stream(spark: SparkSession, sf_dir: str, name: str, ddl: str) -> DataFrame:
    """The same table as a file stream."""
    reader = spark.readStream.schema(ddl).option("pathGlobFilter", f"{name}.parquet")
    return reader.parquet(sf_dir)


def epoch_ms(ts: str) -> Column:
    return F.unix_millis(F.col(ts).cast("timestamp"))


def to_pages(events: DataFrame) -> DataFrame:
    """Log records from events: sign-ups and views are entry pages of a new visitor."""
    k = F.from_json("props", "k bigint")["k"]
    entry = F.col("event_type").isin("signup", "view")
    display = F.transform(
        F.sequence(F.lit(1), F.lit(3)),
        lambda n: F.create_map(
            F.lit("item"), F.concat(F.lit("i"), n.cast("string")).cast("variant"),
            F.lit("order"), n.cast("variant"),
            F.lit("ad"), (n == 2).cast("variant"),
        ),
    )
    return events.select(
        F.struct(
            F.col("user_id").cast("string").alias("mid"),
            F.when(entry, "1").otherwise("0").alias("is_new"),
            F.concat(F.lit("v"), (k % 3).cast("string")).alias("vc"),
            F.concat(F.lit("c"), (k % 5).cast("string")).alias("ch"),
            F.concat(F.lit("a"), (F.col("user_id") % 4).cast("string")).alias("ar"),
        ).alias("common"),
        F.struct(
            F.col("event_type").alias("page_id"),
            F.when(~entry, "prev").alias("last_page_id"),
            F.round(F.col("value") * 100).cast("bigint").alias("during_time"),
        ).alias("page"),
        F.when(F.col("event_type") == "signup", F.col("props")).alias("start"),
        F.slice(display, F.lit(1), (k % 4).cast("int")).alias("displays"),
        epoch_ms("ts").alias("ts"),
        F.col("event_id").alias("seq"),
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_pages(table(spark, sf_dir, "events"))


def pages_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_pages(stream(spark, sf_dir, "events", EVENTS_DDL))


def log_lines(spark: SparkSession, sf_dir: str, errors_raw: bool = False) -> DataFrame:
    """Log records as texts; with ``errors_raw`` error events are bare property texts."""
    records = pages(spark, sf_dir)
    text = F.to_json(F.struct(*[c for c in records.columns if c != "seq"]))
    if not errors_raw:
        return records.select("seq", text.alias("value"))
    events = table(spark, sf_dir, "events")
    return to_pages(events.where("event_type <> 'error'")).select(
        "seq", text.alias("value")
    ).unionByName(
        events.where("event_type = 'error'").select(
            F.col("event_id").alias("seq"), F.col("props").alias("value")
        )
    )


#: Files of the late-row case, and the events whose record comes a file later or has no time.
LATE_FILES, LATE_EVERY, UNTIMED_EVERY = 4, 10, 50


def late_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log texts with their ``file``: events in turn, some held back for one file, some without a time."""
    rows = pages(spark, sf_dir)
    n = table(spark, sf_dir, "events").agg(F.max("event_id") + 1).first()[0]
    held_back = F.when(F.col("seq") % LATE_EVERY == 3, 1).otherwise(0)
    file = F.least(F.floor(F.col("seq") * LATE_FILES / F.lit(n)) + held_back, F.lit(LATE_FILES - 1))
    timed = F.when(F.col("seq") % UNTIMED_EVERY != 7, F.col("ts"))
    return rows.withColumn("ts", timed).select(
        file.cast("int").alias("file"), F.to_json(F.struct("common", "page", "ts", "seq")).alias("value")
    )


def money(column: str) -> Column:
    return F.col(column).cast(MONEY)


def _time_text(ts: Column) -> Column:
    return F.date_format(ts, TIME_FORMAT)


def to_order_info(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_custkey") % 25).alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        money("o_totalprice").alias("total_amount"),
        F.lit(None).cast(MONEY).alias("activity_reduce_amount"),
        F.lit(0).cast(MONEY).alias("coupon_reduce_amount"),
        money("o_totalprice").alias("original_total_amount"),
        F.lit(None).cast(MONEY).alias("feight_fee"),
        _time_text(F.col("o_orderdate") + F.expr("interval 1 day")).alias("expire_time"),
        _time_text(F.col("o_orderdate")).alias("create_time"),
        F.lit(None).cast("string").alias("operate_time"),
    )


def to_order_detail(rows: DataFrame) -> DataFrame:
    return rows.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        money("l_extendedprice").alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("sku_name"),
        _time_text(F.col("l_shipdate")).alias("create_time"),
        money("l_extendedprice").alias("split_total_amount"),
        money("l_discount").alias("split_activity_amount"),
        money("l_tax").alias("split_coupon_amount"),
    )


def order_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_order_info(table(spark, sf_dir, "orders"))


def order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_order_detail(table(spark, sf_dir, "lineitem"))


def payment_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per order, up to half an hour after it."""
    paid = F.col("o_orderdate") + F.make_dt_interval(mins=(F.col("o_orderkey") % 30).cast("int"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        (money("o_totalprice") + F.lit(1)).cast(MONEY).alias("total_amount"),
        F.col("o_orderpriority").alias("subject"),
        F.col("o_orderstatus").alias("payment_type"),
        _time_text(paid).alias("create_time"),
        F.lit(None).cast("string").alias("callback_time"),
    )


def sku_dim(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").cast("string").alias("ID"),
        F.col("p_name").alias("SKU_NAME"),
        F.substring_index("p_brand", "#", -1).alias("SPU_ID"),
        F.col("p_size").cast("string").alias("TM_ID"),
        F.length("p_type").cast("string").alias("CATEGORY3_ID"),
    )


def remaining_parts(part: DataFrame) -> DataFrame:
    """Parts after a change feed that withdraws every one larger than size 40."""
    image = F.from_json(F.to_json(F.struct(*part.columns)), changes.FIELDS)
    feed = part.select(
        F.lit("feed.shop.part").alias("topic"),
        F.explode(
            F.when(F.col("p_size") > 40, F.array(F.lit("read"), F.lit("delete")))
            .otherwise(F.array(F.lit("read")))
        ).alias("op"),
        image.alias("image"),
    ).select(
        "topic", "op",
        F.when(F.col("op") == "delete", F.col("image")).alias("before"),
        F.when(F.col("op") == "read", F.col("image")).alias("after"),
        F.when(F.col("op") == "delete", 1).otherwise(0).alias("pos"),
    )
    live = changes.current_state(changes.normalize(feed), ["p_partkey"], ["pos"])
    return live.select(
        *[F.col("image")[f.name].cast(f.dataType).alias(f.name) for f in part.schema.fields]
    )


def dimensions(
    spark: SparkSession, sf_dir: str, part: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The six dimension tables, all text."""
    part = table(spark, sf_dir, "part") if part is None else part
    born = F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") % 18_000).cast("int"))
    user = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("ID"),
        F.when(F.col("c_nationkey") < 12, "F").otherwise("M").alias("GENDER"),
        F.date_format(born, DATE_FORMAT).alias("BIRTHDAY"),
    )
    region = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("string").alias("ID"), "r_name"
    )
    nation = lookup_join(
        table(spark, sf_dir, "nation"), region, "n_regionkey", {"region": "r_name"}
    )
    province = nation.select(
        F.col("n_nationkey").cast("string").alias("ID"),
        F.col("n_name").alias("NAME"),
        F.col("region").alias("AREA_CODE"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("ISO_CODE"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("ISO_3166_2"),
    )
    all_parts = table(spark, sf_dir, "part")
    return {
        orders.USER: user,
        orders.PROVINCE: province,
        orders.SKU: sku_dim(part),
        orders.SPU: all_parts.select(
            F.substring_index("p_brand", "#", -1).alias("ID"), F.col("p_brand").alias("SPU_NAME")
        ).distinct(),
        orders.TRADEMARK: table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").cast("string").alias("ID"), F.col("s_name").alias("TM_NAME")
        ),
        orders.CATEGORY3: all_parts.groupBy(F.length("p_type").cast("string").alias("ID")).agg(
            F.min("p_type").alias("NAME")
        ),
    }


def _fields(*pairs: tuple[str, Column]) -> Column:
    flat = [item for name, value in pairs for item in (F.lit(name), value.cast("variant"))]
    return F.create_map(*flat)


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw change records of orders: created, updated or deleted by key."""
    kind = F.col("o_orderkey") % 3
    old = _fields(
        ("id", F.col("o_orderkey")), ("user_id", F.col("o_custkey")), ("status", F.lit("new"))
    )
    new = _fields(
        ("id", F.col("o_orderkey")), ("user_id", F.col("o_custkey")),
        ("status", F.col("o_orderstatus")), ("total", money("o_totalprice")),
    )
    return table(spark, sf_dir, "orders").select(
        F.lit("feed.shop.orders").alias("topic"),
        F.when(kind == 0, "CREATE").when(kind == 1, "UPDATE").otherwise("DELETE").alias("op"),
        F.when(kind != 0, old).alias("before"),
        F.when(kind != 2, new).alias("after"),
        F.col("o_orderkey").alias("seq"),
    )


def line_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised changes of a table keyed by order, one change per line."""
    flag = F.col("l_returnflag")
    image = _fields(("id", F.col("l_orderkey")), ("part", F.col("l_partkey")))
    rows = table(spark, sf_dir, "lineitem").select(
        F.lit("feed.shop.last_line").alias("topic"),
        F.when(flag == "A", "create").when(flag == "N", "update").otherwise("delete").alias("op"),
        F.when(flag != "A", image).alias("before"),
        F.when(flag != "R", image).alias("after"),
        "l_shipdate", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
    )
    return changes.normalize(rows)


LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]


def shop_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of four tables in one feed."""
    def inserted(name: str, op: str, *pairs: tuple[str, Column]) -> DataFrame:
        return table(spark, sf_dir, name).select(
            F.lit(f"feed.shop.{name}").alias("topic"),
            F.lit(op).alias("op"),
            F.lit(None).cast(changes.FIELDS).alias("before"),
            _fields(*pairs).alias("after"),
        )
    records = (
        order_records(spark, sf_dir).drop("seq")
        .unionByName(inserted("customer", "READ", ("id", F.col("c_custkey")), ("name", F.col("c_name"))))
        .unionByName(inserted("supplier", "CREATE", ("id", F.col("s_suppkey")), ("name", F.col("s_name"))))
        .unionByName(inserted(
            "part", "UPDATE", ("id", F.col("p_partkey")), ("name", F.col("p_name")),
            ("brand", F.col("p_brand")),
        ))
    )
    return changes.normalize(records)


def _raw_inserts(name: str, rows: DataFrame) -> DataFrame:
    return rows.select(F.to_json(F.struct(
        F.lit(f"feed.shop.{name}").alias("topic"), F.lit("c").alias("op"), F.struct(*rows.columns).alias("after")
    )).alias("value"))


def raw_business_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records as texts, numbers unquoted: orders, payments, and lines 0, 4 or 8 s after their order."""
    placed = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    after = F.make_dt_interval(secs=F.col("l_linenumber") % 3 * 4)
    lines = table(spark, sf_dir, "lineitem").drop("l_shipdate").join(placed, "l_orderkey").withColumn(
        "l_shipdate", F.col("o_orderdate") + after
    )
    return (
        _raw_inserts("order_info", order_info(spark, sf_dir))
        .unionByName(_raw_inserts("order_detail", to_order_detail(lines)))
        .unionByName(_raw_inserts("payment_info", payment_info(spark, sf_dir)))
    )


def raw_dimension_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records as texts: every dimension row created with stale texts, then put right."""
    def records(name: str, rows: DataFrame, op: str, ts_ms: int) -> DataFrame:
        return rows.select(F.to_json(F.struct(
            F.lit(f"feed.shop.{name}").alias("topic"), F.lit(op).alias("op"),
            F.struct(*rows.columns).alias("after"), F.lit(ts_ms).alias("ts_ms"),
        )).alias("value"))

    found = []
    for table_name, rows in dimensions(spark, sf_dir).items():
        name, rows = table_name.removeprefix("DIM_").lower(), rows.toDF(*[c.lower() for c in rows.columns])
        stale = rows.select("id", *[F.concat(F.lit("stale "), c).alias(c) for c in rows.columns[1:]])
        found += [records(name, rows, "u", 2), records(name, stale, "c", 1)]
    return reduce(DataFrame.unionByName, found)


def raw_customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records as texts that name their place: a customer's state is that of the last order."""
    priority = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select(F.to_json(F.struct(
        F.lit("feed.shop.customer_state").alias("topic"), F.lit("u").alias("op"),
        F.struct(
            F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("status"), priority.alias("priority")
        ).alias("after"),
        F.struct(
            F.date_format("o_orderdate", "yyyyMMdd").alias("file"), F.col("o_orderkey").alias("pos")
        ).alias("source"),
    )).alias("value"))


def raw_line_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of ``line_changes`` as texts that name their place in the log, in no order."""
    flag = F.col("l_returnflag")
    image = F.struct(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("part"))
    return table(spark, sf_dir, "lineitem").select(F.to_json(F.struct(
        F.lit("feed.shop.last_line").alias("topic"),
        F.when(flag == "A", "c").when(flag == "N", "u").otherwise("d").alias("op"),
        F.when(flag != "A", image).alias("before"),
        F.when(flag != "R", image).alias("after"),
        F.struct(
            F.date_format("l_shipdate", "yyyyMMdd").alias("file"),
            (F.col("l_partkey") * 1_000_000 + F.col("l_suppkey")).alias("pos"),
            F.col("l_linenumber").alias("row"),
            (F.col("l_extendedprice") * 100).cast("bigint").alias("ts_ms"),
        ).alias("source"),
    )).alias("value"))


def business_rules(spark: SparkSession) -> DataFrame:
    """Envelopes of rules that route orders, lines and payments to topics, dimensions to tables."""
    layouts = {"order_info": ORDER_INFO, "order_detail": ORDER_DETAIL, "payment_info": PAYMENT_INFO}
    images = [{
        "source_table": name, "operate_type": "insert", "sink_type": "kafka",
        "sink_table": f"dwd_{name}", "sink_columns": ",".join(layout.names),
    } for name, layout in layouts.items()]
    images += [{
        "source_table": name, "operate_type": kind, "sink_type": "hbase",
        "sink_table": f"dim_{name}", "sink_columns": columns, "sink_pk": "id",
    } for name, columns in DIMENSION_COLUMNS.items() for kind in ("insert", "update")]
    return spark.createDataFrame(
        [("config", "table_process", image, "insert") for image in images],
        "database string, tableName string, after map<string,string>, type string",
    )


DIMENSION_COLUMNS = {
    "user_info": "id,gender,birthday",
    "base_province": "id,name,area_code,iso_code,iso_3166_2",
    "sku_info": "id,sku_name,spu_id,tm_id,category3_id",
    "spu_info": "id,spu_name",
    "base_trademark": "id,tm_name",
    "base_category3": "id,name",
    "customer_state": "id,status,priority",
}

#: Place of the log (its file) at which a snapshot of lines is taken.
HANDOVER = "19960101"

RULE_CHANGE = (
    "database string, tableName string, before map<string,string>, after map<string,string>, type string"
)


def _rule(kind: str, topic: str, columns: str) -> dict[str, str]:
    return {"source_table": "orders", "operate_type": kind, "sink_type": "kafka", "sink_table": topic, "sink_columns": columns}


_INSERTS, _UPDATES = _rule("insert", "dwd_orders", "id,user_id"), _rule("update", "dwd_orders_changed", "id,status")
FIRST_RULES = [("config", "table_process", None, image, "insert") for image in (_INSERTS, _UPDATES)]
CHANGED_RULES = [
    ("config", "table_process", _INSERTS, _rule("insert", "dwd_orders_v2", "id,total"), "update"),
    ("config", "table_process", _UPDATES, None, "delete"),
]

# (source_table, operate_type, sink_type, sink_table, sink_columns, sink_pk, sink_extend)
RULES = [
    ("orders", "insert", "kafka", "dwd_orders", "id,user_id,total", None, None),
    ("orders", "update", "kafka", "dwd_orders_changed", "id,status", None, None),
    ("orders", "delete", "kafka", "never_used", "id", None, None),
    ("part", "update", "hbase", "dim_part", "id,name", "id", None),
    ("supplier", "insert", "clickhouse", "ck_supplier", "id", None, None),
    ("customer", "insert", "hbase", "dim_customer", "id,name", None, None),
]
