"""Record layouts of the warehouse (fixed names and types)."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructType,
    VariantType,
)

MONEY = "decimal(16,2)"

# Row images and display items: open fields that keep their JSON types.
_FIELDS = MapType(StringType(), VariantType())

_KINDS: dict[str, DataType] = {
    "bigint": LongType(),
    "int": IntegerType(),
    "string": StringType(),
    MONEY: DecimalType(16, 2),
    "map<string,variant>": _FIELDS,
}


def _struct(layout: str) -> StructType:
    """``"name type, name type"`` to a struct, without needing a session."""
    struct = StructType()
    for field in layout.split(", "):
        name, kind = field.split(" ")
        struct = struct.add(name, _KINDS[kind])
    return struct

# Application log. `start` is an object or a text, kept as text; display items are open.
ODS_LOG = (
    StructType()
    .add("common", _struct("mid string, is_new string, vc string, ch string, ar string"))
    .add("page", _struct("page_id string, last_page_id string, during_time bigint"))
    .add("start", StringType())
    .add("displays", ArrayType(_FIELDS))
    .add("ts", LongType())
)

CDC_RECORD = (
    _struct("topic string, op string, before map<string,variant>, after map<string,variant>")
    .add("ts_ms", LongType())
    .add("source", _struct("file string, pos bigint, row bigint, ts_ms bigint"))
)

# Place of a change: in the database's log and its time, where the feed names them, then
# where the raw record was stored.
CHANGE_PLACE = _struct(
    "file string, pos bigint, row bigint, ts_ms bigint, src bigint, part bigint, off bigint"
)

CDC_ENVELOPE = _struct(
    "database string, tableName string, before map<string,variant>, "
    "after map<string,variant>, type string"
).add("at", CHANGE_PLACE)

TABLE_PROCESS = _struct(
    "source_table string, operate_type string, sink_type string, sink_table string, "
    "sink_columns string, sink_pk string, sink_extend string"
)

ORDER_INFO = _struct(
    "id bigint, province_id bigint, order_status string, user_id bigint, "
    f"total_amount {MONEY}, activity_reduce_amount {MONEY}, coupon_reduce_amount {MONEY}, "
    f"original_total_amount {MONEY}, feight_fee {MONEY}, "
    "expire_time string, create_time string, operate_time string"
)

ORDER_DETAIL = _struct(
    f"id bigint, order_id bigint, sku_id bigint, order_price {MONEY}, sku_num bigint, "
    f"sku_name string, create_time string, split_total_amount {MONEY}, "
    f"split_activity_amount {MONEY}, split_coupon_amount {MONEY}"
)

PAYMENT_INFO = _struct(
    f"id bigint, order_id bigint, user_id bigint, total_amount {MONEY}, subject string, "
    "payment_type string, create_time string, callback_time string"
)

ORDER_WIDE = _struct(
    f"detail_id bigint, order_id bigint, sku_id bigint, order_price {MONEY}, sku_num bigint, "
    "sku_name string, province_id bigint, order_status string, user_id bigint, "
    f"total_amount {MONEY}, activity_reduce_amount {MONEY}, coupon_reduce_amount {MONEY}, "
    f"original_total_amount {MONEY}, feight_fee {MONEY}, split_feight_fee {MONEY}, "
    f"split_activity_amount {MONEY}, split_coupon_amount {MONEY}, split_total_amount {MONEY}, "
    "expire_time string, create_time string, operate_time string, create_date string, "
    "create_hour string, province_name string, province_area_code string, "
    "province_iso_code string, province_3166_2_code string, user_age int, user_gender string, "
    "spu_id bigint, tm_id bigint, category3_id bigint, spu_name string, tm_name string, "
    "category3_name string"
)

PAYMENT_WIDE = _struct(
    "payment_id bigint, subject string, payment_type string, payment_create_time string, "
    "callback_time string, detail_id bigint, order_id bigint, sku_id bigint, "
    f"order_price {MONEY}, sku_num bigint, sku_name string, province_id bigint, "
    f"order_status string, user_id bigint, total_amount {MONEY}, "
    f"activity_reduce_amount {MONEY}, coupon_reduce_amount {MONEY}, "
    f"original_total_amount {MONEY}, feight_fee {MONEY}, split_feight_fee {MONEY}, "
    f"split_activity_amount {MONEY}, split_coupon_amount {MONEY}, split_total_amount {MONEY}, "
    "order_create_time string, province_name string, province_area_code string, "
    "province_iso_code string, province_3166_2_code string, user_age int, user_gender string, "
    "spu_id bigint, tm_id bigint, category3_id bigint, spu_name string, tm_name string, "
    "category3_name string"
)

VISITOR_STATS = _struct(
    "stt string, edt string, vc string, ch string, ar string, is_new string, "
    "uv_ct bigint, pv_ct bigint, sv_ct bigint, uj_ct bigint, dur_sum bigint, ts bigint"
)
