from decimal import Decimal

from pyspark.sql import functions as F

from millrace.functions import records, times
from millrace.operators import orders
from millrace.schemas import ORDER_DETAIL, ORDER_INFO, ORDER_WIDE, PAYMENT_INFO, PAYMENT_WIDE

AS_OF_MS = 1_577_836_800_000  # 2020-01-01T00:00:00Z


def named(spark, schema, *rows):
    return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in rows], schema)


def order_rows(spark):
    info = named(spark, ORDER_INFO, {
        "id": 1, "province_id": 3, "user_id": 9, "order_status": "new",
        "total_amount": Decimal("9.00"), "create_time": "2020-01-01 08:30:00",
        "expire_time": "2020-01-02 08:30:00", "operate_time": "2020-01-01 09:00:00",
    })
    detail = named(
        spark, ORDER_DETAIL,
        {"id": 11, "order_id": 1, "sku_id": 5, "sku_name": "detail's", "create_time": "2020-01-01 08:30:05"},
        {"id": 12, "order_id": 1, "sku_id": 6, "sku_name": "detail's", "create_time": "2020-01-01 08:30:05"},
        {"id": 13, "order_id": 1, "sku_id": 5, "sku_name": "too late", "create_time": "2020-01-01 08:30:06"},
    )
    return info, detail


def dims(spark):
    texts = lambda names, *rows: spark.createDataFrame(
        list(rows), ", ".join(f"{n} string" for n in names.split())
    )
    return {
        orders.USER: texts("ID GENDER BIRTHDAY", ("9", "F", "2000-01-01")),
        orders.PROVINCE: texts("ID NAME AREA_CODE ISO_CODE ISO_3166_2", ("3", "P", "A", "I", "J")),
        orders.SKU: texts("ID SKU_NAME SPU_ID TM_ID CATEGORY3_ID", ("5", "dim's", "50", "51", "52")),
        orders.SPU: texts("ID SPU_NAME", ("50", "S")),
        orders.TRADEMARK: texts("ID TM_NAME", ("51", "T")),
        orders.CATEGORY3: texts("ID NAME", ("52", "C")),
    }


def test_order_wide_maps_all_sides(spark):
    wide = orders.order_wide(*order_rows(spark), dims(spark), AS_OF_MS)
    assert wide.columns == ORDER_WIDE.names
    kinds = {f.name: f.dataType for f in ORDER_WIDE.fields}
    assert {f.name: f.dataType for f in wide.schema.fields} == kinds
    found, missing = wide.orderBy("detail_id").collect()
    assert (found.order_id, found.sku_name, found.spu_id, found.spu_name) == (1, "dim's", 50, "S")
    assert (found.tm_name, found.category3_name) == ("T", "C")
    assert (found.user_age, found.user_gender) == (20, "F")
    assert (found.province_name, found.province_3166_2_code) == ("P", "J")
    assert (found.create_date, found.create_hour) == ("2020-01-01", "08")
    assert (found.expire_time, found.operate_time) == ("2020-01-02 08:30:00", "2020-01-01 09:00:00")
    assert found.split_feight_fee is None
    assert (missing.detail_id, missing.sku_name) == (12, "detail's")
    assert (missing.spu_id, missing.tm_name, missing.category3_name) == (None, None, None)


def test_inner_look_up_drops_orders_without_dimension(spark):
    wide = orders.order_wide(*order_rows(spark), dims(spark), AS_OF_MS, how="inner")
    assert [r.detail_id for r in wide.collect()] == [11]


def test_payment_fields_win(spark):
    wide = orders.order_wide(*order_rows(spark), dims(spark), AS_OF_MS)
    payments = named(
        spark, PAYMENT_INFO,
        {"id": 70, "order_id": 1, "user_id": None, "total_amount": Decimal("5.00"),
         "create_time": "2020-01-01 08:45:00"},
        {"id": 71, "order_id": 1, "user_id": 9, "create_time": "2020-01-01 08:45:01"},
    )
    paid = orders.payment_wide(payments, wide)
    assert paid.columns == PAYMENT_WIDE.names
    rows = paid.orderBy("detail_id").collect()
    assert [(r.payment_id, r.detail_id) for r in rows] == [(70, 11), (70, 12)]
    assert rows[0].total_amount == Decimal("5.00")
    assert rows[0].user_id is None
    assert (rows[0].order_create_time, rows[0].payment_create_time) == (
        "2020-01-01 08:30:00", "2020-01-01 08:45:00"
    )


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_age_is_in_whole_365_day_years(spark):
    age = lambda day: one(spark, times.age_years(F.lit(day), F.lit(AS_OF_MS)))
    assert age("2000-01-01") == 20
    assert age("2019-01-01") == 1
    assert age("2019-01-02") == 0
    assert age("not a day") is None


def test_fixed_offset_ignores_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert one(spark, times.to_epoch_ms_at(F.lit("2024-01-01 08:00:00"))) == 1_704_067_200_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_unparsable_time_falls_back_to_the_record(spark):
    parse = lambda text: one(spark, times.to_epoch_ms_or(F.lit(text), F.lit(5)))
    assert parse("1970-01-01 00:00:01") == 1000
    assert parse("yesterday") == 5


def test_hour_of_a_text_without_time_is_null(spark):
    assert one(spark, times.create_hour(F.lit("2020-01-01"))) is None


def test_first_non_null_merge(spark):
    left = spark.createDataFrame([(1, None, "l"), (2, "l", None)], "id int, a string, b string")
    right = spark.createDataFrame([(1, "r", "r"), (2, "r", "r")], "id int, a string, b string")
    merged = left.alias("l").join(right.alias("r"), "id").select(
        "id", *records.first_non_null("l", "r", ["a", "b"], keep_left=["b"])
    )
    assert sorted(map(tuple, merged.collect())) == [(1, "r", "l"), (2, "l", None)]


def test_camel_case_columns(spark):
    df = spark.createDataFrame([(1, 2)], "TM_NAME int, id int")
    assert records.to_camel(df).columns == ["tmName", "id"]


def test_json_leaves_out_nulls_and_parses_back(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id bigint, name string")
    lines = records.to_lines(df)
    assert sorted(r.value for r in lines.collect()) == ['{"id":1}', '{"id":2,"name":"x"}']
    assert sorted(map(tuple, records.parse_typed(lines, df.schema).collect())) == [(1, None), (2, "x")]
