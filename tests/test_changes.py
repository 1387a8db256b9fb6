import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import changes, routing
from helpers import plain
from millrace.schemas import TABLE_PROCESS

RECORD = "topic string, op string, before map<string,string>, after map<string,string>, pos bigint"


def feed(spark, *rows):
    """Envelopes from (table, op, before, after), positioned in the given order."""
    records = [(f"srv.shop.{t}", op, b, a, i) for i, (t, op, b, a) in enumerate(rows)]
    return changes.normalize(spark.createDataFrame(records, RECORD))


def test_normalised_record(spark):
    row = feed(spark, ("t", "CREATE", None, {"id": "1", "gone": None})).first()
    assert (row.database, row.tableName, row.type) == ("shop", "t", "insert")
    assert (row.before, plain(row.after)) == ({}, {"id": "1"})


@pytest.mark.parametrize("op, kind", [
    ("CREATE", "insert"), ("c", "insert"), ("READ", "read"), ("u", "update"), ("Delete", "delete"),
    ("truncate", "truncate"),
])
def test_operation_names(spark, op, kind):
    assert feed(spark, ("t", op, None, {})).first().type == kind


def test_struct_images_keep_their_types(spark):
    df = spark.createDataFrame(
        [("srv.shop.t", "c", None, (1, 2.5))],
        "topic string, op string, before struct<id:int,v:double>, after struct<id:int,v:double>",
    )
    row = changes.normalize(df).first()
    assert (row.before, plain(row.after)) == ({}, {"id": 1, "v": 2.5})


def test_envelope_text_round_trip(spark):
    rows = feed(spark, ("t", "u", {"id": "1"}, {"id": "1", "n": "x"})).drop("pos")
    lines = rows.select(F.to_json(F.struct("*")).alias("value"))
    again = changes.parse_envelopes(lines).select(rows.columns)
    assert again.select(F.to_json(F.struct("*")).alias("value")).collect() == lines.collect()


def test_deletes_are_dropped_and_untyped_kept(spark):
    rows = feed(spark, ("t", "delete", {}, None), ("t", "update", {}, {}), ("t", None, None, {}))
    assert [r.type for r in changes.drop_deletes(rows).orderBy("pos").collect()] == ["update", None]


def test_table_filter(spark):
    rows = feed(spark, ("a", "c", None, {}), ("b", "c", None, {}))
    assert changes.only_tables(rows).count() == 2
    assert changes.only_tables(rows, "a").count() == 1
    assert changes.only_tables(rows, "shop.b", "other.a").count() == 1


def test_changelog_and_state(spark):
    a, b = {"id": "1", "n": "A"}, {"id": "1", "n": "B"}
    steps = [("t", "c", None, a), ("t", "u", a, b), ("t", "d", b, None)]
    log = changes.to_changelog(feed(spark, *steps)).orderBy("pos", "is_add").collect()
    assert [(r.is_add, r.image["n"].toPython()) for r in log] == [
        (True, "A"), (False, "A"), (True, "B"), (False, "B")
    ]
    state = lambda k: [
        r.image["n"].toPython() for r in changes.current_state(feed(spark, *steps[:k]), ["id"], ["pos"]).collect()
    ]
    assert (state(1), state(2), state(3)) == (["A"], ["B"], [])


def test_an_update_can_move_the_key(spark):
    rows = feed(spark, ("t", "c", None, {"id": "1"}), ("t", "u", {"id": "1"}, {"id": "2"}))
    assert [r.image["id"].toPython() for r in changes.current_state(rows, ["id"], ["pos"]).collect()] == ["2"]


def test_snapshot_then_changes_as_a_view(spark):
    snapshot = spark.createDataFrame([(1, "A"), (2, "B")], "tm_id int, tm_name string")
    later = feed(spark, ("tm", "d", {"tm_id": "2", "tm_name": "B"}, None),
                 ("tm", "c", None, {"tm_id": "3", "tm_name": "C"}))
    whole = changes.snapshot_then_changes(
        changes.snapshot_as_changes(snapshot, "shop", "tm").withColumn("pos", F.lit(-1)), later
    )
    changes.register_table(
        changes.current_state(whole, ["tm_id"], ["pos"]), "tm_view", ["tm_id", "tm_name"]
    )
    assert sorted(map(tuple, spark.sql("select * from tm_view").collect())) == [
        ("1", "A"), ("3", "C")
    ]


def rules(spark, *rows):
    return spark.createDataFrame(list(rows), TABLE_PROCESS)


def test_routing(spark):
    table = rules(
        spark,
        ("t", "insert", "kafka", "topic_t", "id,name", None, None),
        ("t", "update", "hbase", "dim_t", "id", None, None),
        ("u", "insert", "clickhouse", "ck_u", "id", None, None),
    )
    image = {"id": "1", "name": "n", "logo": "l"}
    rows = feed(
        spark, ("t", "c", None, image), ("t", "u", {}, image), ("t", "d", image, None),
        ("u", "c", None, image), ("v", "c", None, image), ("t", "r", None, image),
    )
    routed = routing.route(changes.drop_deletes(rows), table)
    [line] = routing.topic_lines(routed).collect()
    assert (line.topic, json.loads(line.value)) == ("topic_t", {"id": "1", "name": "n"})
    [dim] = routing.table_rows(routed).collect()
    assert (dim.sink_table, dim.sink_pk, plain(dim.data)) == ("dim_t", "id", {"id": "1"})
    audit = routing.unrouted(routed).select("tableName", "type", "reason").collect()
    assert sorted(map(tuple, audit)) == [
        ("t", "read", "unmatched"), ("u", "insert", "ignored"), ("v", "insert", "unmatched")
    ]
    with_reads = routing.route(rows, table, treat_read_as_insert=True)
    assert routing.topic_rows(with_reads).count() == 2


def test_whitelist_does_not_trim(spark):
    df = spark.createDataFrame([({"id": "1", "tm_name": "x", "logo": "l"},)], "m map<string,string>")
    kept = lambda names: df.select(routing.whitelist(F.col("m"), F.lit(names))).first()[0]
    assert kept("id,tm_name") == {"id": "1", "tm_name": "x"}
    assert kept("id, tm_name") == {"id": "1"}


def test_rule_changes_and_deletes(spark):
    first = {"source_table": "t", "operate_type": "insert", "sink_type": "kafka", "sink_table": "x",
             "sink_columns": "id"}
    second = {**first, "sink_type": "hbase"}
    steps = [("rules", "r", None, first), ("rules", "u", first, second), ("rules", "d", second, None)]
    data = feed(spark, ("t", "c", None, {"id": "1"}))
    def kind(k):
        active = routing.latest_rules(feed(spark, *steps[:k]), ["pos"])
        return routing.route(data, active).first().sink_type
    assert [kind(1), kind(2), kind(3)] == ["kafka", "hbase", None]


def test_table_layout_of_a_rule(spark):
    schema = routing.table_schema("id,name")
    assert schema.simpleString() == "struct<id:string,name:string>"
    assert schema["id"].metadata["primary_key"] is True
    assert routing.table_schema("a,b", "b", "SALT=3")["b"].metadata["extend"] == "SALT=3"


def test_quoted_numbers_and_loose_times_are_read(spark):
    from pyspark.sql import functions as F

    from millrace.functions.records import parse_typed
    from millrace.functions.times import to_epoch_ms
    from millrace.schemas import ORDER_INFO

    lines = spark.createDataFrame([('{"id":"1","user_id":"9"}',), ('{"id":2,"user_id":9}',), ("no",)], "value string")
    rows = parse_typed(lines, ORDER_INFO).select("id", "user_id").collect()
    assert [tuple(r) for r in rows] == [(1, 9), (2, 9), (None, None)]
    times = ["2024-01-01 01:02:03", "2024-01-01 01:02:03.5", "2024-1-1 1:2:3", "2024-01-01", "soon", None]
    found = spark.createDataFrame([(t,) for t in times], "t string").select(to_epoch_ms(F.col("t"))).collect()
    assert [r[0] for r in found] == [1704070923000, 1704070923500, 1704070923000, None, None, None]
