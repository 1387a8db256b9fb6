import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.routing import table_schema
from millrace.sinks import stats as stats_sink
from millrace.sinks.dimensions import DimensionTable
from millrace.sinks.topics import DEFAULT_TOPIC, print_stream, write_routed, write_topic
from millrace.sources.tables import read_table
from millrace.sources.topics import Start, Topics, delimited, log_files
from millrace.streaming.runner import run_to_table


def values(df):
    return sorted(r.value for r in df.select("value").collect())


@pytest.mark.parametrize("file_format", ["parquet", "text"])
def test_rows_go_to_their_topics(spark, tmp_path, file_format):
    topics = Topics(spark, str(tmp_path), file_format=file_format)
    lines = spark.createDataFrame([("x", "1"), ("y", "2"), (None, "3")], "topic string, value string")
    write_routed(topics, lines, "w")
    assert [values(topics.read(t)) for t in ("x", "y", DEFAULT_TOPIC)] == [["1"], ["2"], ["3"]]


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    topics = Topics(spark, str(tmp_path))
    rows = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id int")
    write_topic(topics, rows(1, 2), "t", "w", 0)
    write_topic(topics, rows(3), "t", "w", 1)
    write_topic(topics, rows(1, 2), "t", "w", 0)
    write_topic(topics, rows(4), "t", "other", 0)
    assert values(topics.read("t")) == ['{"id":%d}' % i for i in (1, 2, 3, 4)]


def test_positions_are_unique(spark, tmp_path):
    topics = Topics(spark, str(tmp_path))
    same = spark.range(100).select(F.lit("same").alias("name")).repartition(3)
    write_topic(topics, same, "t", "w")
    records = topics.read("t")
    assert records.count() == records.select("src", "part", "off").distinct().count() == 100


def test_topic_as_a_stream_and_from_a_time(spark, tmp_path):
    topics = Topics(spark, str(tmp_path / "topics"))
    write_topic(topics, spark.range(3), "t", "w")
    assert run_to_table(topics.read_stream("t"), "t", str(tmp_path / "a")).count() == 3
    later = Start("timestamp", timestamp_ms=4_000_000_000_000)
    assert topics.read("t", later).count() == 0
    assert topics.read("t", Start("timestamp", timestamp_ms=0)).count() == 3
    with pytest.raises(ValueError):
        topics.read("t", Start("latest"))


def test_start_options():
    assert Start().kafka_options() == {"startingOffsets": "earliest"}
    assert Start("latest").kafka_options() == {"startingOffsets": "latest"}
    assert Start("timestamp", timestamp_ms=5).kafka_options() == {"startingTimestamp": "5"}
    offsets = {"t": {"0": 7}}
    assert json.loads(Start("offsets", offsets=offsets).kafka_options()["startingOffsets"]) == offsets
    with pytest.raises(ValueError):
        Start("middle").kafka_options()


def test_text_sources(spark, tmp_path):
    (tmp_path / "app.log").write_text('{"a":1}\n{"a":2}\n')
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "x.csv").write_text("1,n,5\n2,m,6\n")
    assert values(log_files(spark, str(tmp_path / "app.log"))) == ['{"a":1}', '{"a":2}']
    rows = delimited(spark, str(tmp_path / "csv"), "id string, name string, ts bigint")
    assert sorted(map(tuple, rows.collect())) == [("1", "n", 5), ("2", "m", 6)]
    streamed = delimited(spark, str(tmp_path / "csv"), "id string, name string, ts bigint", streaming=True)
    assert run_to_table(streamed, "csv", str(tmp_path / "run")).count() == 2


def test_console(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text("hello\n")
    query = print_stream(log_files(spark, str(tmp_path / "in"), streaming=True), "shown", str(tmp_path / "ck"))
    query.processAllAvailable()
    query.stop()
    assert query.exception() is None
    assert query.recentProgress[0].numInputRows == 1


class Customers:
    def __init__(self, spark, root):
        self.spark = spark
        self.table = DimensionTable(spark, str(root), table_schema("id,name,city"))
        self.table.create()

    def apply(self, batch_id, *rows, writer="w"):
        df = self.spark.createDataFrame(list(rows), "id string, name string, city string, pos int")
        self.table.apply(df, ["pos"], writer, batch_id)

    def rows(self):
        return sorted(tuple(r) for r in self.table.read().collect())


def test_newest_row_per_key(spark, tmp_path):
    customers = Customers(spark, tmp_path)
    assert customers.rows() == []
    customers.apply(0, ("1", "v2", "x", 2), ("1", "v1", "y", 1))
    customers.apply(1, ("2", "w", None, 0))
    assert customers.rows() == [("1", "v2", "x"), ("2", "w", None)]
    customers.apply(2, ("1", "v3", "z", 3))
    assert customers.rows() == [("1", "v3", "z"), ("2", "w", None)]


def test_an_older_change_in_a_later_batch_loses(spark, tmp_path):
    customers = Customers(spark, tmp_path)
    customers.apply(0, ("1", "new", None, 9))
    customers.apply(1, ("1", "old", "kept", 3))
    assert customers.rows() == [("1", "new", "kept")]
    customers.table.compact()
    customers.apply(2, ("1", "older", "too old", 2), ("1", None, "newer", 4))
    assert customers.rows() == [("1", "new", "newer")]


def test_any_order_and_any_folding_give_the_same_table(spark, tmp_path):
    """Against brute force: per key and column the newest non-null value."""
    rng = random.Random(8)
    changes = [
        (str(rng.randrange(6)), *[rng.choice([None, f"{c}{pos}"]) for c in "nc"], pos) for pos in range(40)
    ]
    wanted = {}
    for key, name, city, _ in changes:
        old = wanted.get(key, (None, None))
        wanted[key] = (name or old[0], city or old[1])
    for fold_at in (2, 100):
        rng.shuffle(changes)
        customers = Customers(spark, tmp_path / str(fold_at))
        for n, begin in enumerate(range(0, 40, 10)):
            df = spark.createDataFrame(changes[begin:begin + 10], "id string, name string, city string, pos int")
            customers.table.apply(df, ["pos"], "w", n, fold_at)
        assert customers.rows() == sorted((k, *v) for k, v in wanted.items())


def test_folding_is_bounded_and_another_reader_finds_the_last_commit(spark, tmp_path):
    customers = Customers(spark, tmp_path)
    for n in range(11):
        customers.apply(n, (str(n), "a", "x", n))
    last = customers.table._last()
    assert len(last.deltas) < 8 and last.base_rows + last.delta_rows == 11
    again = DimensionTable(spark, str(tmp_path), table_schema("id,name,city"))
    assert again.read().count() == 11 and again._last() == last


def test_changes_need_one_kind_of_order(spark, tmp_path):
    customers = Customers(spark, tmp_path)
    customers.apply(0, ("1", "a", "x", 0))
    with pytest.raises(ValueError, match="ordered by"):
        customers.table.apply(spark.createDataFrame([("1", "late")], "id string, pos string"), ["pos"], "w", 1)


def test_missing_columns_keep_their_value(spark, tmp_path):
    customers = Customers(spark, tmp_path)
    customers.apply(0, ("1", "n", "x", 0))
    customers.apply(1, ("1", None, "y", 0), ("1", "m", None, 1))
    customers.table.apply(spark.createDataFrame([("1", 9)], "id string, pos int"), ["pos"], "w", 2)
    assert customers.rows() == [("1", "m", "y")]


def test_replays_and_compaction(spark, tmp_path):
    customers = Customers(spark, tmp_path)
    customers.apply(0, ("1", "a", "x", 0))
    customers.apply(0, ("1", "never", "never", 0))
    customers.apply(0, ("2", "b", "x", 0), writer="other")
    before = customers.rows()
    customers.table.compact()
    assert customers.rows() == before == [("1", "a", "x"), ("2", "b", "x")]
    customers.apply(1, ("1", "c", None, 0))
    assert customers.rows() == [("1", "c", "x"), ("2", "b", "x")]


def test_an_uncommitted_write_is_not_seen(spark, tmp_path):
    customers = Customers(spark, tmp_path)
    customers.apply(0, ("1", "a", "x", 0))
    lost = spark.createDataFrame([("1", "half", "half")], "id string, name string, city string")
    lost.write.parquet(f"{tmp_path}/delta/version=2")
    assert customers.rows() == [("1", "a", "x")]
    customers.apply(1, ("1", "b", "y", 0))
    assert customers.rows() == [("1", "b", "y")]


def test_rule_tables_are_created_once(spark, tmp_path):
    rule = {"sink_table": "dim", "sink_columns": "k,v", "sink_pk": "k", "sink_extend": None}
    table = DimensionTable.from_rule(spark, str(tmp_path), rule)
    table.apply(spark.createDataFrame([("1", 2, 0)], "k string, v int, pos int"), ["pos"])
    again = DimensionTable.from_rule(spark, str(tmp_path), rule)
    assert [tuple(r) for r in again.read().collect()] == [("1", "2")]
    with pytest.raises(ValueError):
        DimensionTable.from_rule(spark, str(tmp_path), {**rule, "sink_pk": None})


def test_whole_table_reading(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "TM_ID int, TM_NAME string").write.parquet(str(tmp_path / "d"))
    assert read_table(spark, str(tmp_path / "d"), camel_case=True).columns == ["tmId", "tmName"]
    read_table(spark, str(tmp_path / "d")).createOrReplaceTempView("tm_table")
    assert read_table(spark, "tm_table", "table").count() == 1


def test_windows_are_stored_by_day(spark, tmp_path):
    rows = spark.createDataFrame([("2020-01-01 00:00:00", 1), ("2020-01-02 00:00:00", 2)], "stt string, n int")
    write = stats_sink.to_parquet(str(tmp_path / "s"))
    write(rows, 0)
    write(rows, 0)
    stored = spark.read.parquet(str(tmp_path / "s"))
    assert stored.count() == 2
    assert {str(r.day) for r in stored.collect()} == {"2020-01-01", "2020-01-02"}
