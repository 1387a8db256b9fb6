"""What executors hold at a time: changes being routed, state stores, wide orders."""

import pytest
from test_jobs import change, drain, get, put, rule, topics  # noqa: F401
from test_orders import dims

from millrace.functions.records import to_lines
from millrace.jobs import changes
from millrace.jobs import orders as order_jobs
from millrace.streaming.runner import STATE_MEMORY, query_conf, run_to_table, start_batches

BOUNDED, AT_MOST = STATE_MEMORY


@pytest.fixture
def kept(spark, monkeypatch):
    """Columns of what is persisted."""
    columns, frame = [], type(spark.range(0))
    persist = frame.persist
    monkeypatch.setattr(frame, "persist", lambda self, *a, **b: columns.append(self.columns) or persist(self, *a, **b))
    return columns


@pytest.mark.parametrize("with_table", [True, False])
def test_routing_keeps_only_what_tables_need(spark, topics, tmp_path, kept, with_table):  # noqa: F811
    rules = [rule("t", "insert", "kafka", "of_t", "id")]
    put(topics, "table_process", *rules, *[rule("d", "insert", "hbase", "dim_d", "id,name", "id")] * with_table)
    put(topics, "change_records", change("t", "c", {"id": 1}), change("d", "c", {"id": 2, "name": "n", "more": "m"}))
    drain(topics, tmp_path, "normalize_feed")
    kept.clear()
    drain(topics, tmp_path, "route_changes", "--dims", str(tmp_path / "dims"))
    assert kept == [["sink_table", "data", "_change"]] * with_table
    assert get(topics, "of_t") == [{"id": 1}]
    if with_table:
        layout = {"sink_table": "dim_d", "sink_columns": "id,name", "sink_pk": "id", "sink_extend": None}
        table = changes.DimensionTable.from_rule(spark, str(tmp_path / "dims"), layout)
        assert [tuple(r) for r in table.read().collect()] == [("2", "n")]


@pytest.mark.parametrize("own", [None, "64"])
def test_state_stores_share_memory_unless_told_otherwise(spark, tmp_path, own):
    spark.range(4).write.parquet(str(tmp_path / "in"))
    rows = spark.readStream.schema("id bigint").parquet(str(tmp_path / "in")).dropDuplicates(["id"])
    found = []
    write = lambda batch, n: found.append((batch.count(), *[batch.sparkSession.conf.get(k, None) for k in (BOUNDED, AT_MOST)]))
    with query_conf(spark, {AT_MOST: own} if own else {}):
        start_batches(rows, write, str(tmp_path / "ck"), {"availableNow": True}).awaitTermination()
        assert run_to_table(rows, "bounded").count() == 4
    assert found[0] == (4, "true", own or STATE_MEMORY[AT_MOST])
    assert spark.conf.get(BOUNDED, None) is None and spark.conf.get(AT_MOST, None) is None


def test_wide_orders_are_not_joined_and_written_as_text_by_one_method(spark, topics, tmp_path, monkeypatch):  # noqa: F811
    at = lambda s: f"2020-01-01 08:00:{s:02d}"
    put(topics, "dwd_order_info", {"id": 1, "province_id": 3, "user_id": 9, "create_time": at(10)})
    put(topics, "dwd_order_detail", {"id": 11, "order_id": 1, "sku_id": 5, "create_time": at(5)})
    plans, write = [], order_jobs.write_topic

    def noted(topics, df, *to):
        lines = to_lines(df)
        plans.append(lines._jdf.queryExecution().executedPlan().toString().splitlines()[0])
        write(topics, df, *to)

    monkeypatch.setattr(order_jobs, "write_topic", noted)
    for query in order_jobs.order_wide(topics, lambda: dims(spark), str(tmp_path / "o"), {"availableNow": True}):
        query.awaitTermination()
    assert len(plans) == 1 and plans[0].startswith("Project"), plans
    assert [r["detail_id"] for r in get(topics, "dwm_order_wide")] == [11]
