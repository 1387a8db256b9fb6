"""What has to grow with the input, or not to."""

import datetime

import public_tokenizers
import pytest
from helpers import page, page_schema, pages
from test_orders import AS_OF_MS, dims, named, order_rows
from test_streams import Feed

from millrace.llm.sentencepiece_bpe import Encoder, Vocabulary
from millrace.operators import jumps, orders
from millrace.operators.joins import interval_join
from millrace.plans import catalog
from millrace.plans.catalog import QUERIES
from millrace.schemas import PAYMENT_INFO
from millrace.sources.topics import Start
from millrace.streaming import state


@pytest.fixture
def small_files(monkeypatch):
    """Files of ten records, and the files of each topic write with the files a stream takes at a time."""
    written, taken = [], []
    write, read = catalog.write_routed, catalog.Topics.read_stream

    def counted(topics, lines, writer, batch_id=0):
        written.append(lines.rdd.getNumPartitions())
        write(topics, lines, writer, batch_id)

    def noted(topics, topic, start=Start(), files_per_batch=None):
        taken.append((topic, files_per_batch))
        return read(topics, topic, start, files_per_batch)

    monkeypatch.setattr(catalog, "FILE_RECORDS", 10)
    monkeypatch.setattr(catalog, "write_routed", counted)
    monkeypatch.setattr(catalog.Topics, "read_stream", noted)
    return written, taken


def put(spark, folder, name, rows, layout):
    spark.createDataFrame(rows, layout).coalesce(1).write.parquet(f"{folder}/{name}.parquet")


def test_customer_changes_are_dealt_to_files_by_their_number(spark, tmp_path, small_files):
    day = datetime.datetime(1996, 1, 1)
    rows = [(i, i % 7, "O", 1.0, day + datetime.timedelta(days=i), "1-URGENT" if i % 2 else "5-LOW") for i in range(90)]
    put(spark, tmp_path, "orders", rows, catalog.a.ORDERS_DDL)
    got = sorted(tuple(r) for r in QUERIES["chain_dim_upsert"](spark, str(tmp_path)).collect())
    assert got == [(str(i), "O", "1-URGENT") for i in range(7)]
    written, taken = small_files
    assert written == [9]
    assert dict(taken)["change_records"] == 3 and len(taken) == 2


def test_line_changes_are_dealt_to_files_by_their_number(spark, tmp_path, small_files):
    day = datetime.datetime(1996, 1, 1)
    rows = [(i // 2, i, 1, i % 2, 1.0, 1.0, 0.0, 0.0, "N", "O", day + datetime.timedelta(days=i - 60)) for i in range(120)]
    put(spark, tmp_path, "lineitem", rows, catalog.a.LINEITEM_DDL)
    live = [(str(i), str(2 * i + 1)) for i in range(60)]
    for query, files, at_a_time in (("chain_cdc_current", 16, None), ("stream_snapshot_feed", 12, 6)):
        written, taken = small_files
        got = QUERIES[query](spark, str(tmp_path)).select("id", "part").collect()
        assert sorted(map(tuple, got)) == sorted(live)
        assert written[-1] == files
        assert taken[-1] == ("change_records", at_a_time) or not at_a_time


def test_late_records_are_dealt_to_files_by_their_number(spark, tmp_path, small_files):
    day = datetime.datetime(2024, 1, 1)
    rows = [(i, day + datetime.timedelta(hours=i), i % 3, "view", 1.0, '{"k": 1}') for i in range(120)]
    put(spark, tmp_path, "events", rows, catalog.a.EVENTS_DDL)
    got = {r["seq"]: r["reason"] for r in QUERIES["late_rows"](spark, str(tmp_path)).collect()}
    assert set(got) == set(range(120)) | ({None} & set(got))
    assert small_files[0] == [3] * 4 and dict(small_files[1])["dwd_page_log"] == 3
    # A record held back for a file is late by what its neighbours of the next file had reached before it.
    assert got[3] == "late" and got[4] == "on time" and got[7] == "untimed" and got[57] == "untimed"


def test_visitors_share_state(spark, tmp_path):
    feed = Feed(spark, tmp_path, page_schema())
    rows = [page(f"m{i % 30}" if i % 30 else None, 1 + i, "EEN"[i % 7 % 3], seq=i) for i in range(150)]
    feed.add(*rows[:70]).add(*rows[70:]).add(page("end", 5_000))
    run = lambda s: state.consecutive_match_stream(s, 3, 80_000, buckets=2)
    pick = lambda df: sorted(map(str, df.select("common.mid", "ts", "seq", "outcome").collect()))
    assert pick(feed.run(run)) == pick(jumps.consecutive_match(pages(spark, *rows), 3, 80_000))
    kept = spark.read.format("statestore").option("stateVarName", "rows").load(f"{tmp_path}/run/checkpoint")
    assert "bucket" in kept.schema["key"].dataType.names


def test_wide_orders_are_not_moved_again_for_their_payments(spark):
    info, detail = order_rows(spark)
    payments = named(spark, PAYMENT_INFO, {"id": 7, "order_id": 1, "create_time": "2020-01-01 08:35:00"})
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        found = {}
        for by_order in (False, True):
            wide = orders.order_wide(info, detail, dims(spark), AS_OF_MS, by_order=by_order)
            paid = orders.payment_wide(payments, wide, by_order=by_order)
            found[by_order] = paid._jdf.queryExecution().executedPlan().toString(), sorted(map(str, paid.collect()))
    finally:
        spark.conf.set(key, before)
    (sliced, rows), (whole, same) = found[False], found[True]
    assert rows == same and len(rows) == 2
    assert "_slice" not in whole
    assert whole.count("Exchange") == sliced.count("Exchange") - 1


def test_an_interval_join_without_slices_gives_the_same(spark):
    left = spark.createDataFrame([("a", 10), ("a", None), (None, 10), ("b", 10)], "k string, t bigint")
    right = spark.createDataFrame([("a", 5), ("a", 4), ("a", None), ("a", 12), (None, 10), ("b", 13)], "k string, t bigint")
    pairs = [
        sorted(map(tuple, interval_join(left, right, [("k", "k")], "t", "t", -5, 2, sliced=s).select("l.k", "r.t").collect()))
        for s in (True, False)
    ]
    assert pairs[0] == pairs[1] == [("a", 5), ("a", 12)]


def test_a_piece_behind_another_is_checked_with_it_only(monkeypatch):
    asked = []
    whole = Encoder.whole
    monkeypatch.setattr(Encoder, "whole", lambda self, piece: asked.append(piece) or whole(self, piece))
    encoder = Encoder(Vocabulary(str(public_tokenizers.path("piece_bpe_32k.model"))))
    text = "▁internationalisation" * 3
    assert encoder.pieces(text) == encoder.merged(text)
    assert len(asked) == 1
