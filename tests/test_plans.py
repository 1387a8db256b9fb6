"""The physical plans the operators are meant to get, with broadcasting off."""

import re

import pytest
from helpers import page, pages

from millrace.operators import changes, jumps, logs, routing, stats, visits
from millrace.operators.joins import interval_join
from millrace.schemas import CDC_ENVELOPE, TABLE_PROCESS


@pytest.fixture
def rows(spark, tmp_path):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    pages(spark, page("a", 1, "E"), page("a", 2)).write.parquet(str(tmp_path / "p"))
    yield spark.read.parquet(str(tmp_path / "p"))
    spark.conf.set(key, before)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_unique_visits_limit_before_the_shuffle(rows):
    text = plan(visits.unique_visits(rows))
    assert text.count("Exchange") == 1
    after, before = text.split("Exchange")
    assert "WindowGroupLimit" in before and "Partial" in before
    assert "PushedFilters: [Or(IsNull(page.last_page_id),EqualTo(page.last_page_id,))]" in before


def test_bounces_cost_one_shuffle_on_visitor_and_slice(rows):
    text = plan(jumps.detect(rows).select("ts"))
    assert text.count("Exchange") == 1
    assert "hashpartitioning(_key" in text and "_slice" in text.split("hashpartitioning(")[1][:40]
    assert "displays" not in text.split("ReadSchema")[1]


def test_repair_joins_on_the_record_not_the_visitor(rows):
    text = plan(logs.repair_is_new(rows))
    assert "partial_min" in text
    join = next(line for line in text.splitlines() if "SortMergeJoin" in line)
    assert "ts#" in join and "seq#" in join


def test_interval_join_hashes_key_and_slice(rows):
    sides = rows.select("common.mid", "ts"), rows.select("common.mid", "ts")
    text = plan(interval_join(*sides, [("mid", "mid")], "ts", "ts", -5_000, 5_000))
    join = next(line for line in text.splitlines() if "SortMergeJoin" in line)
    assert "_slice" in join


def test_routing_does_not_move_the_feed(spark, rows):
    feed = spark.createDataFrame([], CDC_ENVELOPE)
    rules = spark.createDataFrame([("t", "insert", "kafka", "x", "id", None, None)], TABLE_PROCESS)
    text = plan(routing.topic_lines(routing.route(changes.drop_deletes(feed), rules)))
    assert "hashpartitioning" not in text


def test_log_texts_are_parsed_once(spark, rows):
    lines = rows.selectExpr("start as value")
    assert plan(logs.good(logs.parse(lines))).count("from_json") == 1


def test_statistics_read_and_shuffle_the_log_once(rows):
    found = stats.visitor_stats_of_logs(rows)
    assert found.count() == 1 and len(found.collect()) == 1
    text = plan(found).split("== Initial Plan ==")[0]
    exchanges = re.findall(r"^[ :+*()\d-]*Exchange (\w+)", text, re.MULTILINE)
    assert text.count("Scan parquet") == 1 and text.count("ReusedExchange") == 1
    assert exchanges == ["hashpartitioning"] * 3
