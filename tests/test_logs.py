import json

import pytest
from helpers import page, pages, plain
from pyspark.sql import functions as F

from millrace.operators import logs


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_dirty_texts_are_split_off(spark):
    parsed = logs.parse(lines(spark, '{"common":{"mid":"a"}}', "broken{", '{"x":1}', None))
    assert logs.good(parsed).count() == 1
    assert sorted(r.value or "" for r in logs.dirty(parsed).collect()) == ["", "broken{", '{"x":1}']


@pytest.mark.parametrize("text", [
    '{"common":{"mid":"a"}} tail', '{"common":{"mid":"a"}}}', '{"common":{"mid":"a"}}{"x":1}',
    '{"common":{"mid":"a"}},{"common":{"mid":"b"}}', '[{"common":{"mid":"a"}}]', '"a"', "12",
    "null", "", '{"common":"a"}', '{"common":{"mid":',
])
def test_anything_but_one_object_is_dirty(spark, text):
    parsed = logs.parse(lines(spark, text))
    assert logs.good(parsed).count() == 0
    assert [r.value for r in logs.dirty(parsed).collect()] == [text]


def test_blanks_around_a_record_do_no_harm(spark):
    assert logs.good(logs.parse(lines(spark, '  {"common":{"mid":7}}\t'))).first().common.mid == "7"


def test_wrongly_typed_time_is_dirty_and_quoted_number_is_not(spark):
    parsed = logs.parse(lines(
        spark, '{"common":{"mid":"a"},"ts":"17"}', '{"common":{"mid":"a"},"ts":"soon"}',
        '{"common":{"mid":"a","is_new":1},"page":{"during_time":"5"},"ts":18}',
    ))
    good = logs.good(parsed).select("ts", "common.is_new", "page.during_time").collect()
    assert sorted(map(tuple, good), key=str) == [(17, None, None), (18, "1", 5)]


def test_whole_long_text_is_parsed(spark):
    tail = "x" * 200_000
    text = json.dumps({"common": {"mid": "a", "vc": tail}, "ts": 1})
    assert logs.good(logs.parse(lines(spark, text))).first()["common"]["vc"] == tail


def is_new_by_time(df):
    return [r[0] for r in df.orderBy("ts").select("common.is_new").collect()]


def test_first_claim_keeps_its_flag(spark):
    rows = [page("a", t, is_new=f) for t, f in [(1, "1"), (2, "1"), (3, "0"), (4, "1")]]
    assert is_new_by_time(logs.repair_is_new(pages(spark, *rows))) == ["1", "0", "0", "0"]
    assert is_new_by_time(logs.repair_is_new(pages(spark, *rows[::-1]))) == ["1", "0", "0", "0"]


def test_old_visitor_record_does_not_use_up_the_claim(spark):
    rows = [page("a", t, is_new=f) for t, f in [(1, "0"), (2, "1"), (3, "1")]]
    assert is_new_by_time(logs.repair_is_new(pages(spark, *rows))) == ["0", "1", "0"]


def test_claims_of_equal_time_are_told_apart(spark):
    rows = [page("a", 1, seq=s, is_new="1") for s in (7, 5, 6)]
    fixed = logs.repair_is_new(pages(spark, *rows)).orderBy("seq").select("common.is_new").collect()
    assert [r[0] for r in fixed] == ["1", "0", "0"]


def test_missing_flag_stays_missing(spark):
    rows = [page("a", 1, is_new=None), page("a", 2, is_new="1")]
    assert is_new_by_time(logs.repair_is_new(pages(spark, *rows))) == [None, "1"]


def test_three_way_split(spark):
    shown = [{"item": "i1"}, {"item": "i2", "page_id": "other"}]
    rows = pages(
        spark, page("a", 1, start="{}", displays=shown), page("a", 2, displays=shown),
        page("a", 3), page("a", 4, start="", displays=[]),
    )
    assert logs.start_logs(rows).count() == 1
    assert logs.page_logs(rows).count() == 3
    displays = [r.display for r in logs.display_logs(rows).collect()]
    assert sorted(d["item"].toPython() for d in displays) == ["i1", "i2"]
    assert {d["page_id"].toPython() for d in displays} == {"p1"}
    with_common = logs.display_logs(rows, with_common=True).select("common.mid", "ts").collect()
    assert [tuple(r) for r in with_common] == [("a", 2000), ("a", 2000)]


def test_display_of_a_pageless_record_survives(spark):
    row = (("a", "0", "v", "c", "x"), None, None, [{"item": "i1"}], 1, 1)
    got = logs.display_logs(pages(spark, row)).first().display
    assert plain(got) == {"item": "i1"}


def test_start_object_is_kept_as_text(spark):
    parsed = logs.good(logs.parse(lines(spark, '{"common":{"mid":"a"},"start":{"entry":"icon"}}')))
    assert logs.start_logs(parsed).select(F.get_json_object("start", "$.entry")).first()[0] == "icon"


def test_fields_of_another_type_are_null_but_not_dirty(spark):
    texts = ['{"common":{"mid":"a"},"page":"oops","ts":1}', '{"common":{"mid":"b"},"displays":"x","page":{"page_id":7,"during_time":"x"}}',
             '{"common":{"mid":"c"},"displays":{"x":1},"ts":"3"}', '{"common":[{"mid":"d"}]}', '{"common":{"mid":"e"},"ts":"x"}']
    parsed = logs.parse(spark.createDataFrame([(t,) for t in texts], "value string"))
    found = logs.good(parsed).select("common.mid", "page.page_id", "page.during_time", "displays", "ts").collect()
    assert sorted(map(tuple, found)) == [("a", None, None, None, 1), ("b", "7", None, None, None), ("c", None, None, None, 3)]
    assert logs.dirty(parsed).count() == 2


def test_display_items_keep_their_types(spark):
    item = {"order": 1, "x": {"y": 2}, "b": True, "n": None, "a": [1.5, "é"]}
    text = json.dumps({"common": {"mid": "a", "is_new": "0"}, "page": {"page_id": "p"}, "displays": [item], "ts": 1})
    parsed = logs.good(logs.parse(spark.createDataFrame([(text,)], "value string")), keep_text=True)
    [shown] = logs.split_lines(parsed, text="value").where("topic = 'dwd_display_log'").collect()
    assert json.loads(shown.value) == {**item, "page_id": "p"}


def test_a_field_named_twice_counts_by_its_last_value_and_loses_no_other(spark):
    text = '{"common":{"mid":"a","uid":"u"},"err":1,"err":{"code":2,"code":3},"page":{"page_id":"p","q":1},"ts":1}'
    parsed = logs.good(logs.parse(spark.createDataFrame([(text,)], "value string")), keep_text=True)
    [line] = logs.split_lines(parsed, text="value").collect()
    assert json.loads(line.value) == json.loads(text)
